"""Problem 6: personal items inside free text, found in a normalised copy and mapped back to the source.

Transducers rewrite a text step by step while an offset map follows: look-alike letters, widths and blanks become
one form, invisible characters and keycap marks vanish, spelled digits become digits and ``(at)`` / ``[dot]``
disguises become ``@`` and ``.``.  Identifiers are detected on that form and their spans are mapped to the
characters of the stored text, so positions and replacements are exact whatever was hidden in between.

A person's name is a known first name (the list is a parameter) beside a word with the end of a surname, a surname
with initials, or any two capitalised words behind a word that announces a person.

Every literal of the patterns goes through the same letter mapping as the texts, in small, title and capital letters.
Null and empty texts have no items.  Where items would overlap, the earlier kind of KINDS wins.  The work grows with
the length of a text, however many items it holds.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.llm.canon import transducer

KINDS = ("email", "id_number", "phone", "street_address", "person_name")

# Common first names; the default of a parameter.
FIRST_NAMES = """
Александр Алексей Алина Алла Анастасия Анатолий Андрей Анна Антон Артём Борис Вадим Валентина Валерий Варвара
Василий Вера Вероника Виктор Виктория Виталий Владимир Владислав Галина Георгий Глеб Григорий Дарья Денис Диана
Дмитрий Евгений Евгения Егор Екатерина Елена Елизавета Иван Игорь Илья Инна Ирина Кирилл Константин Ксения Лариса
Лев Леонид Любовь Людмила Максим Маргарита Марина Мария Матвей Михаил Надежда Наталья Никита Николай Оксана Олег
Ольга Павел Пётр Полина Роман Руслан Светлана Семён Сергей София Станислав Степан Тамара Татьяна Тимур Ульяна
Фёдор Эдуард Юлия Юрий Яна Ярослав
Aleksandar Ana Bojan Branko Danijela Dejan Dragan Dušan Goran Igor Ivana Jasmina Jelena Jovan Jovana Katarina Ljiljana
Luka Maja Marija Marko Milan Milena Milica Milica Miloš Mirjana Nataša Nebojša Nemanja Nenad Nikola Olivera Petar
Predrag Saša Slavica Slobodan Snežana Stefan Svetlana Tamara Tijana Vesna Vladimir Vuk Zoran Željko Žarko
Alice Andrew Anthony Charles Charlotte Colin Daniel David Edward Emily Emma George Grace Hannah Harriet Harry Helen
Henry Jack James Jane John Joseph Kate Laura Lucy Margaret Mark Martha Mary Matthew Michael Nicholas Oliver Peter
Richard Robert Ruth Samuel Sarah Simon Sophie Susan Thomas Victoria Walter William
"""

# Words that announce a person.
PERSON_CUES = ("администратор", "мастер", "спросить", "с уважением", "отзыв оставил(а)", "отзыв оставил", "менеджер", "pozdrav", "domaćin", "majstor", "tražite", "menadžer", "ask for", "regards", "your host", "manager")

# Spelled digits.
SPELLED = {
    "ноль": "0", "нуль": "0", "один": "1", "два": "2", "три": "3", "четыре": "4", "пять": "5", "шесть": "6", "семь": "7", "восемь": "8", "девять": "9",
    "nula": "0", "jedan": "1", "dva": "2", "tri": "3", "četiri": "4", "pet": "5", "šest": "6", "sedam": "7", "osam": "8", "devet": "9",
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "плюс": "+", "plus": "+",
}


class Mapped:
    """A rewritten text and, per character, its place in the source; ``at is None`` means the same places."""

    __slots__ = ("text", "at", "upto", "src", "size")

    def __init__(self, text: str, at: list[int] | None, src: str, upto: list[int] | None = None) -> None:
        self.text, self.at, self.upto, self.src, self.size = text, at, upto, src, len(src)

    def source(self, i: int, j: int) -> tuple[int, int]:
        """The span of the source that the characters i to j come from."""
        if self.at is None:
            return i, j
        end = self.upto[j - 1] if self.upto else self.at[j - 1] + 1
        while end < self.size and self.src[end] in "\ufe0f\u20e3":
            end += 1
        return self.at[i], end

    def rewrite(self, spans: list[tuple[int, int, str]]) -> Mapped:
        """Replace spans; a new character begins where its span begins, and ends where it ends."""
        if not spans:
            return self
        at = self.at if self.at is not None else list(range(len(self.text)))
        upto = self.upto or [i + 1 for i in at]
        out, where, ends, k = [], [], [], 0
        for i, j, new in spans:
            out += [self.text[k:i], new]
            where += at[k:i] + [at[i]] * len(new)
            ends += upto[k:i] + [upto[j - 1]] * len(new)
            k = j
        return Mapped("".join(out) + self.text[k:], where + at[k:], self.src, ends + upto[k:])


class Detector:
    """Compiled patterns; one per Python worker and list of first names."""

    def __init__(self, first_names: tuple[str, ...] = tuple(FIRST_NAMES.split())) -> None:
        t = transducer()
        self.single = {cp: to for cp, to in t.single.items() if len(to) <= 1 and cp not in (0x0A,)}
        # A keycap mark hides no letter; marks compose with the letter before them.
        self.single.update({0x20E3: "", 0x20DD: "", 0x20DE: "", 0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-", 0x2014: "-", 0x2212: "-"})
        self.dropped = frozenset(chr(cp) for cp, to in self.single.items() if not to)
        self.marks = re.compile("[̀-ͯ]")
        self.form = lambda s: t(s).translate({0x2013: "-", 0x2014: "-"})
        sk = self.form

        def alt(*words: str) -> str:
            """Alternatives in small, title and capital letters; the letter mapping differs by case."""
            return "|".join(sorted({sk(f) for w in words for f in (w, w[:1].upper() + w[1:], self._upper(w))}, key=lambda f: (-len(f), f)))

        one = alt(*SPELLED)
        self.spelled = re.compile(rf"(?<!\w)(?:(?:{one}|\d)[ ,.-]{{1,2}}){{6,}}(?:{one}|\d+)(?!\w)")
        self.word = re.compile(r"\w+")
        self.spelled_one = re.compile(rf"(?<!\w)(?:{one})(?!\w)")
        self.spelled_part = re.compile(rf"(?<!\w)(?:{one})(?!\w)|[ ,.-]{{1,2}}")
        self.digit_of = {sk(f): d for w, d in SPELLED.items() for f in (w, w.capitalize(), w.upper())}
        self.digit_words = frozenset(self.digit_of)
        at = alt("at", "собака", "собачка", "et", "majmun", "@", "эт")
        dot = alt("dot", "точка", "tačka", "tacka", "\\.", "тчк")
        self.at = re.compile(rf" ?[\[({{<] ?(?:{at}) ?[\])}}>] ?")
        self.dot = re.compile(rf" ?[\[({{<] ?(?:{dot}) ?[\])}}>] ?")
        word = "[A-Za-z0-9]"
        bare_at, bare_dot = rf"(?:{alt('собака', 'at', 'et')})", rf"(?:{alt('точка', 'dot', 'tačka')})"
        self.bare = re.compile(rf"(?<=[A-Za-z0-9]) {bare_at} (?={word}[\w-]* {bare_dot} [A-Za-z]{{2,}}(?!\w))")
        self.said_dots = [f" {w} " for w in alt("точка", "dot", "tačka").split("|")]
        self.bare_dot = re.compile(rf"(?<=[A-Za-z0-9]) {bare_dot} (?=[A-Za-z]{{2,}}(?!\w))")
        self.email = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
        label = alt("личный номер", "матичный номер", "lični broj", "паспорт\\w*", "документ\\w*", "удостоверени\\w+", "ИНН", "СНИЛС", "ЈМБГ", "ЛНП", "JMBG", "matični broj", "матични број", "lična karta", "lične karte", "личная карта", "личная карточка", "pasoš\\w*", "passport", "ID number", "ID card", "identity (?:card|number)", "national ID", "broj pasoša", "lk")
        number = r"\d{13}|\d{7}[ -]\d{6}|\d{2} ?\d{2} ?\d{6}|[A-Z]{1,2} ?\d{6,9}|\d{3}-\d{3}-\d{3} \d{2}|\d{9,12}|\d{4} \d{6}"
        self.id = re.compile(rf"(?<!\w)(?:{label})(?: (?:{alt('no\\.?', 'br\\.?', 'номер', 'is', 'je')}))?[ :№#.-]{{0,4}}({number})(?![\w])")
        self.personal = re.compile(r"(?<![\w-])(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])[09]\d{2} ?\d{6}(?![\w])")
        gap = r"[ ()/.-]{0,3}"
        self.phone = re.compile(
            rf"(?<![\w@/-])(?:\+{gap}381|00 ?381)(?:{gap}\d){{8,9}}(?![ -]?\d|\w)"
            rf"|(?<![\w@/-])\+(?!381)\d{{1,3}}(?:{gap}\d){{7,11}}(?!\d|\w)"
            rf"|(?<![\w@/+-])\(?0 ?[1-9](?:{gap}\d){{7,8}}(?![ -]?\d|\w)"
            r"|(?<![\w@/+-])381[ -]?6\d(?:[ /-]?\d){6,7}(?!\d|\w)"
        )
        self.not_phone = re.compile(rf"(?:№|#|\b(?:{alt('no', 'br')})\.|{alt('заказ', 'артикул')}|\bAR-) ?$")
        upper = "".join(sorted({sk(c) for c in "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЂЈЉЊЋЏABCDEFGHIJKLMNOPQRSTUVWXYZČĆŠĐŽ"}))
        up = f"[{upper}]"
        self.up = up
        name = rf"{up}[\w'’]*(?:-{up}\w*)?"
        names = rf"{name}(?: {name}){{0,3}}"
        house = rf"\d{{1,4}}(?: ?[{''.join(sorted({sk(c) for c in 'абвгдеж'}))}a-hA-H](?!\w))?(?:/\d{{1,4}}\w?)?(?!\d)"
        flat = rf"(?:,? ?(?:{alt('кв', 'квартира', 'stan', 'flat', 'apt')})\.? ?\d+)?"
        ru = alt("улица", "ул\\.?", "бульвар", "бул\\.", "б-р", "переулок", "пер\\.", "проспект", "пр-т\\.?", "просп\\.", "набережная", "наб\\.", "площадь", "пл\\.", "шоссе", "аллея", "проезд", "ulica", "ul\\.?", "bulevar", "bul\\.", "trg", "aleja", "sokak", "put")
        dom = rf"(?:,? ?(?:{alt('дом', 'д\\.')})|,? ?(?:{alt('br')})\.?|,)? ?"
        en = alt("street", "st\\.?", "lane", "road", "rd\\.?", "avenue", "ave\\.?", "square", "alley", "drive", "boulevard", "court", "way")
        place = alt("адрес", "мы находимся", "приём тут", "мы тут", "adresa", "lokacija", "nalazimo se", "address", "location", "find us at", "we are at", "📍")
        self.street = re.compile(rf"(?<!\w)(?:{ru}) ?{names}{dom}{house}{flat}")
        self.english = re.compile(rf"(?<![\w/])\d{{1,4}}[A-Za-z]? {names} (?:{en})(?!\w){flat}|(?<!\w){names} (?:{en}) {house}{flat}")
        self.placed = re.compile(rf"(?:(?<!\w)|(?<=📍))(?:{place})[ :-]{{0,4}}({names}{dom}{house}{flat})")
        self.first = {sk(f) for n in first_names for f in (n, n.upper())}
        self.digit = re.compile(r"\d")
        self.capital = re.compile(rf"(?<![\w'’-]){up}[^\W\d_]+")
        self.after = re.compile(rf" ({up}[^\W\d_]{{3,}}(?:['’-][^\W\d_]+)*)")
        self.surname = re.compile(rf"{up}[^\W\d_]{{3,}}(?:['’-][^\W\d_]+)*")
        self.inner = frozenset("'’-")
        self.initials = re.compile(rf"(?<!\w)({up}\w{{3,}}(?:-{up}\w+)?) ({up}\. ?{up}\.)|(?<!\w){up}\. ?{up}\. ?({up}\w{{3,}})")
        family = alt("ов", "ев", "ёв", "ин", "ын", "ова", "ева", "ёва", "ина", "ына", "ский", "ская", "цкий", "цкая", "енко", "чук", "юк", "ян", "ић", "ić", "ski", "ska", "ac", "ar", "ev", "ov")
        self.family = re.compile(rf"(?:{family})$")
        cue = alt(*map(re.escape, PERSON_CUES))
        self.cue = re.compile(rf"(?:^|\W)(?:{cue})[ ,:-]{{1,3}}$")
        self.cue_reach = max(map(len, PERSON_CUES)) + 4  # a cue, what stands before it and the marks behind it
        plain = rf"{up}[^\W\d_]+(?:['’-][^\W\d_]+)*"
        self.announced = re.compile(rf"(?<!\w)(?:{cue})[ ,:-]{{1,3}}({plain} {plain})(?![\w'’-])")

    @staticmethod
    def _upper(pattern: str) -> str:
        """Capital letters, but for the escapes of a pattern."""
        return re.sub(r"\\.|[^\\]", lambda m: m.group() if m.group()[0] == "\\" else m.group().upper(), pattern)

    def normal(self, src: str) -> Mapped:
        text = src.translate(self.single)
        n = len(src)
        if len(text) == n and not self.marks.search(text):
            m = Mapped(text, None, src)
        else:
            out: list[str] = []
            at: list[int] = []
            if not self.marks.search(text):
                out, at = [text], [i for i, ch in enumerate(src) if ch not in self.dropped]
                src_chars = ""
            else:
                src_chars = src
            for i, ch in enumerate(src_chars):
                to = self.single.get(ord(ch), ch)
                if not to:
                    continue
                if "̀" <= to <= "ͯ" and out:
                    joined = unicodedata.normalize("NFC", out[-1] + to)
                    out[-1] = transducer().single.get(ord(joined), joined) if len(joined) == 1 else out[-1]
                    continue
                out.append(to)
                at.append(i)
            m = Mapped("".join(out), at, src)
        if not self.digit_words.isdisjoint(self.word.findall(m.text)):
            # The marks between the digits go, so a number is found whatever they are.
            m = m.rewrite([(*w.span(), self.digit_of.get(w.group(), "")) for hit in self.spelled.finditer(m.text) for w in self.spelled_part.finditer(m.text, *hit.span())])
        if "(" in m.text or "[" in m.text or "{" in m.text or "<" in m.text:
            m = m.rewrite([(h.start(), h.end(), "@") for h in self.at.finditer(m.text)])
            m = m.rewrite([(h.start(), h.end(), ".") for h in self.dot.finditer(m.text)])
        if any(w in m.text for w in self.said_dots) and (hits := [(h.start(), h.end(), "@") for h in self.bare.finditer(m.text)]):
            m = m.rewrite(hits)
            m = m.rewrite([(h.start(), h.end(), ".") for h in self.bare_dot.finditer(m.text)])
        return m

    def _word_before(self, text: str, i: int) -> tuple[int, str] | None:
        """The surname that ends with a blank right before ``i``."""
        if i < 2 or text[i - 1] != " ":
            return None
        k = i - 1
        while k and (text[k - 1].isalpha() or text[k - 1] in self.inner):
            k -= 1
        m = self.surname.fullmatch(text, k, i - 1)
        return None if m is None or (k and (text[k - 1] == "@" or text[k - 1] == "_" or text[k - 1].isalnum())) else (k, m.group())

    def _people(self, text: str) -> Iterator[tuple[int, int]]:
        announced = lambda i: self.cue.search(text[max(0, i - self.cue_reach) : i])
        for w in self.capital.finditer(text):
            if w.group() not in self.first:
                continue
            i, j = w.span()
            after, before = self.after.match(text, j), self._word_before(text, i)
            if after and after.group(1) not in self.first and (self.family.search(after.group(1)) or w.group().isascii() or announced(i)):
                yield i, after.end(1)
            elif before and before[1] not in self.first and (self.family.search(before[1]) or announced(before[0])):
                yield before[0], j
        for h in self.initials.finditer(text):
            s = h.group(1) or h.group(3)
            if self.family.search(s) or announced(h.start()):
                yield h.start(), h.end()
        for h in self.announced.finditer(text):
            yield h.span(1)

    def items(self, src: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points of the stored text, in order, without overlaps."""
        if not src:
            return []
        m = self.normal(src)
        text = m.text
        found: list[tuple[int, int, str]] = []  # in order, apart from one another

        def take(i: int, j: int, kind: str) -> None:
            k = bisect_left(found, (i,))
            if (k == 0 or found[k - 1][1] <= i) and (k == len(found) or j <= found[k][0]):
                insort(found, (i, j, kind))

        if "@" in text:
            for h in self.email.finditer(text):
                take(*h.span(), "email")
        if self.digit.search(text):
            for h in self.id.finditer(text):
                take(*h.span(1), "id_number")
            for h in self.personal.finditer(text):
                take(*h.span(), "id_number")
            for h in self.phone.finditer(text):
                if not self.not_phone.search(text[max(0, h.start() - 10) : h.start()]):
                    take(*h.span(), "phone")
            for rx, g in ((self.street, 0), (self.english, 0), (self.placed, 1)):
                for h in rx.finditer(text):
                    take(*h.span(g), "street_address")
        for i, j in self._people(text):
            take(i, j, "person_name")
        return [(kind, *m.source(i, j)) for i, j, kind in found]

    def redact(self, src: str | None) -> str | None:
        if not src:
            return src
        out, k = [], 0
        for kind, i, j in self.items(src):
            out += [src[k:i], f"[{kind.upper()}]"]
            k = j
        return "".join(out) + src[k:]


@lru_cache(maxsize=4)
def detector(first_names: tuple[str, ...] | None = None) -> Detector:
    return Detector() if first_names is None else Detector(first_names)


def find_items(df: DataFrame, key: str, text: str, first_names: tuple[str, ...] | None = None) -> DataFrame:
    """(record_key, pii_type, start_pos, end_pos): the items of every row with a key and a text.

    ``first_names`` replaces the built-in list.
    """

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d = detector(first_names)
        for p in parts:
            rows = [(k, kind, i, j) for k, t in zip(p["k"], p["t"]) for kind, i, j in d.items(t)]
            yield pd.DataFrame(rows, columns=["record_key", "pii_type", "start_pos", "end_pos"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null and t <> ''")
    return rows.mapInPandas(run, "record_key string, pii_type string, start_pos int, end_pos int")


def redacted(col: Column, first_names: tuple[str, ...] | None = None) -> Column:
    """The text with every item replaced by its typed placeholder; all else is unchanged."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        d = detector(first_names)
        return s.map(d.redact, na_action="ignore")

    return run(col)
