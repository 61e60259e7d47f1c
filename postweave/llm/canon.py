"""Problem 3: one canonical form for texts that look the same.

A compiled longest-match transducer over grapheme clusters, one pass from left to right.  Its rules come from Unicode
properties plus one short table of look-alike letters; they are compiled once and checked for conflicts:

* invisible characters (format characters, variation selectors, soft hyphen) vanish; a zero-width joiner stays
  between two pictographs, where it changes the picture;
* every blank (category Zs, tab) is one ordinary blank; blanks at line ends vanish; CR LF, CR, NEL, LS and PS are LF;
* full-width, half-width and mathematical forms and Roman numerals become the ordinary letters and digits;
* a base letter with combining marks, and whatever is invisible between them, is one cluster and gets its composed form;
* look-alike letters of other scripts become the Latin letter, also under accents.

At each place the longest rule holds: those of several characters (clusters, line ends, joined pictures) are read
from the one character each of them must hold, and the stretches between them, where only rules of one character can
hold, are translated as a block.  Case, punctuation, other letters, visible accents and line breaks stay different.  Null stays null, the
empty text stays empty.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.session import cut

# Look-alike letter -> Latin letter.
LOOKALIKES = {
    # Cyrillic capitals
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ѵ": "V", "Ӏ": "I",
    # Cyrillic small letters
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ү": "y", "ӏ": "l",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "α": "a", "ρ": "p", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    # Latin letters of phonetic alphabets
    "ɑ": "a", "ɡ": "g", "ʏ": "Y", "ʜ": "H", "ꜱ": "s", "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z",
    # Armenian
    "օ": "o", "հ": "h", "ս": "u", "Տ": "S", "Օ": "O",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S",
    "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}

ZWJ = "\u200d"
_MARK = "\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20dc\u20e1\u20e5-\u20f0\u3099\u309a\ufe20-\ufe2f\uff9e\uff9f"
_PICT = "\u2190-\u21ff\u2300-\u27bf\u2b00-\u2bff\U0001f000-\U0001faff"


_FORMS = ("<wide>", "<narrow>", "<font>")
_HIDDEN = frozenset([0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)])
# Scripts without any of these forms; they are not looked through.
_ALIKE_IN = (range(0x80, 0x3400), range(0xA000, 0xAC00), range(0xE000, 0x20000), range(0xE0000, 0xE0200))


def _composed(cluster: str, letters: dict[str, str]) -> str:
    """Canonical form of one cluster: width and form, then decomposed look-alikes, then composed again."""
    out = []
    for ch in cluster:
        kind = unicodedata.decomposition(ch)
        plain = kind.startswith(_FORMS) or "\u2160" <= ch <= "\u217f"
        out.append(unicodedata.normalize("NFKC", ch) if plain else ch)
    parts = unicodedata.normalize("NFD", "".join(out))
    return unicodedata.normalize("NFC", "".join(letters.get(c, c) for c in parts))


def _class(chars: Iterable[str]) -> str:
    return "".join(map(re.escape, sorted(chars)))


class Transducer:
    """Compiled form of the mapping; ``letters`` may be narrowed (``{}`` keeps scripts apart)."""

    def __init__(self, letters: dict[str, str] = LOOKALIKES) -> None:
        self.letters = letters
        hidden, blanks, ends = {ZWJ}, {"\t"}, {"\r", "\x0b", "\x0c", "\x85", "\u2028", "\u2029"}
        single: dict[int, str] = {}
        for ch in (chr(cp) for r in _ALIKE_IN for cp in r if not 0xD800 <= cp <= 0xDFFF):
            cat = unicodedata.category(ch)
            if cat == "Cn":
                continue
            if cat == "Cf" or ord(ch) in _HIDDEN:
                hidden.add(ch)
            elif cat == "Zs":
                blanks.add(ch)
            elif cat[0] in "LNPS" or unicodedata.decomposition(ch):
                if (to := _composed(ch, letters)) != ch:
                    single[ord(ch)] = to
        for group, to in ((hidden, ""), (blanks, " "), (ends, "\n")):
            for ch in group:
                if single.setdefault(ord(ch), to) != to:
                    raise ValueError(f"conflict: U+{ord(ch):04X} has two rules")
        self.single = single
        # Each rule of several characters has one that few texts hold; the rule is read from there.
        h, n = _class(hidden), _class(ends | {"\n"})
        self._hidden, self._tail = frozenset(hidden), frozenset(hidden | blanks | {" "})
        self._no_base = frozenset(hidden | blanks | ends | {" ", "\n"})
        self._marks = re.compile(f"[{_MARK}](?:[{h}]*[{_MARK}])*")
        self._end = re.compile(f"\r\n|[{n}]|\\Z")
        self._pict = re.compile(f"[{_PICT}]")
        self._several = re.compile(f"[{_MARK}{ZWJ}]")
        self._known: dict[str, str] = {}
        self._check()

    def _check(self) -> None:
        """No output is an input again, alone or with what may stand beside it, and every stored form of a letter agrees."""
        for a, to in self.letters.items():
            if len(a) != 1 or len(to) != 1 or to in self.letters:
                raise ValueError(f"conflict: {a!r} maps to {to!r}, which maps further")
        for cp, to in self.single.items():
            if self(to) != to and to.strip(" "):
                raise ValueError(f"conflict: U+{cp:04X} maps to {to!r}, which maps further")
            if to and unicodedata.combining(to[0]) and unicodedata.category(chr(cp))[0] != "M" and not re.match(f"[{_MARK}]", chr(cp)):
                raise ValueError(f"conflict: U+{cp:04X} would join the letter before it")
        for ch in (chr(cp) for r in (range(0xC0, 0x530), range(0x1E00, 0x2000)) for cp in r):
            parts = unicodedata.normalize("NFD", ch)
            if len(parts) > 1 and self(parts) != self(ch):
                raise ValueError(f"conflict: U+{ord(ch):04X} and its parts differ")

    def _cluster(self, c: str) -> str:
        got = self._known.get(c)
        if got is None:
            got = _composed("".join(ch for ch in c if self.single.get(ord(ch)) != ""), self.letters)
            if len(self._known) < 65_536:
                self._known[c] = got
        return got

    def _long(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, output) of every place where a rule of several characters holds, in order."""
        out = []
        for m in self._marks.finditer(text):
            i, j = m.span()
            while i and text[i - 1] in self._hidden:
                i -= 1
            if i and text[i - 1] not in self._no_base:
                out.append((i - 1, j, self._cluster(text[i - 1 : j])))
        i = text.find(ZWJ)
        while i >= 0:
            k = i - 2 if text[i - 1 : i] == "\ufe0f" else i - 1
            if k >= 0 and self._pict.match(text[k]) and self._pict.match(text[i + 1 : i + 2]):
                out.append((i, i + 1, ZWJ))
            i = text.find(ZWJ, i + 1)
        for m in self._end.finditer(text):
            i, j = m.span()
            while i and text[i - 1] in self._tail:
                i -= 1
            if i < m.start():
                out.append((i, m.start(), ""))
            if j - m.start() == 2:
                out.append((j - 2, j, "\n"))
        return sorted(out)

    def __call__(self, text: str) -> str:
        if "\r\n" not in text and not self._several.search(text):
            plain = text if text.isascii() and not any(c in text for c in "\t\r\x0b\x0c") else text.translate(self.single)
            if " \n" not in plain and not plain.endswith(" "):
                return plain
        out, k = [], 0
        for i, j, to in self._long(text):
            out += [text[k:i].translate(self.single), to]
            k = j
        out.append(text[k:].translate(self.single))
        return "".join(out)


@lru_cache(maxsize=4)
def transducer(lookalikes: bool = True) -> Transducer:
    return Transducer(LOOKALIKES if lookalikes else {})


def canonical_text(col: Column, lookalikes: bool = True) -> Column:
    """The canonical form of a text column."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        t = transducer(lookalikes)
        return s.map(lambda x: None if x is None else t(x), na_action="ignore")

    return run(col)


def fingerprints(df: DataFrame, key: str, text: str, form: Callable[[str], str] | None = None) -> DataFrame:
    """(key, look, raw) for each row with a visible text: 128-bit prints of the canonical and the stored text.

    Only the prints leave the Python workers, so no text is shuffled afterwards.
    """

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = form or transducer()
        mark = lambda x: hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        for p in parts:
            look = [t(x) for x in p["t"]]
            keep = [bool(x.strip()) for x in look]
            yield pd.DataFrame({
                "key": [k for k, ok in zip(p["k"], keep) if ok],
                "look": [mark(x) for x, ok in zip(look, keep) if ok],
                "raw": [mark(x) for x, ok in zip(p["t"], keep) if ok],
            })

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null and t <> ''")
    return rows.mapInPandas(run, "key string, look binary, raw binary")


def look_alike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(record_key, class_key, links) of the records whose text looks like a different one.

    A class is named by its smallest key; links counts the records of other keys with another text of the class, once
    for each own text.  Counts only, so no pair is built whatever the size of a class.
    """
    recs = cut(fingerprints(df, key, text).groupBy("key", "look", "raw").agg(F.lit(1).alias("one")).drop("one"))
    per_text = recs.join(recs.groupBy("key", "look").agg(F.count("*").alias("mine")), ["key", "look"])
    same = per_text.groupBy("look", "raw").agg(F.count("*").alias("same"), F.min("key").alias("low"))
    whole = same.groupBy("look").agg(F.sum("same").alias("all"), F.count("*").alias("texts"), F.min("low").alias("class_key")).where("texts > 1")
    rows = per_text.join(same.select("look", "raw", "same").join(whole, "look"), ["look", "raw"])
    per = rows.groupBy("key", "look", "class_key").agg(F.sum(F.col("all") - F.col("same") - F.col("mine") + 1).alias("links"))
    return per.where("links > 0").select(F.col("key").alias("record_key"), "class_key", "links")


def look_alike_pairs(df: DataFrame, key: str, text: str, hot: int = 20_000) -> DataFrame:
    """(key_a, key_b): records of different keys whose texts look the same but are different strings.

    Rows without key or visible text are no case; a key with several rows counts once per text.  A class is split
    into its stored texts first and only different texts meet, so copies are never compared with one another and the
    work is that of the result.  A text with more than ``hot`` records is split over ``ceil(n / hot)`` salts, so that
    no task holds it whole; every pair is still produced.
    """
    recs = cut(fingerprints(df, key, text).groupBy("key", "look", "raw").agg(F.lit(1).alias("one")).drop("one"))
    texts = recs.groupBy("look", "raw").agg(F.count("*").alias("n"))
    mixed = texts.groupBy("look").agg(F.count("*").alias("texts")).where("texts > 1").select("look")
    texts = cut(texts.join(mixed, "look").withColumn("salts", F.ceil(F.col("n") / F.lit(hot)).cast("int")))
    one = texts.select("look", F.col("raw").alias("raw_a"), "salts")
    met = one.join(texts.select("look", F.col("raw").alias("raw_b")), "look").where("raw_a < raw_b")
    right = met.join(recs.select("look", F.col("raw").alias("raw_b"), F.col("key").alias("kb")), ["look", "raw_b"])
    right = right.select("look", "raw_a", "kb", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    left = recs.select("look", F.col("raw").alias("raw_a"), F.col("key").alias("ka")).join(one, ["look", "raw_a"])
    left = left.select("look", "raw_a", "ka", F.pmod(F.xxhash64("ka"), F.col("salts")).cast("int").alias("salt"))
    pairs = left.join(right, ["look", "raw_a", "salt"]).where("ka <> kb")
    return pairs.select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b")).distinct()


_WORDS = re.compile(r"[^\W_]+")


@lru_cache(maxsize=1)
def _fold() -> dict[int, str]:
    """Case and look-alikes together: each letter goes by its capital, whose look-alike is then made small."""
    t = transducer().single
    out = {}
    for cp in (*range(0x41, 0x5B), *range(0xC0, 0x530), *range(0x1E00, 0x2000)):
        up = chr(cp).upper()
        if len(up) == 1:
            to = t.get(ord(up), up).lower()
            if to != chr(cp):
                out[cp] = to
    return out


def fold_words(text: str | None) -> list[str]:
    """The words (runs of letters and digits) of a text, without regard to case, look-alikes or hidden characters."""
    return _WORDS.findall(transducer()(text).translate(_fold())) if text else []
