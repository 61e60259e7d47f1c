"""Contacts, prices, places and categories in post texts, as array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postweave.functions import text as T

# Contact patterns.
PHONE = r"(?<!\d)(?:\+?\d[\d\s\-()]{7,}\d)"
EMAIL = r"(?U)\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b"
LINK = r"(?i)https?://t\.me/[A-Za-z0-9_+/]+"
HANDLE = r"(?U)(?<!\w)@[A-Za-z0-9_]{4,}"
SITE = r"(?i)https?://[^\s<>()]+"
# Words before a contact; hosts that are no website of the provider.
PHONE_MARKERS = ("tel", "тел", "phone", "telefon", "telefon:", "mob", "wa", "viber", "whatsapp")
MESSENGER_MARKERS = ("telegram", "tg", "телеграм", "телега", "t.me")
OTHER_HOSTS = ("t.me/", "instagram.com/", "facebook.com/", "wa.me/")
# What a price looks like.
_CUR = "(?:€|\\$|eur|euro|rsd|din|usd|dinar|дин|евро)"
_EDGE, _END = "(?<![\\p{L}\\p{N}_])", "(?![\\p{L}\\p{N}_])"
PRICE = (
    rf"(?iu)(?:€\s*[0-9][0-9\s.,]*|\$\s*[0-9][0-9\s.,]*|(?<![0-9])[0-9][0-9\s.,]*{_CUR}|(?=[цсp]){_EDGE}(?:цена|стоимость|price){_END}[:\s]*[0-9][0-9\s.,]*{_CUR}?"
    rf"|(?=[fо]){_EDGE}(?:from|от){_END}[:\s]*[0-9][0-9\s.,]*{_CUR}|[0-9]{{1,3}}%)"
)
PRICE_MARKERS = ("цена", "стоимость", "price")
# City words, in order of preference.
CITIES = {"belgrade": ("белград", "belgrade", "beograd"), "novi_sad": ("нови сад", "novi sad"), "nis": ("ниш", "niš", "nis"), "subotica": ("суботица", "subotica")}

KINDS = ("phone", "email", "telegram_handle", "telegram_link", "website")


def _all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def _found(kind: str, raw: Column, value, pass_no: int) -> Column:  # noqa: ANN001
    """Structs of the non-empty values of an array of raw matches."""
    return F.filter(F.transform(raw, lambda x: F.struct(F.lit(kind).alias("kind"), value(x).alias("value"), T.normalize_text(x).alias("raw"), F.lit(pass_no).alias("pass_no"))), lambda s: s["value"] != "")


def contact_matches(c: Column, norm: Column | None = None) -> Column:
    """array<struct<kind, value, raw, pass_no>>: raw text, normal text, then what follows a marker; the first pass wins."""
    return T.let(T.or_empty(c), lambda raw: T.let(T.normalize_text(raw) if norm is None else norm, lambda n: _matches(raw, n)))


def _matches(c: Column, norm: Column) -> Column:
    parts = []
    # The second pass has nothing to add where the normal form is the text itself.
    other = F.when(c == norm, F.lit("")).otherwise(norm)
    for no, t in ((1, c), (2, other)):
        # A pattern is tried only where the sign it cannot do without stands.
        none = F.array().cast("array<string>")
        with_at = lambda p, t=t: F.when(t.contains("@"), _all(t, p)).otherwise(none)
        with_scheme = lambda p, t=t: F.when(t.contains("://"), _all(t, p)).otherwise(none)
        site = F.filter(with_scheme(SITE), lambda u: ~T.contains_any(F.lower(u), OTHER_HOSTS))
        parts += [
            _found("phone", _all(t, PHONE), T.normalize_phone, no),
            _found("email", with_at(EMAIL), F.lower, no),
            _found("telegram_link", with_scheme(LINK), T.normalize_url, no),
            _found("telegram_handle", with_at(HANDLE), T.normalize_handle, no),
            _found("website", site, T.normalize_website, no),
        ]
    marked = lambda words, value: f"(?iu)(?:{'|'.join(w.replace('.', chr(92) + '.') for w in sorted(words, key=len, reverse=True))})[:\\s\\-]*({value})"
    parts += [
        _found("phone", _all(norm, marked(PHONE_MARKERS, r"\+?\d[\d\s\-()]{6,}\d"), 1), T.normalize_phone, 3),
        _found("telegram_handle", _all(norm, marked(MESSENGER_MARKERS, r"@?[A-Za-z0-9_]{4,}"), 1), T.normalize_handle, 3),
    ]
    return T.let(F.concat(*parts), _earliest)


def _earliest(both: Column) -> Column:
    keys = F.array_distinct(F.transform(both, lambda m: F.struct(m["kind"].alias("kind"), m["value"].alias("value"))))
    # filter keeps order, so the first match of a key is that of the earliest pass.
    return F.array_sort(F.transform(keys, lambda k: F.get(F.filter(both, lambda m: (m["kind"] == k["kind"]) & (m["value"] == k["value"])), F.lit(0))))


def values_of(matches: Column, kind: str) -> Column:
    """The sorted distinct values of one kind."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(matches, lambda m: m["kind"] == kind), lambda m: m["value"])))


def price_texts(c: Column, norm: Column | None = None) -> Column:
    """Sorted distinct price mentions; without one, the marked lines that hold a digit."""
    norm = T.normalize_text(c) if norm is None else norm
    found = F.when(norm.rlike("[0-9]"), F.transform(_all(norm, PRICE), lambda x: F.trim(x))).otherwise(F.array().cast("array<string>"))
    lines = F.transform(F.split(T.or_empty(c), "[\\r\\n|]+"), T.normalize_text)
    said = T.contains_any(F.lower(T.or_empty(c)), PRICE_MARKERS) | T.contains_any(F.lower(norm), PRICE_MARKERS)
    marked = F.filter(F.when(said, lines).otherwise(F.array().cast("array<string>")), lambda x: T.contains_any(F.lower(x), PRICE_MARKERS) & x.rlike("\\d"))
    return F.array_sort(F.array_distinct(F.when(F.size(found) > 0, found).otherwise(F.transform(marked, lambda x: F.substring(x, 1, 80)))))


def currency_hints(prices: Column) -> Column:
    return T.let(F.lower(F.array_join(prices, " ")), lambda j: F.array_compact(F.array(F.when(j.rlike("€|eur|евро"), "eur"), F.when(j.rlike("rsd|din|дин"), "rsd"), F.when(j.rlike("\\$|usd"), "usd"))))


def city_signal(c: Column, cities: dict[str, tuple[str, ...]] | None = None, norm: Column | None = None) -> Column:
    """struct<city, matched>: the first city of the list of which a word occurs anywhere."""
    return T.let(F.lower(T.normalize_text(c) if norm is None else norm), lambda low: _city(low, cities or CITIES))


def _city(low: Column, cities: dict[str, tuple[str, ...]]) -> Column:
    hits = F.array(*[F.struct(F.lit(city).alias("city"), F.filter(F.array(*map(F.lit, words)), lambda w: low.contains(w)).alias("matched")) for city, words in cities.items()])
    none = F.struct(F.lit(None).cast("string").alias("city"), F.array().cast("array<string>").alias("matched"))
    return F.coalesce(F.get(F.filter(hits, lambda h: F.size(h["matched"]) > 0), F.lit(0)), none)


# Words of categories, and words that speak against one.
CATEGORIES = {
    "beauty_hair": ("барбер", "парикмах", "стриж", "окраш", "šišanje", "haircut"),
    "beauty_nails": ("маникюр", "педикюр", "ногт", "manikir", "manicure", "nail"),
    "cleaning": ("уборк", "клининг", "химчист", "мытьё окон", "čišćenje", "cleaning"),
    "home_repair": ("ремонт", "сантех", "электр", "плитк", "покраск", "krečenje", "tiling"),
    "auto_service": ("шиномонтаж", "автосервис", "замена масла", "полировк", "zamena guma", "diagnost"),
    "transport": ("переезд", "доставк", "трансфер", "selidb", "moving", "transfer"),
    "it_digital": ("таргет", "smm", "дизайн", "сайт", "разработ", "маркетинг", "frontend", "backend"),
    "pets": ("собак", "кошк", "ветерин", "грум", "pet"),
}
CATEGORY_VETOES = {"it_digital": ("дизайнерский ремонт",), "auto_service": ("автопарк",)}


def category_hints(c: Column, rules: dict[str, tuple[str, ...]] | None = None, vetoes: dict[str, tuple[str, ...]] | None = None, norm: Column | None = None) -> Column:
    """array<struct<score, code, confidence, matched>>, best first.

    Score = distinct words found less vetoes found, kept if positive; without any, the hashtags are scored; if the best
    score is at least 2, scores below best - 1 or below 2 go.
    """
    rules, vetoes = rules or CATEGORIES, vetoes if vetoes is not None else CATEGORY_VETOES

    def scored(low: Column) -> Column:
        one = []
        for code, words in rules.items():
            hit = F.array_compact(F.array(*[F.when(low.contains(w), w) for w in words]))
            one.append(F.struct((F.size(hit) - T.count_phrases(low, vetoes.get(code, ()))).alias("score"), F.lit(code).alias("code"), F.array_sort(hit).alias("matched")))
        return F.filter(F.array(*one), lambda s: s["score"] > 0)

    return T.let(T.normalize_text(c) if norm is None else norm, lambda n: _hints(n, scored))


def _hints(norm: Column, scored: Callable[[Column], Column]) -> Column:
    tags = F.array_join(F.array_sort(F.array_distinct(F.transform(_all(norm, "#([A-Za-zЀ-ӿ0-9_]{3,})", 1), lambda x: F.lower(x)))), " ")
    own = T.let(F.lower(norm), scored)
    return T.let(own, lambda s: T.let(F.when(F.size(s) > 0, s).otherwise(T.let(tags, scored)), _best_hints))


def _best_hints(s: Column) -> Column:
    top = F.coalesce(F.array_max(F.transform(s, lambda x: x["score"])), F.lit(0))
    s = T.let(top, lambda top: F.filter(s, lambda x: (top < 2) | ((x["score"] >= top - 1) & (x["score"] >= 2))))
    grade = lambda x: F.when(x["score"] >= 3, "high").when(x["score"] == 2, "medium").otherwise("low")
    s = F.transform(s, lambda x: F.struct((-x["score"]).alias("order"), x["code"].alias("code"), x["score"].alias("score"), grade(x).alias("confidence"), x["matched"].alias("matched")))
    return F.transform(F.array_sort(s), lambda x: F.struct(x["score"].alias("score"), x["code"].alias("code"), x["confidence"].alias("confidence"), x["matched"].alias("matched")))


def identity_signals(matches: Column, handle: Column, profile_url: Column, hash_: Column) -> Column:
    """Sorted identity keys of the contacts and the author, with a weak key by text."""
    prefix = {"phone": "phone:", "email": "email:", "telegram_handle": "tg:", "telegram_link": "tg_link:", "website": "site:"}
    own = F.transform(matches, lambda m: F.concat(F.element_at(F.create_map(*[F.lit(x) for kv in prefix.items() for x in kv]), m["kind"]), m["value"]))
    h, u = T.normalize_handle(handle), T.normalize_url(profile_url)
    author = F.array_compact(F.array(F.when(h != "", F.concat(F.lit("tg:"), h)), F.when(u != "", F.concat(F.lit("tg_link:"), u)), F.when(T.or_empty(hash_) != "", F.concat(F.lit("weak_text:"), hash_))))
    return F.array_sort(F.array_distinct(F.concat(own, author)))
