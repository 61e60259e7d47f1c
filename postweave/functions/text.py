"""Column functions on text: normal forms, tokens, similarity, shortening.  All stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points read as digits, in the order 0-9, and the blanks and zero-width marks of the normal form.
CIRCLED_DIGITS = "⓪①②③④⑤⑥⑦⑧⑨"
ARABIC_INDIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ZERO_WIDTH = "[\\u200b-\\u200f\\u2060\\ufeff]"
BLANKS = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
# Words that say nothing about a service.
STOPWORDS = ("и", "в", "на", "с", "по", "для", "из", "от", "до", "за", "the", "and", "for", "with", "a", "an", "of", "to", "in", "on", "или", "как", "мы", "вы", "это", "все", "our", "you", "we")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is evaluated once, however often ``f`` or lambdas in it name it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def plain_digits(c: Column) -> Column:
    """Keycap, circled and Arabic-Indic digits as ordinary ones."""
    c = F.regexp_replace(or_empty(c), "([0-9])\\ufe0f\\u20e3", "$1")
    return F.translate(c, CIRCLED_DIGITS + ARABIC_INDIC_DIGITS, "0123456789" * 2)


def normalize_text(c: Column) -> Column:
    """Digits plain, zero-width marks gone, any run of blanks one blank, trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.regexp_replace(plain_digits(c), ZERO_WIDTH, ""), BLANKS, " "))


def text_hash(c: Column, norm: Column | None = None) -> Column:
    """sha1 of the small-letter normal form, which may be given."""
    return F.sha1(F.lower(normalize_text(c) if norm is None else norm).cast("binary"))


def published_text_hash(c: Column) -> Column:
    """sha1 of the stripped text as it stands, empty for a blank one."""
    t = F.regexp_replace(or_empty(c), f"^{BLANKS}|{BLANKS}$", "")
    return F.when(t == "", "").otherwise(F.sha1(t.cast("binary")))


def stable_hash(*parts: Column) -> Column:
    """sha1 of the parts joined by the unit separator; null counts as empty."""
    return F.sha1(F.concat_ws("\x1f", *[or_empty(p.cast("string")) for p in parts]).cast("binary"))


def normalize_phone(c: Column) -> Column:
    """Digits only; empty under eight."""
    d = F.regexp_replace(plain_digits(c), "[^0-9]", "")
    return F.when(F.length(d) >= 8, d).otherwise("")


def normalize_handle(c: Column) -> Column:
    """Small letters without sign or address, first path part only."""
    v = F.lower(normalize_text(c))
    v = F.regexp_replace(v, "^@", "")
    v = F.when(v.rlike("^https?://"), F.btrim(F.regexp_replace(F.regexp_replace(v, "^https?://[^/?#]*", ""), "[?#].*$", ""), F.lit("/"))).otherwise(v)
    return F.btrim(F.split_part(v, F.lit("/"), F.lit(1)), F.lit(" .,:;"))


def normalize_url(c: Column) -> Column:
    """Scheme and host in small letters, path without closing slash, no query or fragment; else all in small letters."""
    v = F.btrim(normalize_text(c), F.lit(".,);]"))
    host = F.regexp_extract(v, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    path = F.regexp_extract(v, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    return F.when(host == "", F.lower(v)).otherwise(F.concat(F.lower(host), F.regexp_replace(path, "/+$", "")))


def normalize_website(c: Column) -> Column:
    """The normal URL without scheme and www."""
    return F.regexp_replace(F.regexp_replace(normalize_url(c), "^[a-z][a-z0-9+.-]*://", ""), "^www\\.|/+$", "")


def tokens(c: Column, least: int = 3, drop: tuple[str, ...] = STOPWORDS, norm: Column | None = None) -> Column:
    """Sorted distinct words of at least ``least`` letters that are no number and no stopword."""
    words = F.regexp_extract_all(F.lower(normalize_text(c) if norm is None else norm), F.lit("([0-9a-zа-яё]+)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (F.length(w) >= least) & ~w.rlike("^[0-9]+$") & ~w.isin(*drop))))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct items; 0 if either side is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / F.size(F.array_union(a, b)))


def contains_any(c: Column, phrases: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, phrases)), lambda p: c.contains(p)) if phrases else F.lit(False)


def count_phrases(c: Column, phrases: tuple[str, ...]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, phrases)), lambda p: c.contains(p))) if phrases else F.lit(0)


def starts_with_any(c: Column, prefixes: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, prefixes)), lambda p: c.startswith(p)) if prefixes else F.lit(False)


def after_prefix(c: Column, prefixes: tuple[str, ...]) -> Column:
    """What follows the first prefix that fits, else null."""
    return F.coalesce(*[F.when(c.startswith(p), F.substring(c, len(p) + 1, 1 << 30)) for p in prefixes], F.lit(None).cast("string"))


def shorten(c: Column, limit: int) -> Column:
    """Cut at ``limit``, back to the last separator if that keeps at least max(24, limit / 3) characters."""
    head = F.substring(c, 1, limit)
    cuts = F.greatest(*[limit - F.length(sep_tail) for sep_tail in [F.substring_index(head, s, -1) for s in ("; ", ", ", ". ", " ")]])
    keep = F.when(cuts >= max(24, limit // 3), F.rtrim(F.substring(head, F.lit(1), cuts))).otherwise(head)
    return F.when(F.length(c) <= limit, c).otherwise(F.btrim(keep, F.lit(" ;,.")))


def excerpt(c: Column, limit: int) -> Column:
    """``shorten`` with an ellipsis where something was cut."""
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(shorten(c, limit), F.lit("…")))


def count_emoji(c: Column) -> Column:
    return F.regexp_count(or_empty(c), F.lit("[\\x{1F300}-\\x{1FAFF}\\u2600-\\u27BF]"))


def label_case(c: Column) -> Column:
    """Shouting words in small letters, the first letter of the label large."""
    words = F.transform(F.split(or_empty(c), " "), lambda w: F.when((F.length(w) > 3) & (F.upper(w) == w), F.lower(w)).otherwise(w))
    s = F.array_join(words, " ")
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30))


def packed_list(c: Column) -> Column:
    """The distinct trimmed parts of a pipe-separated cell, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(or_empty(c), "\\|"), lambda x: F.trim(x)), lambda x: x != ""))


def to_bool(c: Column) -> Column:
    """Text flags: 1, true, yes, y, on."""
    return F.lower(F.trim(or_empty(c.cast("string")))).isin("1", "true", "yes", "y", "on")


def to_int(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")).try_cast("int"), F.lit(0))


def nullable_int(c: Column) -> Column:
    """A whole number, null where there is none."""
    return F.trim(c.cast("string")).try_cast("bigint")


def to_decimal(c: Column, kind: str = "decimal(18,6)") -> Column:
    """A decimal, null where the text is none or too large."""
    return F.trim(c.cast("string")).try_cast(kind)


def json_object(c: Column) -> Column:
    """map<string,string> of a JSON object, empty for anything else."""
    return F.coalesce(F.when(F.trim(c).startswith("{"), F.from_json(c, "map<string,string>", {"mode": "PERMISSIVE"})), F.create_map().cast("map<string,string>"))


def json_array(c: Column) -> Column:
    """array<string> of a JSON array, empty for anything else."""
    return F.coalesce(F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>", {"mode": "PERMISSIVE"})), F.array().cast("array<string>"))


def nullable_text(c: Column) -> Column:
    """The trimmed text, null if blank."""
    return F.nullif(F.trim(c), F.lit(""))


def first_filled(*cs: Column) -> Column:
    """The first value that is not blank, else empty."""
    return F.coalesce(*[F.when(F.trim(or_empty(c)) != "", c) for c in cs], F.lit(""))
