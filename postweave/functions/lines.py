"""Lines of a post: splitting, cleaning, rule flags, title and details; plus small label and contact helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from postweave.functions import text as T

# Words that greet, promote or label a section.
GREETINGS = ("привет", "всем привет", "здравствуйте", "добрый день", "hi all", "hello", "zdravo", "dobar dan")
PROMO = ("подписывайтесь", "репост", "розыгрыш", "акция только", "subscribe", "giveaway", "zapratite")
SECTIONS = ("услуги", "контакты", "цены", "прайс", "services", "contacts", "prices", "usluge", "cene")


def lines(c: Column) -> Column:
    """The lines of a text; of one line its bullets, else its sentences.  Blank ones go, the rest is in normal form."""
    parts = F.split(T.or_empty(c), "[\\r\\n]+")
    bullets = F.split(T.or_empty(c), "\\s*[•●▪]\\s*")
    sentences = F.split(T.or_empty(c), "(?<=[.!?])\\s+")
    chosen = F.when(F.size(parts) > 1, parts).when(F.size(bullets) > 1, bullets).otherwise(sentences)
    return F.filter(F.transform(chosen, T.normalize_text), lambda x: x != "")


def is_noise(line: Column) -> Column:
    """Empty, only tags or signs, a section label, a promotion, a shouted brand, or under two words with a picture."""
    low = F.lower(line)
    words = F.size(F.split(F.trim(line), " "))
    letters = line.rlike("[\\p{L}\\p{N}]")
    brand = (words <= 4) & line.rlike("\\p{L}") & (F.upper(line) == line)
    section = (words <= 5) & F.regexp_replace(low, "[\\s:.!-]+$", "").isin(*SECTIONS)
    return ~letters | low.rlike("^(#\\S+\\s*)+$") | section | T.contains_any(low, PROMO) | brand | ((words < 2) & (T.count_emoji(line) > 0))


def clean_lines(c: Column) -> Column:
    """Lines without symbols at the edges, greetings and noise, each once whatever its case."""
    cut = F.transform(lines(c), lambda x: F.trim(F.regexp_replace(x, "^[^\\p{L}\\p{N}+@#«\"(]+|[\\s\\-–—•]+$", "")))
    kept = F.filter(cut, lambda x: (x != "") & ~is_noise(x) & ~F.regexp_replace(F.lower(x), "[!.,\\s]+$", "").isin(*GREETINGS))
    return T.let(kept, lambda k: F.filter(k, lambda x, i: F.array_position(F.transform(k, lambda y: F.lower(y)), F.lower(x)) == i + 1))


def rule_flags(c: Column, rules: dict[str, tuple[tuple[str, ...], int]]) -> Column:
    """The names of rules of which at least as many phrases occur as each asks for, in the order of the rules."""
    return T.let(F.lower(T.normalize_text(c)), lambda low: F.array_compact(F.array(*[F.when(T.count_phrases(low, words) >= least, name) for name, (words, least) in rules.items()])))


def fact_pack(c: Column) -> Column:
    """struct<title, details, quality>: the first clean line, the next three, and what is there."""

    def build(k: Column) -> Column:
        title = T.shorten(F.coalesce(F.get(k, F.lit(0)), F.lit("")), 120)
        details = T.shorten(F.array_join(F.slice(k, 2, 3), "; "), 280)
        quality = F.when(F.size(k) == 0, "weak_signal").when(F.size(k) == 1, "title_only").otherwise("clean")
        return F.struct(title.alias("title"), details.alias("details"), quality.alias("quality"))

    return T.let(clean_lines(c), build)


def singular(c: Column) -> Column:
    """English plurals of three kinds."""
    return F.when(c.rlike("(?i)ies$"), F.regexp_replace(c, "(?i)ies$", "y")).when(c.rlike("(?i)(ses|xes|ches|shes)$"), F.regexp_replace(c, "(?i)es$", "")).when(c.rlike("(?i)[^s]s$"), F.regexp_replace(c, "(?i)s$", "")).otherwise(c)


def contact_display(kind: Column, value: Column) -> Column:
    """+digits, @handle, else as it is."""
    return F.when(kind == "phone", F.concat(F.lit("+"), value)).when(kind == "telegram_handle", F.concat(F.lit("@"), value)).otherwise(value)


def endpoint_signature(kind: Column, value: Column) -> Column:
    """One key per endpoint; an address of the messenger is its handle."""
    handle = F.regexp_extract(F.lower(value), "t\\.me/([a-z0-9_]+)", 1)
    return F.when(handle != "", F.concat(F.lit("telegram:"), handle)).when(kind == "telegram_handle", F.concat(F.lit("telegram:"), value)).when(kind == "phone", F.concat(F.lit("phone:"), value)).when(kind == "email", F.concat(F.lit("email:"), value)).otherwise(F.concat(F.lit("url:"), value))


IDENTITY_ORDER = ("phone", "email", "tg", "tg_link", "site", "weak_text")


def ranked_identity(keys: Column) -> Column:
    """Identity keys in their normal form, known kinds only, sorted by kind and text."""

    def one(k: Column) -> Column:
        kind, value = F.split_part(k, F.lit(":"), F.lit(1)), F.regexp_replace(k, "^[^:]*:", "")
        value = F.when(kind == "phone", T.normalize_phone(value)).when(kind == "tg", T.normalize_handle(value)).when(kind == "tg_link", T.normalize_url(value)).when(kind == "site", T.normalize_website(value)).otherwise(F.lower(value))
        return F.struct(F.array_position(F.array(*map(F.lit, IDENTITY_ORDER)), kind).alias("rank"), F.concat(kind, F.lit(":"), value).alias("key"), value.alias("value"))

    good = F.filter(F.transform(keys, one), lambda s: (s["rank"] > 0) & (s["value"] != ""))
    return F.array_distinct(F.transform(F.array_sort(good), lambda s: s["key"]))


def compact_value(c: Column, kind: DataType) -> Column:
    """A value without what says nothing, at any depth: blank texts, empty lists and structs of nothing are null."""
    if isinstance(kind, StringType):
        return F.when(F.trim(c) != "", c)
    if isinstance(kind, ArrayType):
        kept = F.filter(F.transform(c, lambda x: compact_value(x, kind.elementType)), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(kind, StructType):
        parts = [compact_value(c[f.name], f.dataType) for f in kind]
        some = None
        for p in parts:
            some = p.isNotNull() if some is None else some | p.isNotNull()
        return F.when(some, F.struct(*[p.alias(f.name) for p, f in zip(parts, kind)])) if parts else F.lit(None).cast(kind)
    return c


def compact_json(s: Column, kind: DataType | None = None) -> Column:
    """A struct as JSON without nulls; with its type also without blank texts and empty lists, at any depth."""
    return F.to_json(s if kind is None else compact_value(s, kind), {"ignoreNullFields": "true"})
