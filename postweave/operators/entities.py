"""Entity rows: what the posts of one cluster say together, by partial aggregates only.

Evidence stays a table of edges; no entity row holds the list of its posts, so a cluster of any size is one small row.
Every function takes posts with the entity's key in ``by``, a time (any order; null or empty is earliest for the last
and latest for the first) and an id that breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.functions import text as T
from postweave.operators.merge import sum_scores, union_values

# Contact kinds in the order in which one becomes the primary contact.
CONTACT_ORDER = ("phone", "telegram_handle", "telegram_link", "email", "website")
# Fields a display name comes from, the best first.
NAME_FIELDS = ("sender_title", "post_author", "chat_title")


def seen_bounds(posts: DataFrame, by: str, at: str, key: str, run: str, url: str) -> DataFrame:
    """(by, times_seen, first and last time and run, latest_post_url)."""
    blank = T.or_empty(F.col(at).cast("string")) == ""
    first = F.min_by(F.struct(F.col(at).alias("at"), F.col(run).alias("run")), F.struct(blank, at, key)).alias("f")
    last = F.max_by(F.struct(F.col(at).alias("at"), F.col(run).alias("run"), F.col(url).alias("url")), F.struct(~blank, at, key)).alias("l")
    got = posts.groupBy(by).agg(F.countDistinct(key).alias("times_seen"), first, last)
    return got.select(by, "times_seen", F.col("f.at").alias("first_seen_at_utc"), F.col("l.at").alias("last_seen_at_utc"), F.col("f.run").alias("first_seen_run_id"), F.col("l.run").alias("last_seen_run_id"), F.col("l.url").alias("latest_post_url"))


def price_numbers(prices: Column) -> Column:
    """The numbers of price texts: one comma without a dot is decimal, other commas go; what is then no number is left out."""
    raw = F.flatten(F.transform(prices, lambda p: F.regexp_extract_all(p, F.lit(r"(\d[\d\s.,]*)"), F.lit(1))))
    return F.array_compact(F.transform(raw, lambda s: T.let(F.replace(s, F.lit(" "), F.lit("")), lambda c: F.when((F.regexp_count(c, F.lit(",")) == 1) & ~c.contains("."), F.replace(c, F.lit(","), F.lit("."))).otherwise(F.replace(c, F.lit(","), F.lit("")))).try_cast("double")))


def best_price_text(prices: Column) -> Column:
    """Of one post's price texts the one with most groups of digits, then the longest, then the first in order."""
    order = F.transform(prices, lambda p: F.struct((-F.regexp_count(p, F.lit(r"\d+"))).alias("n"), (-F.length(p)).alias("l"), p.alias("v")))
    return F.array_min(order)["v"]


def price_stats(posts: DataFrame, by: str, at: str, key: str, prices: str, currencies: str) -> DataFrame:
    """(by, price_min, price_max, price_text_best, currency_code): bounds of all numbers, the newest post's text, the most frequent currency (the first of equals)."""
    blank = T.or_empty(F.col(at).cast("string")) == ""
    own = posts.select(by, F.struct(~blank, F.col(at), F.col(key)).alias("_o"), F.col(prices).alias("_p"), price_numbers(F.col(prices)).alias("_n"))
    told = own.groupBy(by).agg(F.min(F.array_min("_n")).alias("price_min"), F.max(F.array_max("_n")).alias("price_max"), F.max_by(F.when(F.size("_p") > 0, best_price_text(F.col("_p"))), F.when(F.size("_p") > 0, F.col("_o"))).alias("price_text_best"))
    codes = posts.select(by, F.explode(currencies).alias("code")).groupBy(by, "code").agg(F.count("*").alias("n"))
    code = codes.groupBy(by).agg(F.min_by("code", F.struct(-F.col("n"), "code")).alias("currency_code"))
    rounded = lambda c: F.round(c, 2).alias(c)
    return told.join(code, by, "left").select(by, rounded("price_min"), rounded("price_max"), T.or_empty(F.col("price_text_best")).alias("price_text_best"), T.or_empty(F.col("currency_code")).alias("currency_code"))


def category_order(posts: DataFrame, by: str, hints: Column) -> DataFrame:
    """(by, categories): codes by summed score, then occurrences, then name."""
    return sum_scores(posts, by, hints).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("c")).select(by, F.transform("c", lambda x: x["code"]).alias("categories"))


def display_names(posts: DataFrame, by: str, fields: tuple[str, ...] = NAME_FIELDS) -> DataFrame:
    """(by, display_name): the most frequent name; ties go to the better field, the longer name, then small letters."""
    flat = posts.select(by, F.explode(F.array(*[F.struct(F.lit(i).alias("field"), T.normalize_text(F.col(f)).alias("name")) for i, f in enumerate(fields)])).alias("x")).select(by, "x.*").where("name <> ''")
    told = flat.groupBy(by, "name").agg(F.count("*").alias("n"), F.min("field").alias("field"))
    return told.groupBy(by).agg(F.min_by("name", F.struct(-F.col("n"), "field", -F.length("name"), F.lower("name"), "name")).alias("display_name"))


def primary_contact(contacts: dict[str, Column]) -> Column:
    """struct<type, value>: the first value of the first kind that has one."""
    one = [F.when(F.size(contacts[k]) > 0, F.struct(F.lit(k).alias("type"), F.get(contacts[k], F.lit(0)).alias("value"))) for k in CONTACT_ORDER if k in contacts]
    return F.coalesce(*one, F.struct(F.lit("").alias("type"), F.lit("").alias("value")))


def provider_confidence(strong: Column, posts: Column) -> Column:
    """high with a phone, or two strong keys or posts; medium with one strong key or two posts; else low."""
    phone = F.exists(strong, lambda k: k.startswith("phone:"))
    n = F.coalesce(F.size(strong), F.lit(0))
    return F.when((n > 0) & (F.coalesce(phone, F.lit(False)) | (n >= 2) | (posts >= 2)), "high").when((n > 0) | (posts >= 2), "medium").otherwise("low")


def offer_confidence(posts: Column, like_first: Column, says: Column) -> Column:
    """Of several posts high if another has the text of the first, else medium; of one medium if it says something, else low."""
    return F.when(posts >= 2, F.when(like_first >= 2, "high").otherwise("medium")).when(says, "medium").otherwise("low")


def provider_entities(posts: DataFrame, by: str, at: str, key: str, run: str, url: str, identity: Column, city: Column, channel: Column, hints: Column, **contacts: Column) -> DataFrame:
    """One row per provider: bounds, unions of contacts, cities and channels, categories in order, primary contact, confidence."""
    bounds = seen_bounds(posts, by, at, key, run, url)
    strong = F.filter(identity, lambda k: ~k.startswith("weak_text:"))
    unions = union_values(posts, by, city_codes=city, source_channel_keys=channel, identity_keys_primary=strong, **contacts)
    got = bounds.join(unions, by).join(category_order(posts, by, hints), by, "left")
    first = primary_contact({k: F.col(k) for k in contacts})
    return got.withColumns({
        "categories": F.coalesce("categories", F.array().cast("array<string>")),
        "identity_strength": F.when(F.size("identity_keys_primary") > 0, "strong").otherwise("provisional"),
        "primary_contact_type": first["type"], "primary_contact_value": first["value"],
        "dedupe_confidence": provider_confidence(F.col("identity_keys_primary"), F.col("times_seen")),
    })


def offer_entities(posts: DataFrame, by: str, at: str, key: str, run: str, url: str, text_hash: str, prices: str, currencies: str, tags: Column, city: Column, channel: Column) -> DataFrame:
    """One row per offer: bounds, prices, unions of tags, cities and channels, confidence."""
    bounds = seen_bounds(posts, by, at, key, run, url)
    unions = union_values(posts, by, city_codes=city, source_channel_keys=channel, service_tags=tags)
    blank = T.or_empty(F.col(at).cast("string")) == ""
    first = posts.groupBy(by).agg(F.min_by(F.struct(F.col(text_hash).alias("h")), F.struct(blank, at, key)).alias("_f"))
    # Posts per text, so that the join is between counts.
    texts = posts.groupBy(by, text_hash).agg(F.countDistinct(key).alias("_n"))
    alike = texts.join(first, by).where(F.col(text_hash).eqNullSafe(F.col("_f.h"))).select(by, F.col("_n").alias("_like"))
    got = bounds.join(unions, by).join(price_stats(posts, by, at, key, prices, currencies), by).join(alike, by, "left")
    return got.withColumn("dedupe_confidence", offer_confidence(F.col("times_seen"), F.coalesce("_like", F.lit(0)), F.size("service_tags") > 0)).drop("_like")
