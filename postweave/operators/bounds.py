"""Frozen scan bounds, replay, and lookups beside a scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.functions import text as T
from postweave.operators.posts import normalize_target, parse_instant


def freeze(posts: DataFrame, source: str = "chat_id") -> DataFrame:
    """The bounds a scan of each source saw: ids, times, stop reason."""
    got = posts.where(T.or_empty(F.col("post_key")) != "").groupBy(F.col(source).alias("source_key")).agg(F.max("message_id").alias("upper_id"), F.min("message_id").alias("lower_id"), F.min(parse_instant(F.col("posted_at_utc"))).alias("oldest_at"), F.max(parse_instant(F.col("posted_at_utc"))).alias("newest_at"), F.count("*").alias("posts"))
    return got.withColumn("stop_reason", F.when(F.col("posts") > 0, "freeze_lower_message_id_reached").otherwise("no_matching_posts"))


def replay(posts: DataFrame, bounds: DataFrame, source: str = "chat_id", keys: str | None = None) -> DataFrame:
    """The posts within the frozen bounds of their source; newer ones and unknown sources go.

    ``bounds`` has source_key and upper_id and may have cutoff_at, oldest_at, lower_id and lookup_keys.  The time named
    by ``lower_bound`` and the lower id hold together, posts without a readable time are kept; an upper id alone is an
    error.  With ``keys``, an array column of posts, a source is the first whose lookup keys overlap them.
    """
    have = lambda c, kind: F.col(c).cast(kind) if c in bounds.columns else F.lit(None).cast(kind)
    ends = bounds.select("source_key", "upper_id", have("lower_id", "bigint").alias("lower_id"), have("cutoff_at", "timestamp").alias("cutoff_at"), have("oldest_at", "timestamp").alias("oldest_at"))
    ends = ends.withColumn("_end", lower_bound())
    ends = ends.select(F.col("source_key").alias("_source"), F.struct("upper_id", "lower_id", "_end", F.when(F.col("_end") == "cutoff", F.col("cutoff_at")).when(F.col("_end") == "oldest", F.col("oldest_at")).alias("since")).alias("_b"))
    if keys is None:
        met = posts.join(ends, F.col(source) == F.col("_source"))
    else:
        # Overlap of key lists as equality of their keys, once per distinct list.
        of = bounds.select(F.col("source_key").alias("_source"), F.explode(F.array_distinct(F.transform("lookup_keys", normalize_target))).alias("_key"))
        lists = posts.select(F.col(keys).alias("_keys")).distinct().withColumn("_key", F.explode(F.array_distinct(F.transform("_keys", normalize_target))))
        first = lists.where("_key <> ''").join(of, "_key").groupBy("_keys").agg(F.min("_source").alias("_source")).join(ends, "_source")
        met = posts.join(first, F.col(keys) == F.col("_keys")).drop("_keys")
    b, at = F.col("_b"), parse_instant(F.col("posted_at_utc"))
    ok = (F.col("message_id") <= b["upper_id"]) & F.coalesce(F.col("message_id") >= b["lower_id"], b["lower_id"].isNull()) & F.coalesce(at >= b["since"], F.lit(True))
    ok = F.when(b["_end"] == "missing_lower_bound", F.raise_error(F.lit("missing_lower_bound: an upper id without a lower bound")).cast("boolean")).otherwise(ok)
    return met.where(ok).drop("_source", "_b")


def newer_than(posts: DataFrame, bounds: DataFrame, source: str = "chat_id") -> DataFrame:
    """The posts above the frozen upper id of their source."""
    b = bounds.select(F.col("source_key").alias(source), "upper_id")
    return posts.join(b, source).where(F.col("message_id") > F.col("upper_id")).drop("upper_id")


def lower_bound() -> Column:
    """The first of a cutoff, the oldest time and the lower id, by name; an upper bound alone is an error."""
    return F.when(F.col("cutoff_at").isNotNull(), "cutoff").when(F.col("oldest_at").isNotNull(), "oldest").when(F.col("lower_id").isNotNull(), "lower_id").when(F.col("upper_id").isNotNull(), "missing_lower_bound").otherwise("none")


def sources_overlap(a: Column, b: Column) -> Column:
    """Whether two lists of lookup keys share one, whatever sign or case they are written with."""
    norm = lambda c: F.transform(c, T.normalize_handle)
    return F.arrays_overlap(norm(a), norm(b))


def senders(posts: DataFrame) -> DataFrame:
    """One row per sender id: the newest known title, name and address."""
    order = F.struct("_run_id", F.col("message_id"), F.coalesce("sender_username", F.lit("")), F.coalesce("sender_title", F.lit("")))
    return posts.where(T.or_empty(F.col("sender_id")) != "").groupBy("sender_id").agg(F.max_by(F.struct("sender_kind", "sender_title", "sender_username", "sender_profile_url"), order).alias("s"), F.count("*").alias("posts")).select("sender_id", "s.*", "posts")


def with_senders(posts: DataFrame, dim: DataFrame) -> DataFrame:
    """Posts with a display name of their sender, else the post's author."""
    d = dim.select("sender_id", F.col("sender_title").alias("_t"), F.col("sender_username").alias("_u"))
    return posts.join(d, "sender_id", "left").withColumn("sender_display", T.first_filled(F.col("_t"), F.col("_u"), F.col("post_author"))).drop("_t", "_u")


def entity_kind(kind: Column, megagroup: Column, broadcast: Column) -> Column:
    """channel, supergroup, group, else the class name."""
    return F.when(broadcast, "channel").when(megagroup, "supergroup").when(F.lower(kind) == "chat", "group").otherwise(F.lower(kind))
