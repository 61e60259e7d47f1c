"""Raw posts to structured posts, row shaping and scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.functions import contacts as C
from postweave.functions import text as T


def parse_instant(c: Column) -> Column:
    """ISO text as an instant; null where it cannot be read."""
    return F.trim(c).try_cast("timestamp")


def raw_post_id(df: DataFrame) -> Column:
    """The key, else tg:chat:message, else empty."""
    return F.coalesce(F.when(T.or_empty(F.col("post_key")) != "", F.col("post_key")), F.when(F.col("chat_id").isNotNull() & F.col("message_id").isNotNull(), F.concat_ws(":", F.lit("tg"), F.col("chat_id").cast("string"), F.col("message_id").cast("string"))), F.lit(""))


def shape_rows(posts: DataFrame, zone: str = "Europe/Belgrade") -> DataFrame:
    """Calendar parts in the local zone, true text length and media flags."""
    local = F.from_utc_timestamp("posted_at", zone)
    return posts.withColumn("posted_at", parse_instant(F.col("posted_at_utc"))).withColumns({
        "local_year": F.year(local), "local_month": F.date_format(local, "MM"), "local_day": F.date_format(local, "dd"),
        "local_year_month": F.date_format(local, "yyyy-MM"),
        "local_iso_week": F.concat(F.extract(F.lit("YEAROFWEEK"), local).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(local).cast("string"), 2, "0")),
        "true_length": F.length(T.or_empty(F.col("text"))), "is_media": F.coalesce(F.col("has_media"), F.lit(False)),
    })


def structure(posts: DataFrame) -> DataFrame:
    """One structured post per row: a single narrow stage without a shuffle."""
    src = T.first_filled(F.col("text"), F.col("text_normalized"))
    base = posts.select("*", raw_post_id(posts).alias("raw_post_id"), src.alias("text_raw")).withColumn("text_norm", T.normalize_text(F.col("text_raw")))
    raw, norm = F.col("text_raw"), F.col("text_norm")
    base = base.withColumns({"matches": C.contact_matches(raw, norm), "hash": T.text_hash(raw, norm), "prices": C.price_texts(raw, norm), "city": C.city_signal(raw, norm=norm), "hints": C.category_hints(raw, norm=norm)})
    channel = T.first_filled(F.lower(F.col("_telegram_target_resolved")), F.lower(F.col("chat_title")), F.col("chat_id").cast("string"))
    clean = lambda c: F.trim(T.or_empty(F.col(c)))
    phone = T.normalize_phone(F.col("sender_phone")) if "sender_phone" in posts.columns else F.lit("")
    author = F.struct("sender_id", "sender_kind", "sender_title", clean("sender_username").alias("sender_username"), clean("sender_profile_url").alias("sender_profile_url"), phone.alias("sender_phone"), clean("post_author").alias("post_author"))
    flags = F.array_compact(F.array(F.when(F.col("has_media"), "has_media"), F.when(F.size("matches") > 0, "has_contacts"), F.when(F.size("hints") > 0, "has_role_hints"), F.when(F.col("city.city").isNotNull(), "has_city"), F.when(F.size("prices") > 0, "has_price")))
    return base.select(
        "raw_post_id", channel.alias("source_channel_key"), "posted_at_utc", "_run_id", "text_raw", "text_norm", F.col("hash").alias("text_hash"),
        F.struct(*[C.values_of(F.col("matches"), k).alias(k) for k in C.KINDS]).alias("contacts"), "matches", "hints", "city",
        "prices", C.currency_hints(F.col("prices")).alias("currencies"),
        C.identity_signals(F.col("matches"), F.col("sender_username"), F.col("sender_profile_url"), F.col("hash")).alias("identity"),
        flags.alias("flags"), T.tokens(raw, norm=norm).alias("tokens"), author.alias("author"),
    )


def bounded_scan(posts: DataFrame, source: str, limit: int | None = None, checkpoint: int | None = None, upper: int | None = None, lower: int | None = None, cutoff: str | None = None) -> DataFrame:
    """The newest posts of one source within its bounds, once per key; the frozen bounds come before the limit.

    ``limit`` is the feature of the scan; without it nothing is cut.
    """
    own = posts.where(F.col("chat_id") == source)
    if upper is not None:
        own = own.where(F.col("message_id") <= upper)
    if lower is not None:
        own = own.where(F.col("message_id") >= lower)
    newest = own if limit is None else own.orderBy(F.desc("message_id"), "post_key").limit(limit)
    if checkpoint is not None:
        newest = newest.where(F.col("message_id") > checkpoint)
    if cutoff is not None:
        newest = newest.where(parse_instant(F.col("posted_at_utc")) >= F.lit(cutoff).cast("timestamp"))
    return last_by_key(newest, ["post_key"], ["_run_id"])


def scan_stats(posts: DataFrame, by: str = "chat_id") -> DataFrame:
    """Per source: rows seen, distinct keys, repeats, bounds of ids and times."""
    return posts.groupBy(by).agg(
        F.count("*").alias("seen"), F.countDistinct("post_key").alias("emitted"), (F.count("*") - F.countDistinct("post_key")).alias("duplicates"),
        F.min("message_id").alias("min_id"), F.max("message_id").alias("max_id"), F.min(parse_instant(F.col("posted_at_utc"))).alias("oldest"), F.max(parse_instant(F.col("posted_at_utc"))).alias("newest"),
    )


def scan_report(posts: DataFrame, bounds: DataFrame, source: str = "chat_id", service: Column | None = None) -> DataFrame:
    """Per source what a scan from the newest id down meets: seen, emitted, duplicates, service, newer_skipped, min_id, max_id, stop_reason.

    ``bounds`` has source_key and may have checkpoint_id, upper_id, lower_id and cutoff_at.  The scan stops at the first
    id at or under the checkpoint, or, of those not above the upper id, under the lower id or before the cutoff; that
    row is seen but not taken.  The place of the stop is one maximum per source, so nothing is read in order.
    """
    have = lambda c, kind: (F.col(c).cast(kind) if c in bounds.columns else F.lit(None).cast(kind)).alias(f"_{c}")
    ends = bounds.select(F.col("source_key").alias("_source"), have("checkpoint_id", "bigint"), have("upper_id", "bigint"), have("lower_id", "bigint"), have("cutoff_at", "timestamp"))
    own = posts.select(F.col(source).alias("_source"), "message_id", "post_key", parse_instant(F.col("posted_at_utc")).alias("_at"), (F.lit(False) if service is None else service).alias("_service")).where("message_id is not null").join(ends, "_source")
    newer = F.coalesce(F.col("message_id") > F.col("_upper_id"), F.lit(False))
    reason = F.when(F.col("message_id") <= F.col("_checkpoint_id"), "checkpoint_reached").when(newer, None).when(F.col("message_id") < F.col("_lower_id"), "freeze_lower_message_id_reached").when(F.col("_at") < F.col("_cutoff_at"), "cutoff_reached")
    own = own.withColumns({"_newer": newer, "_reason": reason})
    stop = own.where("_reason is not null").groupBy("_source").agg(F.max(F.struct("message_id", "_reason")).alias("_stop"))
    met = own.join(stop, "_source", "left")
    taken = (F.col("_stop").isNull() | (F.col("message_id") > F.col("_stop.message_id"))) & ~F.col("_newer")
    kept = taken & ~F.col("_service")
    got = met.where(F.col("_stop").isNull() | (F.col("message_id") >= F.col("_stop.message_id"))).groupBy("_source").agg(
        F.count("*").alias("seen"), F.countDistinct(F.when(kept, F.col("post_key"))).alias("emitted"), F.count_if(kept).alias("_kept"), F.count_if(taken & F.col("_service")).alias("service"),
        F.count_if("_newer").alias("newer_skipped"), F.min("message_id").alias("min_id"), F.max("message_id").alias("max_id"), F.max("_stop._reason").alias("_why"),
    )
    why = F.coalesce("_why", F.when(F.col("emitted") == 0, "no_matching_posts").otherwise("end_of_history"))
    return got.select(F.col("_source").alias("source_key"), "seen", "emitted", (F.col("_kept") - F.col("emitted")).alias("duplicates"), "service", "newer_skipped", "min_id", "max_id", why.alias("stop_reason"))


def lookup(wanted: DataFrame, posts: DataFrame, service: Column | None = None) -> DataFrame:
    """Requested keys with a status: fetched, service_message_skipped where all there is are service messages, or missing."""
    told = F.lit(True) if service is None else F.bool_or(~service)
    have = posts.where("post_key is not null").groupBy("post_key").agg((F.max(told) if service is None else told).alias("hit"))
    status = F.when(F.col("hit").isNull(), "missing").when(F.col("hit"), "fetched").otherwise("service_message_skipped")
    return wanted.join(have, "post_key", "left").select("post_key", status.alias("status"))


def resolve_cutoff(as_of: Column, since_date: Column, days_back: Column, months_back: Column) -> Column:
    """The first of a date, days back, months of 30 days back; two months if none is given."""
    back = lambda d: as_of - F.make_dt_interval(d.cast("int"))
    return F.coalesce(F.to_timestamp(since_date), back(days_back), back(F.coalesce(months_back, F.lit(2)) * 30))


def normalize_target(c: Column) -> Column:
    """A channel's address, sign or id as one handle or id."""
    v = F.regexp_replace(F.trim(T.or_empty(c)), "[?#].*$", "")
    v = F.regexp_replace(F.regexp_replace(v, "/+$", ""), "^(?i)(?:https?://)?(?:www\\.)?(?:t|telegram)\\.me/(?:s/)?", "")
    v = F.split_part(F.regexp_replace(v, "^@", ""), F.lit("/"), F.lit(1))
    return F.when(v == "", "").when(v.rlike("^-?\\d+$"), v).otherwise(F.concat(F.lit("@"), F.lower(v)))


def last_by_key(df: DataFrame, keys: list[str], order: list[str], count: str | None = None) -> DataFrame:
    """The last row per key by ``order``, ties by the other columns; rows with a blank key part go.  ``count`` names a column for the rows per key.

    One aggregate with partial results: a key with many rows is one row per task before it is shuffled.
    """
    own = df
    for k in keys:
        own = own.where(T.or_empty(F.col(k).cast("string")) != "")
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order and not df.schema[c].dataType.typeName().startswith(("map", "variant"))]]
    by = F.struct(*[F.col(c) for c in ranked]) if ranked else F.lit(0)
    got = own.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_x") if rest else F.count("*").alias("_x"), F.count("*").alias("_n"))
    cols = [F.col(c) if c in keys else F.col("_x")[c].alias(c) for c in df.columns]
    return got.select(*cols, *([F.col("_n").alias(count)] if count else []))
