"""Files in and out: run envelopes, encoded payloads, posts, spreadsheet projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

_S, _L = t.StringType(), t.LongType()
RAW_POST = t.StructType([
    *[t.StructField(n, _S) for n in ("chat_id", "chat_title", "chat_kind", "chat_kind_label")], t.StructField("message_id", _L),
    *[t.StructField(n, _S) for n in ("post_key", "post_url", "posted_at_utc", "posted_at_local")], t.StructField("posted_year", t.IntegerType()),
    *[t.StructField(n, _S) for n in ("posted_month", "posted_day", "posted_year_month", "posted_iso_week", "text", "text_normalized")],
    t.StructField("text_length", t.IntegerType()), t.StructField("has_media", t.BooleanType()), t.StructField("media_type", _S),
    *[t.StructField(n, _L) for n in ("views", "forwards", "replies")],
    *[t.StructField(n, _S) for n in ("grouped_id", "sender_id", "sender_kind", "sender_title", "sender_username", "sender_profile_url", "post_author", "_run_id", "_target_key", "_telegram_target_input", "_telegram_target_resolved")],
])
ENVELOPE = t.StructType([t.StructField("run_id", _S), t.StructField("raw_posts", t.ArrayType(RAW_POST)), t.StructField("_corrupt_record", _S)])


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Posts of JSON run envelopes; a broken file or one without a list of posts is an error row."""
    df = spark.read.schema(ENVELOPE).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    bad = F.col("_corrupt_record").isNotNull() | F.col("raw_posts").isNull()
    return df.select("run_id", F.when(bad, "invalid_envelope").alias("error"), F.explode_outer("raw_posts").alias("p")).select("run_id", "error", "p.*")


def decode_payload(c: Column, schema: t.StructType) -> Column:
    """A base64url JSON text as a struct; null where it cannot be read."""
    b64 = F.translate(F.trim(c), "-_", "+/")
    pad = F.concat(b64, F.repeat(F.lit("="), F.pmod(-F.length(b64), F.lit(4))))
    return F.from_json(F.try_to_binary(pad, F.lit("base64")).cast("string"), schema, {"mode": "PERMISSIVE"})


def read_posts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Posts of Parquet, JSON lines, CSV or ORC with the declared schema."""
    r = spark.read.schema(RAW_POST)
    return r.csv(path, header=True, multiLine=True, escape='"') if fmt == "csv" else r.format(fmt).load(path)


def stream_posts(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(RAW_POST).option("maxFilesPerTrigger", files_per_batch).parquet(path)


# Error kinds with what can be done about them.
ERROR_HINTS = {
    "invalid_envelope": "the file must be one JSON object with a list raw_posts", "auth_failed": "renew the session", "rate_limited": "wait for retry_after_s and run again", "not_found": "check the ids asked for",
    "timeout": "run again with a smaller bound", "missing_lower_bound": "an upper id needs a lower bound",
}


def dead_letters(df: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and error rows in one shape; ``error_message``, ``http_status`` and ``retry_after_s`` are taken over where there are such columns."""
    have = lambda c, kind: (F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)).alias(c)
    hints = F.create_map(*[F.lit(x) for kv in ERROR_HINTS.items() for x in kv])
    good = df.where(F.col("error").isNull()).drop("error")
    said = F.coalesce(have("error_message", "string"), F.col("error")).alias("error_message")
    hint = F.coalesce(F.try_element_at(hints, F.col("error")), F.lit("")).alias("error_hint")
    bad = df.where(F.col("error").isNotNull()).select(F.lit(stage).alias("stage"), F.col("error").alias("error_type"), said, hint, F.col("run_id"), have("http_status", "int"), have("retry_after_s", "int"))
    return good, bad


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Rows as JSON lines, in a folder per value of ``by`` if given; nulls are left out."""
    out = df.write.mode("overwrite").option("ignoreNullFields", "true")
    (out.partitionBy(by) if by else out).json(path)


def write_ordered(df: DataFrame, path: str, order: list[str]) -> None:
    """Rows in one order over all files (their names sort by it), by range partitions."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


SHEET_COLUMNS = ("offer_key", "title", "details", "category", "city", "price", "contact", "provider", "website", "url", "last_seen")


def spreadsheet_rows(offers: DataFrame, providers: DataFrame, cities: dict[str, str]) -> DataFrame:
    """The fixed projection of published offers; city codes become names."""
    names = F.create_map(*[F.lit(x) for kv in cities.items() for x in kv])
    p = providers.select("provider_key", F.col("display_name_best").alias("provider"), F.col("websites").alias("website"))
    city = F.coalesce(F.try_element_at(names, F.lower(F.trim("city_codes"))), F.col("city_codes"), F.lit(""))
    got = offers.where("offer_state = 'accepted'").join(p, "provider_key", "left")
    cols = {"title": "title_best", "details": "description_best", "category": "category_primary", "price": "price_text_best", "contact": "contact_snapshot_phones", "url": "latest_post_url"}
    got = got.withColumns({n: F.coalesce(F.col(c), F.lit("")) for n, c in cols.items()} | {"city": city, "last_seen": F.date_format(F.from_utc_timestamp("last_seen_at_utc", "Europe/Belgrade"), "dd.MM.yyyy")})
    return got.select(*SHEET_COLUMNS)


def write_posts(df: DataFrame, path: str) -> None:
    """Posts partitioned by month, clustered by id so that bounded scans prune."""
    df.repartition("posted_year_month").sortWithinPartitions("chat_id", "message_id").write.mode("overwrite").partitionBy("posted_year_month").parquet(path)
