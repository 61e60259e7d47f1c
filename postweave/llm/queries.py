"""Queries of the training-data problems, by name, and the SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postweave.llm import sql
from postweave.llm.abuse import fit, labelled, rates, score_documents
from postweave.llm.bpe import encode
from postweave.llm.canon import look_alike_classes, look_alike_pairs
from postweave.llm.components import provider_groups
from postweave.llm.history import History, check_batches
from postweave.llm.leak import leaks, without_leaks
from postweave.llm.pii import find_items
from postweave.llm.survivors import OFFER_BUNDLES, PROVIDER_BUNDLES, merged_records, survivors
from postweave.session import cut, ensure_checkpoint_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = dict(sql.SQL)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of posts and of providers whose text looks the same."""
    posts = look_alike_pairs(table(spark, sf_dir, "raw_posts", True), "post_key", "text")
    names = look_alike_pairs(table(spark, sf_dir, "providers"), "provider_key", "canonical_name")
    return posts.select(F.lit("raw_posts.text").alias("field_name"), "*").unionAll(names.select(F.lit("providers.canonical_name"), "*"))


@query
def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every record that looks like another, and its number of links."""
    posts = look_alike_classes(table(spark, sf_dir, "raw_posts", True), "post_key", "text")
    names = look_alike_classes(table(spark, sf_dir, "providers"), "provider_key", "canonical_name")
    return posts.select(F.lit("raw_posts.text").alias("field_name"), "*").unionAll(names.select(F.lit("providers.canonical_name"), "*"))


@query
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every personal item of the posts and of the review texts, each record once."""
    raw = find_items(table(spark, sf_dir, "raw_posts", True), "post_key", "text")
    review = find_items(table(spark, sf_dir, "review_posts", True), "raw_post_id", "text_raw")
    items = raw.select(F.lit("raw_posts.text").alias("field_name"), "*").unionAll(review.select(F.lit("review_posts.text_raw"), "*"))
    return items.select("field_name", "record_key", "pii_type", "start_pos").distinct()


@query
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return encode(table(spark, sf_dir, "documents", True), "doc_id", "text")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents", True), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


@query
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test items that leaked into them."""
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


@query
def p9_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without the documents that hold test passages."""
    docs = table(spark, sf_dir, "documents", True)
    return without_leaks(docs, "doc_id", _leaks(spark, sf_dir)).select("doc_id", "lang", "source", "n_chars")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", True), table(spark, sf_dir, "abuse_labels")
    # One fit for all queries of a session over the same state of the same files.
    fitted = spark.sparkContext.__dict__.setdefault("_postweave_abuse", {})
    of = _state(spark, sorted(docs.inputFiles() + labels.inputFiles()))
    if of is None or of not in fitted:
        fitted.clear()
        fitted[of] = fit(labelled(docs, labels))
    return score_documents(docs, fitted[of], ("source",))


def _state(spark: SparkSession, files: list[str], most: int = 1000) -> tuple | None:
    """Names, sizes and times of the files; None for more than ``most`` of them, which are not asked for one by one."""
    if len(files) > most:
        return None
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    told = []
    for f in files:
        p = path(spark._jvm.java.net.URI(f))
        s = p.getFileSystem(conf).getFileStatus(p)
        told.append((f, s.getLen(), s.getModificationTime()))
    return tuple(told)


@query
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an abusive, hateful or sexual passage."""
    return _scored(spark, sf_dir).where("abusive").select("doc_id")


@query
def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    return _scored(spark, sf_dir).select("doc_id", F.round("score", 6).alias("score"), "abusive")


@query
def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, abusive documents, rate and mean score per source."""
    return rates(_scored(spark, sf_dir))


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row each best field of a duplicate group survives from."""
    offers = survivors(table(spark, sf_dir, "offers"), "offer_merge_override_group", "offer_key", "last_seen_at_utc", "dedupe_confidence", OFFER_BUNDLES)
    names = survivors(table(spark, sf_dir, "providers"), "provider_merge_override_group", "provider_key", "last_seen_at_utc", "dedupe_confidence", PROVIDER_BUNDLES)
    wanted = ("title_best", "description_best", "display_name_best")
    return offers.unionAll(names).where(F.col("bundle").isin(*wanted)).select("group_key", F.col("bundle").alias("field_name"), "record_key")


@query
def p1_merged_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One built offer per duplicate group."""
    offers = table(spark, sf_dir, "offers")
    chosen = survivors(offers, "offer_merge_override_group", "offer_key", "last_seen_at_utc", "dedupe_confidence", OFFER_BUNDLES)
    return merged_records(offers, "offer_merge_override_group", "offer_key", cut(chosen), OFFER_BUNDLES)


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every linked provider."""
    return provider_groups(table(spark, sf_dir, "providers"), table(spark, sf_dir, "provider_matches"))


def _checked(spark: SparkSession, sf_dir: str) -> tuple[History, DataFrame]:
    """A history of the offers in a folder of its own, and the answers to its batches, one after the other."""
    base = f"{ensure_checkpoint_dir(spark)}/history-{uuid.uuid4().hex}"
    history = History.start(table(spark, sf_dir, "offers", True), base, "offer_key", "first_seen_at_utc", "title_best", "description_best", "first_seen_run_id", "times_seen")
    return history, check_batches(history, table(spark, sf_dir, "offer_batches", True), "batch_row_id", "offer_key", "title_best", "description_best", "run_id", "first_seen_run_id")


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the batches that repeat a known offer, and its key."""
    return _checked(spark, sf_dir)[1].where("repeat").select(F.col("id").alias("batch_row_id"), F.col("offer").alias("offer_key"))


@query
def p4_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every offer after the batches: the run that first saw it, how often it was seen, and whether the batches brought it."""
    return _checked(spark, sf_dir)[0].offers().select(F.col("offer").alias("offer_key"), F.col("first_seen_run").alias("first_seen_run_id"), "times_seen", "is_new")
