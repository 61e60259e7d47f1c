"""Incremental ingest: posts arrive as files, are deduplicated, and move the first and last sighting of each key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postweave.functions import text as T
from postweave.operators.posts import parse_instant
from postweave.operators.tables import upsert


def new_posts(stream: DataFrame, lateness: str = "30 days") -> DataFrame:
    """Each key once; state is kept as long as posts may be late."""
    timed = stream.withColumn("event_at", parse_instant(F.col("posted_at_utc"))).where(T.or_empty(F.col("post_key")) != "")
    return timed.withWatermark("event_at", lateness).dropDuplicatesWithinWatermark(["post_key"])


def counts_by_window(stream: DataFrame, width: str = "1 day", slide: str | None = None, lateness: str = "30 days") -> DataFrame:
    """Posts per channel and window."""
    timed = stream.withColumn("event_at", parse_instant(F.col("posted_at_utc"))).where("event_at is not null").withWatermark("event_at", lateness)
    w = F.window("event_at", width, slide) if slide else F.window("event_at", width)
    return timed.groupBy(w.alias("w"), "chat_id").agg(F.count("*").alias("posts"), F.sum(F.coalesce("views", F.lit(0))).alias("views")).select(F.col("w.start").alias("window_start"), "chat_id", "posts", "views")


def sessions(stream: DataFrame, user: str, ts: str, gap: str, lateness: str = "1 hour") -> DataFrame:
    """Runs of events of one user with gaps below ``gap``."""
    s = stream.withWatermark(ts, lateness).groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count("*").alias("n"))
    return s.select(user, F.col("w.start").alias("started_at"), F.col("w.end").alias("ended_at"), "n")


def sightings(posts: DataFrame) -> DataFrame:
    """Per key: first and last run, sightings, the newest counters."""
    order = F.struct("_run_id", F.coalesce("views", F.lit(-1)))
    return posts.where(T.or_empty(F.col("post_key")) != "").groupBy("post_key").agg(F.min("_run_id").alias("first_seen_run_id"), F.max("_run_id").alias("last_seen_run_id"), F.count("*").alias("times_seen"), F.max_by("views", order).alias("views"), F.max_by("text", order).alias("text"))


def merge_sightings(old: DataFrame, new: DataFrame) -> DataFrame:
    """State after a batch: the first run stays, the last moves, sightings add up."""
    add = new.join(old.select("post_key", F.col("times_seen").alias("_before")), "post_key", "left").withColumn("times_seen", F.col("times_seen") + F.coalesce("_before", F.lit(0))).drop("_before")
    return upsert(old, add, ["post_key"], ["last_seen_run_id", "times_seen", "views"])


def run_ingest(stream: DataFrame, load: Callable[[], DataFrame | None], save: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Drain the source; each micro-batch replaces the state under a new version, so a repeated batch gives the same."""

    def one(batch: DataFrame, version: int) -> None:
        new, old = sightings(batch), load()
        save(new if old is None else merge_sightings(old, new), version)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def resume_error(state: dict, now: dict) -> str:
    """Why a saved chunk state cannot be resumed; empty if it can.  Checks run in a fixed order."""
    rules = (
        ("state_version_mismatch", state.get("version") == now.get("version")),
        ("bounds_mismatch", state.get("bounds") == now.get("bounds")),
        ("fingerprint_mismatch", state.get("fingerprint") == now.get("fingerprint")),
        ("ids_mismatch", state.get("ids") == now.get("ids") or "ids" not in state),
        ("identities_mismatch", state.get("identities") == now.get("identities")),
        ("token_mismatch", state.get("token") == now.get("token")),
        ("failed_candidates", not state.get("failed")),
        ("duplicate_candidates", len(set(state.get("done", ()))) == len(state.get("done", ()))),
        ("cursor_gap", list(state.get("done", ())) == list(now.get("ids", ()))[: len(state.get("done", ()))]),
    )
    return next((name for name, ok in rules if not ok), "")


def chunk_reserve(total: float) -> float:
    """Seconds kept free at the end of a chunk: a tenth of all, thirty at least and 180 at most."""
    return min(180.0, max(30.0, total / 10))


def must_stop(total: float, elapsed: float, done: int) -> bool:
    """Whether another row, at the average so far, would run into the reserve."""
    average = elapsed / done if done else 0.0
    return total - elapsed <= chunk_reserve(total) + average
