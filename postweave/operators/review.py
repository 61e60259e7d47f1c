"""The decision loop over candidates, and the publication of what it leaves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.functions import text as T
from postweave.operators import decisions as D
from postweave.operators.posts import last_by_key
from postweave.operators.tables import decide, running_budget
from postweave.sources.store import Store


def snapshot(fields: tuple[str, ...]) -> Column:
    """The named columns of an entity as one struct, as a candidate carries them."""
    return F.struct(*fields)


def signal_text(*parts: Column) -> Column:
    """What an entity says, in one normal text; blank parts leave no gap."""
    return T.normalize_text(F.concat_ws("\n", *[F.when(T.normalize_text(p) != "", p) for p in parts]))


def candidates(entities: DataFrame, key: str, stage: str, when: Column, texts: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """(key, stage, text, snapshot) of the entities that a stage is asked about; which those are is the caller's rule."""
    return entities.where(when).select(F.col(key).alias("key"), F.lit(stage).alias("stage"), signal_text(*map(F.col, texts)).alias("text"), snapshot(fields).alias("snapshot"))


def run_decisions(asked: DataFrame, outputs: DataFrame, order: list[str], soft: float, hard: float, threshold: float = 0.75, recovered: float = 0.5, safe: Column | None = None, allowed: dict[str, int] | None = None) -> DataFrame:
    """One row per candidate (key, stage, text, ...): outcome, reason, confidence, patch, tokens, budget.

    Candidates are taken in ``order`` per stage.  One that would pass the hard budget is not asked (``budget``); saved
    outputs (stage, attempt, output) stand for the model.  What cannot be read is dropped with its error; the rest is
    accepted, recovered or rejected by its confidence.  Patches keep allowed fields only.
    """
    costed = asked.withColumn("tokens", D.token_estimate(F.col("text")))
    within = running_budget(costed, "stage", order, "tokens", soft, hard).drop("calls")
    # Those stopped are the last of their stage, so numbering the others first gives each its own output.
    told = D.mock_decisions(within.where("budget <> 'stopped'"), outputs, "stage", order)
    told = told.unionByName(within.where("budget = 'stopped'"), allowMissingColumns=True)
    d = told.withColumn("_d", D.parse_decision(F.col("output")))
    conf = F.col("_d.decision.confidence")
    refuses = F.coalesce(F.col("_d.decision.decision_code").isin("no_match", "reject", "drop"), F.lit(False))
    ruled = F.when(refuses, "reject").otherwise(decide(conf, threshold, recovered, F.lit(True) if safe is None else safe))
    outcome = F.when(F.col("budget") == "stopped", "drop").when(F.col("_d.error").isNotNull(), "drop").otherwise(ruled)
    reason = F.when(F.col("budget") == "stopped", "budget").otherwise(F.coalesce("_d.error", F.nullif("_d.decision.reason_text", F.lit("")), "_d.decision.decision_code"))
    patch = D.sanitize_patch(F.coalesce("_d.decision.patch", F.create_map().cast("map<string,string>")), allowed) if allowed else F.create_map().cast("map<string,string>")
    return d.select(*[c for c in asked.columns], outcome.alias("outcome"), reason.alias("reason"), conf.alias("confidence"), patch.alias("patch"), "tokens", "budget")


def final_drop(entities: DataFrame, key: str, decided: DataFrame) -> DataFrame:
    """Entities with state and reason: one that any stage rejected or dropped is out, by the first such stage in order of names."""
    out = decided.where(F.col("outcome").isin("reject", "drop")).groupBy(F.col("key").alias(key)).agg(F.min(F.struct("stage", "outcome", "reason")).alias("_o"))
    return entities.join(out, key, "left").withColumns({"final_state": F.when(F.col("_o").isNotNull(), "dropped").otherwise("kept"), "final_reason": F.coalesce(F.concat_ws(":", "_o.stage", "_o.reason"), F.lit(""))}).drop("_o")


def edges(entities: DataFrame, key: str, ids: str, told: DataFrame | None, run: str) -> DataFrame:
    """(key, raw_post_id, first and last run): explicit edges, else those of the entities' evidence ids; one per pair, the last told."""
    if told is None:
        told = entities.select(key, F.explode(ids).alias("raw_post_id"), "first_seen_run_id", "last_seen_run_id")
    runs = {c: T.first_filled(F.col(c), F.lit(run)) for c in ("first_seen_run_id", "last_seen_run_id")}
    return last_by_key(told.select(key, "raw_post_id", "first_seen_run_id", "last_seen_run_id").withColumns(runs), [key, "raw_post_id"], ["last_seen_run_id"])


def publication(tables: dict[str, DataFrame], keys: dict[str, list[str]], defaults: dict[str, dict[str, str]], order: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Row sets as they are published: blank fields take the defaults (a value, or ``=column`` for another field), rows
    with a blank key part go, of several with one key the last in ``order`` stays."""
    out = {}
    for name, df in tables.items():
        fill = {c: T.first_filled(F.col(c), F.col(v[1:]) if v.startswith("=") else F.lit(v)) for c, v in defaults.get(name, {}).items()}
        out[name] = last_by_key(df.withColumns(fill) if fill else df, keys[name], order.get(name, []))
    return out


def publication_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of a publication."""
    return reduce(DataFrame.unionAll, [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()])


def publish(tables: dict[str, DataFrame], base: str, order: list[str]) -> Store:
    """Write the row sets in ``order`` and their counts, and show them all at once."""
    store = Store(next(iter(tables.values())).sparkSession, base)
    staged = {n: store.stage(n, tables[n]) for n in order if n in tables}
    counts = publication_counts({n: store.spark.read.parquet(f"{store.base}/{f}") for n, f in staged.items()})
    store.commit({**staged, "counts": counts}, replace=True)
    return store
