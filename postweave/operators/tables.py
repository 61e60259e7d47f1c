"""Keyed snapshot tables: upsert, insert-or-ignore, constraints, snapshots in a fixed write order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postweave.session import cut
from postweave.sources.store import Store


def upsert(old: DataFrame, new: DataFrame, keys: list[str], change: Iterable[str] | None = None) -> DataFrame:
    """New rows join, known rows take the ``change`` columns of the new row (all but the keys if not given) and keep the rest."""
    cols = [c for c in old.columns if c not in keys]
    moved = set(cols if change is None else change)
    o = old.select(*keys, F.struct(*cols).alias("_o"))
    n = new.select(*keys, F.struct(*cols).alias("_n"))
    both = o.join(n, keys, "full_outer")
    pick = lambda c: F.when(F.col("_n").isNull(), F.col(f"_o.{c}")).when(F.col("_o").isNull() | F.lit(c in moved), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}"))
    return both.select(*keys, *[pick(c).alias(c) for c in cols]).select(*old.columns)


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of unknown keys are added, others change nothing."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti").select(*old.columns))


def violations(df: DataFrame, checks: dict[str, Column], unique: list[str] | None = None) -> DataFrame:
    """(rule, violations): one pass for all row rules, one for uniqueness."""
    row = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    out = row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in checks])).alias("x")).select("x.*")
    if unique:
        twice = df.groupBy(*unique).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("violations"))
        out = out.unionAll(twice.select(F.lit(f"unique({', '.join(unique)})"), "violations"))
    return out


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose non-blank key has no parent."""
    return child.where(F.coalesce(F.col(child_key), F.lit("")) != "").join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def running_budget(rows: DataFrame, group: str, order: list[str], cost: str, soft: float, hard: float) -> DataFrame:
    """Running cost per group and whether a row is within the soft or hard budget; the row that would pass the hard one stops.

    A group is cut into ranges of its order; each range counts on from the sum of those before it, so no task holds a
    whole group.
    """
    parts = rows.repartitionByRange(group, *order)
    tagged = cut(parts.withColumn("_p", F.spark_partition_id()))
    per = tagged.groupBy(group, "_p").agg(F.sum(cost).alias("_s"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    per = per.select(F.col(group).alias("_g"), F.col("_p").alias("_q"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    w = Window.partitionBy("_p", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    met = tagged.join(per, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    spent = met.withColumn("spent", F.col("_s") + F.coalesce(F.sum(cost).over(w), F.lit(0))).withColumn("calls", F.col("_n") + F.count("*").over(w)).drop("_p", "_q", "_g", "_s", "_n")
    return spent.withColumn("budget", F.when(F.col("spent") > hard, "stopped").when(F.col("spent") > soft, "soft_exceeded").otherwise("ok"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with row_no from 1 in the order given.

    Row numbers come from a range partitioning with counts per partition, not from one task that sees all rows; the
    partitioning is written once, so that counts and rows are of the same cut.
    """
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = cut(parts.withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    per = tagged.groupBy("_p").agg(F.count("*").alias("n"), F.min("_m").alias("m"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    base = per.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    no = tagged.join(F.broadcast(base.select("_p", "m", "before")), "_p").withColumn("row_no", F.col("before") + F.col("_m") - F.col("m") + 1)
    return no.drop("_p", "_m", "m", "before")


def chunk(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Numbered chunks of ``size`` rows in the order given."""
    return numbered(rows, order).withColumn("chunk_no", F.floor((F.col("row_no") - 1) / size))


def apply_patches(rows: DataFrame, patches: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows with the differing, allowed fields of their patch set, and the names of the changed fields."""
    p = patches.select(key, *[F.col(f).alias(f"_p_{f}") for f in fields])
    j = rows.join(p, key, "left")
    differs = lambda f: F.col(f"_p_{f}").isNotNull() & ~F.col(f"_p_{f}").eqNullSafe(F.col(f))
    changed = F.array_compact(F.array(*[F.when(differs(f), f) for f in fields]))
    values = [F.coalesce(F.col(f"_p_{f}"), F.col(f)).alias(f) if f in fields else F.col(f) for f in rows.columns]
    return j.select(*values, changed.alias("changed"))


def decide(confidence: Column, threshold: float, recovered: float, safe: Column) -> Column:
    """accept at the threshold, recover between the two where it is safe, else reject."""
    return F.when(confidence >= threshold, "accept").when((confidence >= recovered) & safe, "recover").otherwise("reject")


def write_snapshots(tables: dict[str, DataFrame], base: str, order: list[str]) -> Store:
    """Write tables in ``order`` as one commit that replaces the last: readers see the old snapshot of all of them until the new one is whole."""
    spark = next(iter(tables.values())).sparkSession
    store = Store(spark, base)
    store.commit({name: tables[name] for name in order if name in tables}, replace=True)
    return store
