"""Review layer: candidates, parsed decisions, patches, audit rows, coverage and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from postweave.functions import text as T
from postweave.operators.tables import numbered

DECISION = t.StructType([t.StructField("decision_code", t.StringType()), t.StructField("confidence", t.DoubleType()), t.StructField("patch", t.MapType(t.StringType(), t.StringType())), t.StructField("reason_text", t.StringType())])


_REPLY = "output_text string, output array<struct<type:string,content:array<struct<type:string,text:string>>>>, text string, incomplete_details struct<reason:string>"


def output_text(c: Column) -> Column:
    """The text of a model's reply: that of the reply itself, or the parts of its nested output one after the other; a text that is no reply is itself."""
    r = F.from_json(c, _REPLY, {"mode": "PERMISSIVE"})
    parts = F.flatten(F.transform(r["output"], lambda o: F.transform(F.coalesce(o["content"], F.array().cast("array<struct<type:string,text:string>>")), lambda p: p["text"])))
    nested = F.nullif(F.array_join(F.array_compact(parts), ""), F.lit(""))
    return F.coalesce(F.nullif(r["output_text"], F.lit("")), nested, F.nullif(r["text"], F.lit("")), c)


def cut_short(c: Column) -> Column:
    """Why a reply was cut short, empty if it was not."""
    return T.or_empty(F.from_json(c, _REPLY, {"mode": "PERMISSIVE"})["incomplete_details"]["reason"])


def parse_decision(c: Column) -> Column:
    """struct<decision, error>: a model's text as a decision; fences go, confidence is held to 0..1."""
    body = F.trim(F.regexp_replace(F.regexp_replace(T.or_empty(c), "^\\s*```[a-z]*\\s*", ""), "\\s*```\\s*$", ""))
    got = F.from_json(body, DECISION, {"mode": "PERMISSIVE"})
    opened = F.regexp_count(body, F.lit("\\{")) > F.regexp_count(body, F.lit("\\}"))
    error = F.when(body == "", "empty_output").when(opened, "truncated_json").when(got.isNull() | (got["decision_code"].isNull() & got["confidence"].isNull()), "invalid_json").when(got["decision_code"].isNull() | got["confidence"].isNull(), "missing_field")
    held = F.struct(got["decision_code"].alias("decision_code"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), got["confidence"])).alias("confidence"), got["patch"].alias("patch"), F.coalesce(got["reason_text"], F.lit("")).alias("reason_text"))
    return F.struct(F.when(error.isNull(), held).alias("decision"), error.alias("error"))


def sanitize_patch(patch: Column, allowed: dict[str, int], refuse: str = "(?i)https?://|\\+?\\d[\\d\\s()-]{7,}|€|\\brsd\\b|\\beur\\b") -> Column:
    """A patch with allowed fields only, each within its length, and without made-up addresses, phones or prices."""
    limit = F.create_map(*[F.lit(x) for kv in allowed.items() for x in kv])
    return F.map_filter(patch, lambda k, v: F.map_contains_key(limit, k) & v.isNotNull() & (F.length(v) <= F.try_element_at(limit, k)) & ~v.rlike(refuse))


def with_fallback(reviewed: DataFrame, deterministic: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The reviewed value of each field, else the deterministic one."""
    r = reviewed.select(key, *[F.col(f).alias(f"_r_{f}") for f in fields])
    return deterministic.join(r, key, "left").select(key, *[F.coalesce(f"_r_{f}", f).alias(f) for f in fields])


def audit_rows(decisions: DataFrame, run: str, stage: str, entity: str, text: str, confidence: str, reason: str) -> DataFrame:
    """One audit row per decision with a stable id."""
    ident = F.concat_ws(":", F.lit("audit"), F.col(run), F.col(stage), F.substring(T.stable_hash(F.col(entity), F.col(stage), F.col(text)), 1, 16))
    return decisions.select(ident.alias("audit_row_id"), F.col(run), F.col(stage), F.col(entity).alias("entity_key"), T.text_hash(F.col(text)).alias("input_hash"), T.excerpt(T.normalize_text(F.col(text)), 240).alias("excerpt"), T.excerpt(T.or_empty(F.col(reason)), 240).alias("reason"), F.round(confidence, 4).alias("confidence"))


def known_enum(c: Column, values: tuple[str, ...], alias: dict[str, str]) -> Column:
    """A known value or its alias; anything else is an error row's null."""
    for a, b in alias.items():
        c = F.when(c == a, b).otherwise(c)
    return F.when(c.isin(*values), c)


def stage_counters(rows: DataFrame, stage: str, status: str, statuses: tuple[str, ...]) -> DataFrame:
    """Per stage the number of rows in each state."""
    return rows.groupBy(stage).agg(F.count("*").alias("total"), *[F.count_if(F.col(status) == s).alias(s) for s in statuses])


def coverage(total: Column, accepted: Column, dropped: Column, reason: Column) -> Column:
    """complete if every candidate was accepted or dropped and nothing stands against it."""
    return F.when((T.or_empty(reason) == "") & (total == accepted + dropped), "complete").when(T.or_empty(reason) != "", "failed").otherwise("incomplete")


def may_publish(cov: Column, total: Column, rows: Column) -> Column:
    """Only complete coverage whose rows match its count opens the sinks."""
    return (cov == "complete") & (total == rows)


def evidence(entities: DataFrame, key: str, ids: str, posts: DataFrame, post_key: str, text: str, k: int = 3) -> DataFrame:
    """(key, excerpts): the first ``k`` evidence posts in order; a missing one is a blank."""
    flat = entities.select(key, F.posexplode(F.slice(F.col(ids), 1, k)).alias("pos", post_key))
    own = posts.groupBy(post_key).agg(F.max(text).alias("_t"))
    got = flat.join(own, post_key, "left").select(key, F.struct("pos", F.col(post_key).alias("id"), T.excerpt(T.normalize_text(F.col("_t")), 240).alias("excerpt")).alias("e"))
    return got.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: F.struct(e["id"].alias("id"), e["excerpt"].alias("excerpt"))).alias("excerpts"))


def evidence_edges(entities: DataFrame, key: str, ids: str, edges: DataFrame | None = None) -> DataFrame:
    """Explicit edges where an entity has some, else its evidence ids."""
    own = entities.select(key, F.explode(ids).alias("raw_post_id"))
    if edges is None:
        return own.distinct()
    told = edges.select(key, "raw_post_id")
    return told.unionAll(own.join(told.select(key), key, "left_anti")).distinct()


def best_text(rows: DataFrame, by: str, text: str, ts: str) -> DataFrame:
    """Per group the text with most words, then the longest, then the earliest."""
    n = F.size(T.tokens(F.col(text)))
    order = F.struct((-n).alias("n"), (-F.length(T.or_empty(F.col(text)))).alias("l"), F.col(ts).isNull().alias("x"), F.col(ts).alias("t"), F.col(text).alias("v"))
    return rows.where(T.or_empty(F.col(text)) != "").groupBy(by).agg(F.min(order).alias("o")).select(by, F.col("o.v").alias(text))


def merge_summary(posts: DataFrame, clusters: DataFrame, entity: str) -> DataFrame:
    """Posts, entities, and how many posts were merged into another's entity."""
    a = posts.agg(F.countDistinct("raw_post_id").alias("posts"))
    b = clusters.agg(F.countDistinct(entity).alias("entities"), F.count_if(F.col(entity).contains(":raw_post:")).alias("provisional"))
    rows = a.unionByName(b, True).agg(*[F.max(c).alias(c) for c in ("posts", "entities", "provisional")])
    return rows.withColumn("merges", F.col("posts") - F.col("entities"))


def token_estimate(c: Column) -> Column:
    """Input tokens a text is reckoned at before it is sent."""
    return F.greatest(F.lit(220), F.ceil(F.length(T.or_empty(c)) / 4).cast("int") + 200)


def cost_estimate(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    """What a call costs at prices per million tokens, to six places."""
    return F.round((tokens_in * price_in + tokens_out * price_out) / 1_000_000, 6)


def mock_decisions(candidates: DataFrame, responses: DataFrame, schema: str, order: list[str]) -> DataFrame:
    """Saved responses in place of a model: the n-th candidate of a schema takes its n-th response, beyond them the last.

    Candidates are numbered over all schemas by range, and each schema counts from its first number, so no task holds a
    whole schema.
    """
    c = numbered(candidates, [schema, *order])
    first = c.groupBy(schema).agg(F.min("row_no").alias("_first"))
    c = c.join(first, schema).withColumn("attempt", (F.col("row_no") - F.col("_first") + 1).cast("int")).drop("row_no", "_first")
    n = responses.groupBy(schema).agg(F.max("attempt").alias("_last"))
    j = c.join(n, schema, "left").withColumn("_use", F.least("attempt", "_last"))
    return j.join(responses.select(schema, F.col("attempt").alias("_use"), "output"), [schema, "_use"], "left").drop("_use", "_last")
