"""Problem 5: one group identifier for all records that are linked, directly or through others.

Method: two-dimensional grid.  Vertices are hashed into k blocks, an edge lies in the cell of its two blocks, and a
local union-find reduces every cell to stars.  Rows and columns then exchange representatives: each vertex takes the
best of its local roots as parent, edges are rewritten to parents, and rounds go on until no edge joins two different
parents.  Labels are read back through the rounds.

A vertex of many edges is spread over the cells of its row; after a cell's union-find it has at most one root per
cell.  The roots are chosen by a hash of the id, so the number of vertices falls by a constant factor per round
whatever the ids look like.  k follows the number of edges, so a cell holds about ``cell_edges`` of them at any size.

Defined results: null ids are no vertices, an edge of an id with itself and repeated edges change nothing, an empty
edge table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.operators.segment import cell_name, split_cells
from postweave.session import cut


def _stars(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the edges of a partition, taken in as they stream by; out: (v, root), roots themselves included."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for p in parts:
        for a, b in zip(p["a"], p["b"]):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = find(a), find(b)
            if ra != rb:
                if rb < ra:
                    ra, rb = rb, ra
                parent[rb] = ra
    names = list(parent)
    for i in range(0, len(names), 50_000):
        part = names[i : i + 50_000]
        yield pd.DataFrame({"v": part, "root": [find(v) for v in part]})


def connected_components(edges: DataFrame, cell_edges: int = 200_000) -> DataFrame:
    """From (a, b): (id, component) for every id of an edge; the component's name is one of its ids."""
    order = lambda c: F.concat(F.lpad(F.hex(F.xxhash64(c)), 16, "0"), c)
    now = edges.where("a is not null and b is not null and a <> b").select(order("a").alias("a"), order("b").alias("b"))
    now = cut(now.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while n := now.count():
        k = max(1, math.ceil(math.sqrt(2 * n / cell_edges)))
        block = lambda c, k=k: F.pmod(F.xxhash64(F.lit(len(rounds)), c), F.lit(k))
        cell = F.least(block("a"), block("b")) * k + F.greatest(block("a"), block("b"))
        stars = now.select("a", "b", cell.alias("cell")).repartition(k * (k + 1) // 2, "cell").select("a", "b").mapInPandas(_stars, "v string, root string")
        stars = cut(stars)
        parents = cut(stars.groupBy("v").agg(F.min("root").alias("p")))
        rounds.append(parents)
        # Edges by parents: the vertex side first, so that the many members of a star are one row before the second join.
        half = stars.join(parents, "v").select(F.col("p").alias("a"), F.col("root").alias("v")).distinct()
        now = half.join(parents, "v").select(F.least("a", "p").alias("a"), F.greatest("a", "p").alias("b")).where("a <> b").distinct()
        now = cut(now)
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component")).where("false")
    labels = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        later = labels.select(F.col("v").alias("p"), F.col("p").alias("q"))
        labels = earlier.join(later, "p", "left").select("v", F.coalesce("q", "p").alias("p"))
    return labels.select(F.substring("v", 17, 1 << 30).alias("id"), F.substring("p", 17, 1 << 30).alias("component"))


def phone_key(col: Column) -> Column:
    """A phone with its country code in digits only; without a code it is Serbian; null if there are under 8 digits."""
    d = F.regexp_replace(col, r"(?U)[^\d+]", "")
    d = F.when(d.startswith("+"), F.regexp_replace(d, r"\+", "")).when(d.startswith("00"), F.substring(d, 3, 100)).when(d.startswith("0"), F.concat(F.lit("381"), F.substring(d, 2, 100))).when(d.startswith("381") & (F.length(d) > 10), d).otherwise(F.concat(F.lit("381"), d))
    return F.when(F.length(d) >= 10, d)


def handle_keys(col: Column) -> Column:
    """The distinct handles of a cell: small letters, without address, sign or blanks."""
    found = F.regexp_extract_all(F.lower(col), F.lit(r"(?:(?:https?://)?(?:www\.)?(?:t|telegram)\.me/|@)?([a-z0-9_]{4,})(?![a-z0-9_.]*\.[a-z])"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda x: ~x.isin("https", "http", "telegram")))


def provider_links(providers: DataFrame, matches: DataFrame) -> DataFrame:
    """(a, b): records with records that match, and records with their phones and handles as further vertices."""
    keys = providers.select(F.col("provider_key").alias("key")).where("key is not null").distinct()
    told = matches.where("decision = 'match'").select(F.col("left_provider_key").alias("a"), F.col("right_provider_key").alias("b")).where("a <> b").distinct()
    told = told.join(keys.select(F.col("key").alias("a")), "a", "left_semi").join(keys.select(F.col("key").alias("b")), "b", "left_semi").select("a", "b")
    # "￿" sorts behind every record key.
    cells = providers.select(F.lit("phones").alias("field"), F.col("phones").alias("cell"), F.col("provider_key").alias("key")).where("cell <> ''")
    split = split_cells(cells.select("field", "cell"))
    named = cells.select("field", "key", cell_name(F.col("cell")).alias("cid"))
    phones = named.join(split.select("field", "cid", "items"), ["field", "cid"]).select("key", F.explode("items").alias("item")).select(F.col("key").alias("a"), phone_key(F.col("item")).alias("k"))
    phones = phones.where("k is not null").select("a", F.concat(F.lit("￿phone:"), "k").alias("b"))
    handles = providers.where("telegram_handles <> ''").select(F.col("provider_key").alias("a"), F.explode(handle_keys(F.col("telegram_handles"))).alias("k"))
    return told.unionAll(phones).unionAll(handles.select("a", F.concat(F.lit("￿handle:"), "k").alias("b")))


def provider_groups(providers: DataFrame, matches: DataFrame) -> DataFrame:
    """(provider_key, group_key) of every record linked to another; the group is named by its smallest key."""
    of = cut(connected_components(provider_links(providers, matches)).where(~F.col("id").startswith("￿")))
    groups = of.groupBy("component").agg(F.min("id").alias("group_key"), F.count("*").alias("n")).where("n > 1")
    return of.join(groups, "component").select(F.col("id").alias("provider_key"), "group_key")
