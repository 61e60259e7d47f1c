"""Problem 9: evaluation passages inside training documents.

Method: training suffix arrays.  The documents are cut into shards of about ``SHARD_WORDS`` words; each shard is one
array of word ids (64-bit hashes of folded words) with walls between documents, and an array of its suffixes sorted
by prefix doubling.  Every test suffix is looked up in every shard by binary search, and each hit is extended to the
longest common run with its places in both texts.  Suffixes with a wall within their first ``least`` words cannot
match and are left out.  The shards depend on the documents only: ``SuffixIndex`` stores them, so later test sets
read no document text again, and a run with several blocks of tests folds the corpus once.

The tests are a stated query set: they are folded on the workers, cut into pieces of at most an eighth of
``block_words`` words (overlapping by ``least - 1``, so no run of ``least`` words is lost) and looked up in blocks of
about ``block_words`` words, one after the other.  Only one block is on the driver or broadcast at a time, so neither
grows with the tests or the corpus.

Texts without ``least`` words, null and empty ones and rows without key have no hits.  Rows are (key, item, words,
doc_pos, item_pos): the longest run per pair, the earliest at ties; a run in an item longer than a piece counts
within its piece.  Repeated documents and items change nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postweave.llm.canon import fold_words
from postweave.session import cut
from postweave.sources.store import Store

WALL = np.iinfo(np.int64).min  # sorts before every word
SHARD_WORDS = 1_000_000


class WordIds:
    """64-bit ids of words; what is remembered is bounded."""

    def __init__(self, keep: int = 400_000) -> None:
        self.known: dict[str, int] = {}
        self.keep = keep

    def __call__(self, words: list[str]) -> list[int]:
        known, out = self.known, []
        for w in words:
            i = known.get(w)
            if i is None:
                i = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
                if i == WALL:
                    i += 1
                if len(known) < self.keep:
                    known[w] = i
            out.append(i)
        return out


def whole_runs(ids: np.ndarray, least: int) -> np.ndarray:
    """The positions whose next ``least`` ids hold no wall."""
    if len(ids) < least:
        return np.empty(0, dtype=np.int64)
    walls = np.concatenate([[0], np.cumsum(ids == WALL)])
    return np.flatnonzero(walls[least:] == walls[:-least])


def suffix_array(ids: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """``starts`` in the order of the suffixes there, by their first 2**k >= least words (prefix doubling)."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    size = 1
    while size < least:
        after = np.zeros_like(rank)
        after[:-size] = rank[size:]
        rank = np.unique(rank * (int(after.max()) + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        size *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def search(ids: np.ndarray, order: np.ndarray, test: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix, the range of ``order`` whose first ``least`` words are the same."""

    def compare(mid: np.ndarray, rows: np.ndarray) -> np.ndarray:
        state = np.zeros(len(mid), dtype=np.int8)
        at, open_ = order[mid], np.arange(len(mid))
        for k in range(least):
            a, b = ids[at[open_] + k], test[starts[rows[open_]] + k]
            state[open_] = (a > b).astype(np.int8) - (a < b).astype(np.int8)
            open_ = open_[a == b]
            if not len(open_):
                break
        return state

    for right in (False, True):
        lo, hi = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), len(order), dtype=np.int64)
        rows = np.flatnonzero(lo < hi)
        while len(rows):
            mid = (lo[rows] + hi[rows]) // 2
            c = compare(mid, rows)
            up = (c < 0) | (right & (c == 0))
            lo[rows[up]] = mid[up] + 1
            hi[rows[~up]] = mid[~up]
            rows = rows[lo[rows] < hi[rows]]
        if right:
            hi = first.copy()
            hi[held] = lo
            return first, hi
        # Only suffixes whose lower end is of the same words have a range.
        first, same = lo, np.flatnonzero(lo < len(order))
        held = same[compare(lo[same], same) == 0]
        starts = starts[held]
    raise AssertionError


class Shard:
    """Word ids of some documents, their sorted suffixes, and where each document begins."""

    def __init__(self, keys: list[Any], ids: np.ndarray, order: np.ndarray, begins: np.ndarray) -> None:
        self.keys, self.ids, self.order, self.begins = keys, ids, order, begins

    @classmethod
    def of(cls, keys: list[Any], docs: list[list[int]], least: int) -> Shard:
        sizes = np.array([len(d) + 1 for d in docs], dtype=np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        ids = np.full(int(sizes.sum()) + least, WALL, dtype=np.int64)
        for b, d in zip(begins, docs):
            ids[b : b + len(d)] = d
        return cls(keys, ids, suffix_array(ids, whole_runs(ids, least), least), begins)

    def hits(self, tests: TestSet) -> Iterator[tuple[Any, int, int, int, int]]:
        """(key, item, words, doc_pos, item_pos) of each longest run that begins at a hit."""
        ids, order, least = self.ids, self.order, tests.least
        if not len(order) or not len(tests.starts):
            return
        lo, hi = search(ids, order, tests.ids, tests.starts, least)
        n, m = len(ids), len(tests.ids)
        for k in np.flatnonzero(hi > lo):
            t = int(tests.starts[k])
            for s in order[lo[k] : hi[k]]:
                s = int(s)
                # A hit that only continues the run of its left neighbour is reported there.
                if s and t and ids[s - 1] != WALL and ids[s - 1] == tests.ids[t - 1]:
                    continue
                e = least
                while s + e < n and t + e < m and ids[s + e] != WALL and ids[s + e] == tests.ids[t + e]:
                    e += 1
                d = int(np.searchsorted(self.begins, s, side="right")) - 1
                yield self.keys[d], int(tests.item[t]), e, s - int(self.begins[d]), int(tests.pos[t])


class TestSet:
    """The word ids of a block of pieces (item, offset, ids) as one array."""

    __test__ = False

    def __init__(self, pieces: Iterable[tuple[int, int, list[int]]], least: int) -> None:
        self.least = least
        ids: list[int] = []
        item: list[int] = []
        pos: list[int] = []
        for i, at, ws in pieces:
            ids += [*ws, WALL]
            item += [i] * (len(ws) + 1)
            pos += range(at, at + len(ws) + 1)
        self.ids = np.array(ids + [WALL] * least, dtype=np.int64)
        self.item = np.array(item + [0] * least, dtype=np.int64)
        self.pos = np.array(pos + [0] * least, dtype=np.int64)
        self.starts = whole_runs(self.ids, least)


def _shards(parts: Iterable[pd.DataFrame], least: int) -> Iterator[Shard]:
    ids = WordIds()
    keys: list[Any] = []
    docs: list[list[int]] = []
    size = 0
    for p in parts:
        for k, t in zip(p["k"], p["t"]):
            ws = ids(fold_words(t)) if isinstance(t, str) else []
            if len(ws) < least:
                continue
            if docs and size + len(ws) > SHARD_WORDS:
                yield Shard.of(keys, docs, least)
                keys, docs, size = [], [], 0
            keys.append(k)
            docs.append(ws)
            size += len(ws)
    if docs:
        yield Shard.of(keys, docs, least)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null")


class SuffixIndex:
    """The shards of a corpus in a store; documents that come later are added as further shards."""

    def __init__(self, store: Store) -> None:
        self.store, self.least = store, store.meta["least"]

    @classmethod
    def build(cls, docs: DataFrame, key: str, text: str, base: str, least: int = 13) -> SuffixIndex:
        store = Store(docs.sparkSession, base)
        store.commit({"shards": cls._of(docs, key, text, least)}, {"least": least, "kind": docs.schema[key].dataType.simpleString()})
        return cls(store)

    @classmethod
    def open(cls, spark: SparkSession, base: str) -> SuffixIndex:
        return cls(Store(spark, base))

    def add(self, docs: DataFrame, key: str, text: str) -> None:
        self.store.commit({"shards": self._of(docs, key, text, self.least)})

    @staticmethod
    def _of(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
        def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for s in _shards(parts, least):
                yield pd.DataFrame({"keys": [list(s.keys)], "ids": [s.ids.tobytes()], "suffixes": [s.order.astype(np.int32).tobytes()], "begins": [s.begins.tobytes()]})

        return _rows(docs, key, text).mapInPandas(run, f"keys array<{docs.schema[key].dataType.simpleString()}>, ids binary, suffixes binary, begins binary")


def _test_pieces(items: DataFrame, item: str, item_text: str, least: int, size: int) -> DataFrame:
    """(item, at, ids) of every test item, in pieces that overlap by ``least - 1`` words."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for p in parts:
            rows = []
            for i, t in zip(p["i"], p["t"]):
                ws = ids(fold_words(t))
                rows += [(i, a, ws[a : a + size]) for a in range(0, max(1, len(ws) - least + 1), size - least + 1) if len(ws) >= least]
            yield pd.DataFrame(rows, columns=["item", "at", "ids"])

    rows = items.select(F.col(item).cast("bigint").alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null").distinct()
    return rows.mapInPandas(run, "item bigint, at int, ids array<bigint>")


def leaks(docs: DataFrame | SuffixIndex, key: str, text: str, items: DataFrame, item: str, item_text: str, least: int = 13, block_words: int = 200_000, base: str | None = None) -> DataFrame:
    """The longest run of at least ``least`` words of each document and item that share one.

    ``docs`` may be a stored index.  Documents are indexed in the new folder ``base`` first if it is given; else
    shards live in the workers only, once for each block of tests.
    """
    spark = items.sparkSession
    pieces = cut(_test_pieces(items, item, item_text, least, max(2 * least, block_words // 8)))
    total = pieces.agg(F.sum(F.size("ids"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    if base is not None and isinstance(docs, DataFrame):
        docs = SuffixIndex.build(docs, key, text, base, least)
    if isinstance(docs, SuffixIndex):
        if docs.least != least:
            raise ValueError(f"the index is of {docs.least} words, not {least}")
        source, kind = docs.store.read("shards"), docs.store.meta["kind"]
    else:
        source, kind = _rows(docs, key, text), docs.schema[key].dataType.simpleString()
    stored = isinstance(docs, SuffixIndex)
    out = None
    for b in range(blocks):
        mine = pieces.where(F.pmod(F.xxhash64("item", "at"), F.lit(blocks)) == b)
        tests = spark.sparkContext.broadcast(TestSet(((r["item"], r["at"], r["ids"]) for r in mine.toLocalIterator()), least))

        def run(parts: Iterable[pd.DataFrame], tests=tests) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            if stored:
                shards = (Shard(list(k), np.frombuffer(i, np.int64), np.frombuffer(s, np.int32).astype(np.int64), np.frombuffer(a, np.int64)) for p in parts for k, i, s, a in zip(p["keys"], p["ids"], p["suffixes"], p["begins"]))
            else:
                shards = _shards(parts, least)
            for shard in shards:
                yield pd.DataFrame(list(shard.hits(tests.value)), columns=["k", "i", "w", "dp", "ip"])

        part = source.mapInPandas(run, f"k {kind}, i bigint, w int, dp int, ip int")
        if blocks > 1:
            part = cut(part)
            tests.unpersist()
        out = part if out is None else out.unionAll(part)
    best = Window.partitionBy("k", "i").orderBy(F.desc("w"), "dp", "ip")
    found = out.withColumn("rn", F.row_number().over(best)).where("rn = 1")
    return found.select(F.col("k").alias(key), F.col("i").alias(item), F.col("w").alias("words"), F.col("dp").alias("doc_pos"), F.col("ip").alias("item_pos"))


def without_leaks(docs: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """The documents that hold no test passage."""
    return docs.join(found.select(key).distinct(), key, "left_anti")
