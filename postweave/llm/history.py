"""Problem 4: new batches against all history, without reading the history's texts again.

Method: bit-difference fingerprints in rotated block tables.  A text's words give a fingerprint of 1024 bits whose
bits differ in proportion to the angle between word vectors (rare words weigh more).  Rotating the fingerprint brings
each of its 64 blocks to the front in turn; the block tables hold (rotation, front block).  A new text is looked up
by exact blocks only; candidates pass a distance on 64 bits, then on all 1024, and last the words themselves are
aligned.  New fingerprints are appended, old ones are never computed again.

The history is a store (``sources/store``) of written tables that each batch appends to with one commit: texts (name,
words, fingerprint, offer), block tables with those of close repeats marked, keys, sightings of each offer, and the
answers.  Every batch reads each table in one scan, however many batches came before, so plans do not grow; a batch
that was interrupted leaves the history as it was.  ``compact`` writes the parts of a long history as one and makes
the blocks wider: a front has as many bits as the logarithm of the number of texts, 16 at least, so that the
texts that share one by chance stay about as many as there are rotations.

A row repeats an earlier record if it has its key, or if both have a description and their words, in order, agree to
``least`` (a ratio of matching words of 0.8; texts that share some sentences stay far below).  The earliest record of
an offer gives the key.  Rows of one batch are compared with one another in the order of their ids.

Copies of a text are one entry of the tables.  A repeat no further than ``drift`` from the offer it repeats is marked
close, and only rows without a match among the others are looked up among those, so an offer with a third of all rows has few
entries in the first and its rows meet the one accepted record.  Fronts that many new rows hold (boilerplate) are
split over salts.
Null and empty descriptions and stand-ins for missing ones repeat by key only; null keys repeat by text only.  Where a
description has one or two words a title could carry the ratio alone, so the descriptions must agree to ``least`` too.
"""

from __future__ import annotations

import gc
import hashlib
import math
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postweave.llm.canon import fold_words
from postweave.llm.survivors import STAND_INS
from postweave.session import cut
from postweave.sources.store import Store

WORDS64 = 16  # 64-bit words of a fingerprint
ROTATIONS = 64  # one every 16 bits
HOT = 10_000  # rows of a batch with one front, beyond which it is split
FEW = 20_000  # rows of a batch whose blocks (64 of some 80 bytes each) are broadcast
TOGETHER = 20_000  # rows of waiting batches that are added in one go
NEAR = 260  # bits of 1024 that may differ
SHORT = 2  # words of a description that a title outweighs
NEAR64 = 26  # bits of the first 64 that may differ
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _spread(h: np.ndarray) -> np.ndarray:
    """(n, 1024) of +1 and -1: sixteen mixed copies of each word's hash."""
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64)[:, None] + (np.arange(1, WORDS64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return np.unpackbits(np.ascontiguousarray(x).view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def fingerprint(words: list[list[int]], weight: dict[int, float], rare: float) -> np.ndarray:
    """(n, 16) uint64 fingerprints of lists of word hashes."""
    out = np.zeros((len(words), WORDS64 * 64), dtype=np.float32)
    flat = sorted({w for ws in words for w in ws})
    if flat:
        place = {w: i for i, w in enumerate(flat)}
        for lo in range(0, len(flat), 4096):
            part = flat[lo : lo + 4096]
            m = _spread(np.array(part, dtype=np.int64).view(np.uint64)) * np.array([weight.get(w, rare) for w in part], dtype=np.float32)[:, None]
            rows, cols = [], []
            for r, ws in enumerate(words):
                for w in dict.fromkeys(ws):  # a repeated word counts once
                    if lo <= place[w] < lo + 4096:
                        rows.append(r)
                        cols.append(place[w] - lo)
            if rows:
                order = np.array(rows)
                starts = np.flatnonzero(np.diff(order, prepend=-1))
                for a in range(0, len(starts), 256):
                    s = starts[a : a + 256]
                    end = starts[a + 256] if a + 256 < len(starts) else len(order)
                    out[order[s]] += np.add.reduceat(m[cols[s[0] : end]], s - s[0], axis=0)
    return np.packbits(out > 0, axis=1).view(np.uint64)


def read_words(src: DataFrame, keep: list[str]) -> DataFrame:
    """From ``keep``, _title, _text: ``keep``, rid (the text's name, null without words), words (of title and text), own (words of the text, 0 for a stand-in)."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for p in parts:
            rid, words, own = [], [], []
            for a, b in zip(p["_title"], p["_text"]):
                ta, tb = fold_words(a if isinstance(a, str) else None), fold_words(b if isinstance(b, str) else None)
                if len(seen) > 500_000:
                    seen.clear()
                ws = ta + tb
                for w in ws:
                    if w not in seen:
                        seen[w] = _hash(w)
                rid.append(hashlib.blake2b(" ".join([*ta, "\n", *tb]).encode("utf-8", "surrogatepass"), digest_size=16).digest() if ws else None)
                words.append([seen[w] for w in ws])
                own.append(0 if isinstance(b, str) and b.strip().lower() in STAND_INS else len(tb))
            out = p[keep].copy()
            out["rid"], out["words"], out["own"] = rid, words, own
            yield out

    kinds = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)
    return src.mapInPandas(run, f"{kinds}, rid binary, words array<bigint>, own int")


def add_fingerprints(rows: DataFrame, weight: dict[int, float], rare: float) -> DataFrame:
    """``rows`` (rid, words, ...) with fp."""
    shared = rows.sparkSession.sparkContext.broadcast(weight)

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for i in range(0, len(p), 512):
                q = p.iloc[i : i + 512].copy()
                fp = fingerprint([list(w) for w in q["words"]], shared.value, rare)
                q["fp"] = [list(r) for r in fp.view(np.int64)]
                yield q

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{kinds}, fp array<bigint>")


def blocks(rows: DataFrame, bits: int, *keep: str) -> DataFrame:
    """The block table: (rot, front, sketch, *keep), one row per rotation; a front has ``bits`` (16 to 32) of them."""
    part = F.flatten(F.transform("fp", lambda w: F.array(*[F.shiftrightunsigned(w, 16 * k).bitwiseAND(F.lit(65535).cast("bigint")) for k in range(4)])))
    own = rows.select(F.col("fp")[0].alias("sketch"), *keep, part.alias("b"))
    if bits > 16:
        # The next block gives the further bits.
        after = F.concat(F.slice("b", 2, ROTATIONS), F.slice("b", 1, 1))
        own = own.withColumn("b", F.zip_with("b", after, lambda x, y: F.shiftleft(x, bits - 16) + F.shiftrightunsigned(y, 32 - bits)))
    turns = own.select("sketch", *keep, F.posexplode("b").alias("rot", "front"))
    return turns.select(F.col("rot").cast("smallint").alias("rot"), "front", "sketch", *keep)


def width(n: int) -> int:
    """Bits of a front for a history of ``n`` texts."""
    return min(32, max(16, math.ceil(math.log2(max(2, n)))))


def _agreement(a: list[int], b: list[int], least: float) -> float:
    """The ratio of words that align in order; 0 where it cannot reach ``least``."""
    n = len(a) + len(b)
    if not n or 2 * min(len(a), len(b)) / n < least:
        return 0.0
    m = SequenceMatcher(None, a, b, autojunk=False)
    return m.ratio() if m.quick_ratio() >= least else 0.0


def verified(pairs: DataFrame, least: float) -> DataFrame:
    """From (..., words_a, own_a, words_b, own_b): the pairs whose words agree, with the ratio."""

    def agree(a: list[int], m: int, b: list[int], n: int) -> float:
        if min(m, n) <= SHORT and _agreement(a[-m:], b[-n:], least) < least:
            return 0.0
        return _agreement(a, b, least)

    @F.pandas_udf("double")
    def ratio(a: pd.Series, m: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([agree(list(x), i, list(y), j) for x, i, y, j in zip(a, m, b, n)], dtype="float64")

    return pairs.withColumn("ratio", ratio("words_a", "own_a", "words_b", "own_b")).where(F.col("ratio") >= least).drop("words_a", "own_a", "words_b", "own_b")


def _far(a: str, b: str) -> Column:
    """Bits in which two fingerprints differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


class History:
    """What has been accepted, in a store: texts (rid, words, fp, own, offer, close), blocks (rot, front, sketch, rid, close), keys (key, offer), sightings (offer, no, run, seen), answers (id, key, offer, repeat)."""

    def __init__(self, store: Store) -> None:
        if store.version < 0:
            raise ValueError(f"no history in {store.base}")
        self.store, self.spark = store, store.spark
        m = store.meta
        self.rare, self.least, self.drift, self.bits = m["rare"], m["least"], m["drift"], m["bits"]
        self._weight: dict[int, float] | None = None
        self.added: list[str] = []  # folders of the answers to what was added here

    @property
    def weight(self) -> dict[int, float]:
        if self._weight is None:
            # Bounded by ``most`` of ``start``.
            self._weight = {r["w"]: r["weight"] for r in self.store.read("weights").collect()}
        return self._weight

    @classmethod
    def open(cls, spark: SparkSession, base: str) -> History:
        """The history that an earlier session stored in ``base``."""
        return cls(Store(spark, base))

    @classmethod
    def start(cls, records: DataFrame, base: str, key: str, seen: str, title: str, text: str, run: str | None = None, times: str | None = None, share: float = 0.002, most: int = 100_000, least: float = 0.8, drift: float = 0.9) -> History:
        """The tables of an accepted history, in the new folder ``base``; its word weights are fixed here.

        ``run`` and ``times`` name the columns of the run that first saw a record and of its sightings so far (one
        where there is none).  Words of more than ``share`` of the texts get a weight, the ``most`` frequent at most;
        any other word counts as rare.  So the table of weights is bounded whatever the size of the history or of its
        texts.
        """
        spark = records.sparkSession
        store = Store(spark, base)
        if store.version >= 0:
            raise ValueError(f"{base} holds a history already")
        src = records.select(F.col(key).alias("key"), F.col(seen).alias("seen"), (F.col(run) if run else F.lit(None)).cast("string").alias("run"), (F.col(times) if times else F.lit(1)).cast("bigint").alias("times"), F.col(title).alias("_title"), F.col(text).alias("_text"))
        read = cut(read_words(src, ["key", "seen", "run", "times"]))
        first = F.min_by(F.struct("words", "own", F.col("key").alias("offer")), F.struct(F.col("seen").isNull(), "seen", "key"))
        rows = cut(read.where("rid is not null and key is not null").groupBy("rid").agg(first.alias("m")).select("rid", "m.*"))
        n = max(1, rows.count())
        df = rows.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") > share * n).orderBy(F.desc("n"), "w").limit(most)
        weights = cut(df.select("w", F.sqrt(F.log(n / F.col("n")) + 0.05).alias("weight")))
        rare, bits = float(np.sqrt(np.log(min(n, 1 / share)) + 0.05)), width(n)
        weight = {r["w"]: r["weight"] for r in weights.collect()}
        staged = store.stage("texts", add_fingerprints(rows, weight, rare).select("rid", "words", "own", "offer", "fp", F.lit(False).alias("close")))
        texts = spark.read.parquet(f"{store.base}/{staged}")
        known = read.where("key is not null")
        tables = {
            "weights": weights, "texts": staged, "blocks": _sorted(blocks(texts.where("own > 0"), bits, "rid", "close")),
            # A key stands for the offer of the earliest record with it; a copy under another key stays its own record.
            "keys": known.select("key", F.col("key").alias("offer")).distinct(),
            "sightings": known.groupBy(F.col("key").alias("offer")).agg(F.lit(0).alias("no"), F.min_by("run", F.struct(F.col("seen").isNull(), "seen", "run")).alias("run"), F.sum(F.coalesce("times", F.lit(1))).alias("seen")),
        }
        store.commit(tables, {"rare": rare, "least": least, "drift": drift, "bits": bits, "texts": n, "order": 0})
        return cls(store)

    def _candidates(self, new: DataFrame, few: bool, table: DataFrame, texts: DataFrame, name: str) -> DataFrame:
        """(id, other, ratio): earlier texts near ``new`` (id, rid, words, fp); ``few``: at most FEW rows, so their blocks are broadcast."""
        look = blocks(new, self.bits, "id").withColumnRenamed("sketch", "mine")
        on = ["rot", "front"]
        if few:
            look = F.broadcast(look)
        else:
            hot = look.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > HOT).select(*on, F.ceil(F.col("n") / HOT).cast("int").alias("salts"))
            hot = cut(hot)
            look = look.join(hot, on, "left").withColumn("salt", F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
            table = table.join(hot, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
            on = [*on, "salt"]
        hit = table.join(look, on).where(F.bit_count(F.col("mine").bitwiseXOR(F.col("sketch"))) <= NEAR64)
        if name == "id2":
            hit = hit.where("id2 < id")
        hit = hit.select("id", name).distinct()
        a = new.select("id", F.col("words").alias("words_a"), F.col("own").alias("own_a"), F.col("fp").alias("fp_a"))
        b = texts.select(name, F.col("words").alias("words_b"), F.col("own").alias("own_b"), F.col("fp").alias("fp_b"))
        pairs = hit.join(b, name).join(a, "id").where(_far("fp_a", "fp_b") <= NEAR)
        return verified(pairs.drop("fp_a", "fp_b"), self.least)

    def add(self, batch: DataFrame, order: str, key: str, title: str, text: str, run: str | None = None) -> DataFrame:
        """(id, key, offer, repeat) of a batch, which is then part of the history.

        ``run`` names the column of the run that a row claims to be first seen in; that of its first row is the offer's.
        """
        src = batch.select(F.col(order).alias("id"), F.col(key).alias("key"), (F.col(run) if run else F.lit(None)).cast("string").alias("run"), F.col(title).alias("_title"), F.col(text).alias("_text"))
        rows = cut(add_fingerprints(read_words(src, ["id", "key", "run"]), self.weight, self.rare))
        few = rows.count() <= FEW
        texts = self.store.read("texts")
        known = rows.select("id", "key", "rid", "own", "run").join(self.store.read("keys").select("key", F.col("offer").alias("by_key")), "key", "left")
        known = known.join(texts.where("own > 0").select("rid", F.col("offer").alias("by_text")), "rid", "left")
        known = cut(known.withColumn("offer", F.coalesce("by_key", "by_text")))
        # One row per text: the earliest.
        told = rows.where("own > 0")
        by_rid = told.groupBy("rid").agg(F.min("id").alias("pr"))
        peers = cut(told.join(by_rid.select(F.col("pr").alias("id")), "id", "left_semi").select("id", "rid", "words", "own", "fp"))
        alone = peers.join(known.where("offer is null").select("id"), "id", "left_semi")
        of = texts.select("rid", "words", "own", "fp")
        stored = self.store.read("blocks")
        near = cut(self._candidates(alone.drop("rid"), few, stored.where("not close").drop("close"), of, "rid"))
        if self.store.meta["order"]:
            near = near.unionAll(self._candidates(alone.drop("rid").join(near.select("id"), "id", "left_anti"), few, stored.where("close").drop("close"), of, "rid"))
        near = near.join(texts.select("rid", "offer"), "rid")
        near = cut(near.groupBy("id").agg(F.max_by(F.struct("offer", "ratio"), F.struct("ratio", F.col("offer"))).alias("m")).select("id", "m.offer", "m.ratio"))
        # Within the batch: an earlier row with the same key, the same text or a near text.  Each row meets the first
        # row of its blocks; only rows that are near none of these meet all earlier rows of their blocks, so a large
        # group of near texts costs a star and not all pairs.
        left = cut(alone.drop("rid").join(near, "id", "left_anti"))
        others = peers.select(F.col("id").alias("id2"), "words", "own", "fp")
        table = blocks(others, self.bits, "id2")
        heads = table.groupBy("rot", "front").agg(F.min(F.struct("id2", "sketch")).alias("m")).select("rot", "front", "m.sketch", "m.id2")
        star = cut(self._candidates(left, few, heads, others, "id2"))
        rest = self._candidates(left.join(star.select("id"), "id", "left_anti"), few, table, others, "id2")
        inner = cut(star.unionAll(rest).groupBy("id").agg(F.min("id2").alias("p"), F.max("ratio").alias("ratio")))
        by_key = known.where("key is not null").groupBy("key").agg(F.min("id").alias("pk"))
        up = known.join(by_key, "key", "left").join(by_rid, "rid", "left").join(inner.select("id", F.col("p").alias("pn")), "id", "left")
        up = up.join(near.select("id", F.col("offer").alias("by_near")), "id", "left")
        # A parent is an earlier row; the key comes before the text.
        parent = F.coalesce(F.when(F.col("pk") < F.col("id"), F.col("pk")), F.when(F.col("pr") < F.col("id"), F.col("pr")), F.col("pn"))
        told_offer = F.coalesce("by_key", F.when(F.col("pk") < F.col("id"), F.lit(None)).otherwise(F.coalesce("by_text", "by_near")))
        state = cut(up.select("id", "key", "run", told_offer.alias("offer"), F.when(told_offer.isNull(), parent).alias("p")))
        # Follow parents by doubling until none is left; a row without parent and offer is new and names its own.
        state = state.withColumn("repeat", F.col("offer").isNotNull() | F.col("p").isNotNull())
        state = state.withColumn("offer", F.when(F.col("offer").isNull() & F.col("p").isNull(), F.coalesce("key", F.concat(F.lit("batch:"), "id"))).otherwise(F.col("offer")))
        while not state.where("offer is null").isEmpty():
            above = state.select(F.col("id").alias("p"), F.col("offer").alias("o2"), F.col("p").alias("p2"))
            state = cut(state.join(above, "p", "left").select("id", "key", "run", F.coalesce("offer", "o2").alias("offer"), F.when(F.coalesce("offer", "o2").isNull(), F.col("p2")).alias("p"), "repeat"))
        self.rest()
        self.added.append(self._append(rows, state, near, inner, texts))
        return self.spark.read.parquet(self.added[-1])

    def rest(self) -> None:
        """A collection lets Spark's cleaner drop the shuffles, broadcasts, checkpoints and classes that are no longer used."""
        gc.collect()
        self.spark._jvm.System.gc()

    def _append(self, rows: DataFrame, state: DataFrame, near: DataFrame, inner: DataFrame, texts: DataFrame) -> str:
        """Commit a batch and give the folder of its answers."""
        store = self.store
        keys = state.where("key is not null").groupBy("key").agg(F.min_by("offer", "id").alias("offer")).join(store.read("keys").select("key"), "key", "left_anti")
        first = rows.where("rid is not null").groupBy("rid").agg(F.min("id").alias("id")).join(texts.select("rid"), "rid", "left_anti")
        close = near.select("id", "ratio").unionAll(inner.select("id", "ratio")).where(F.col("ratio") >= self.drift).groupBy("id").agg(F.lit(True).alias("close"))
        fresh = rows.join(first.select("id").join(state.select("id", "offer"), "id").join(close, "id", "left"), "id")
        staged = store.stage("texts", fresh.select("rid", "words", "own", "offer", "fp", F.coalesce("close", F.lit(False)).alias("close")))
        fresh = self.spark.read.parquet(f"{store.base}/{staged}").where("own > 0")
        no = store.meta["order"] + 1
        done = store.stage("answers", state.select("id", "key", "offer", "repeat"))
        tables = {
            "texts": staged, "answers": done, "keys": keys,
            "blocks": _sorted(blocks(fresh, self.bits, "rid", "close")),
            "sightings": state.groupBy("offer").agg(F.lit(no).alias("no"), F.min_by("run", F.struct(F.col("repeat"), "id")).alias("run"), F.count("*").alias("seen")),
        }
        store.commit(tables, {"order": no})
        return f"{store.base}/{done}"

    def answers(self) -> DataFrame | None:
        """(id, key, offer, repeat) of all batches so far, None before the first."""
        return self.store.read("answers")

    def offers(self) -> DataFrame:
        """(offer, first_seen_run, times_seen, is_new): every offer accepted so far, with the run of its first record."""
        new = self.answers()
        seen = self.store.read("sightings").groupBy("offer").agg(F.min_by("run", "no").alias("first_seen_run"), F.sum("seen").alias("times_seen"))
        if new is None:
            return seen.withColumn("is_new", F.lit(False))
        own = new.where("not repeat").select("offer", F.lit(True).alias("is_new")).distinct()
        return seen.join(own, "offer", "left").withColumn("is_new", F.coalesce("is_new", F.lit(False)))

    def compact(self) -> None:
        """Write each table as one part, with fronts as wide as the number of texts asks for."""
        store = self.store
        texts = store.read("texts")
        n = texts.count()
        self.bits = max(self.bits, width(n))
        tables = {t: store.read(t) for t in store.parts if t != "blocks"}
        tables["blocks"] = _sorted(blocks(texts.where("own > 0"), self.bits, "rid", "close"))
        store.commit(tables, {"bits": self.bits, "texts": n}, replace=True)


def _sorted(table: DataFrame) -> DataFrame:
    """Equal rotations and fronts side by side, so that they are stored once for many rows."""
    return table.sortWithinPartitions("close", "rot", "front")


def check_batches(history: History, batches: DataFrame, order: str, key: str, title: str, text: str, by: str | None = None, run: str | None = None, together: int = TOGETHER) -> DataFrame:
    """(id, key, offer, repeat) of all rows: the batches of the column ``by`` are added one after the other, in the order of their first rows; without it all rows are one batch.

    Batches that wait side by side are added in one go as long as they have at most ``together`` rows: as each row meets
    all rows before it, that gives what one after the other gives.
    """
    if by is None:
        return history.add(batches, order, key, title, text, run)
    goes: list[list[str | None]] = []
    size = 0
    # One row per batch.
    for r in batches.groupBy(by).agg(F.min(order).alias("_first"), F.count("*").alias("_n")).orderBy("_first").collect():
        if not goes or size + r["_n"] > together:
            goes.append([])
            size = 0
        goes[-1].append(r[by])
        size += r["_n"]
    before = len(history.added)
    for go in goes or [[None]]:
        mine = F.col(by).isin(*[b for b in go if b is not None])
        history.add(batches.where(mine | F.col(by).isNull() if None in go else mine), order, key, title, text, run)
        history.rest()
    # One scan, not one plan for each batch.
    return history.spark.read.parquet(*history.added[before:])
