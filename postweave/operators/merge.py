"""Identity graph, similarity joins, clusters and the best value of each cluster."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postweave.functions import text as T
from postweave.operators.posts import parse_instant
from postweave.session import cut, kept

# Products of doubles lie a little above the whole number they stand for (0.55 * 100); no bound may lose a pair by that.
SLACK = 1e-9
BLANK_HASH = hashlib.sha1(b"").hexdigest()


def components(edges: DataFrame) -> DataFrame:
    """From (a, b): (id, component), the component being its smallest id.

    Alternating large-star and small-star rounds on a written edge table; a star's members are grouped by window, and
    both rounds keep the number of edges, so nothing grows with the size of a component.
    """
    now = edges.where("a is not null and b is not null")
    now = cut(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    ids = now.select(F.col("a").alias("id")).union(now.select("b")).distinct()
    links = now.where("a <> b")
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cut(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        small = cut(small.where("a <> b").distinct())
        # Stable when every vertex hangs on one root and no root hangs on another.
        ends = small.select(F.col("a").alias("v"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionAll(small.select("b", F.lit(0), F.lit(1)))
        moving = ends.groupBy("v").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or (hangs > 0 and holds > 0)")
        links = small
        if moving.isEmpty():
            break
    return ids.join(links.select(F.col("a").alias("id"), F.col("b").alias("component")), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def shared_key_edges(rows: DataFrame, key: str, items: Column) -> DataFrame:
    """Each record linked to the smallest record with the same item: a star per item, not all pairs."""
    flat = rows.select(F.col(key).alias("a"), F.explode(items).alias("item"))
    low = flat.groupBy("item").agg(F.min("a").alias("b"))
    return flat.join(low, "item").select("a", "b").distinct()


def _worded(rows: DataFrame, key: str, words: Column, within: str | None, labels: Column | None) -> tuple[DataFrame, list[str]]:
    """(k, within, w, labels) of the records with words, and the columns that records of one class agree in."""
    extra = [within] if within else []
    told = F.array_sort(F.array_distinct(F.coalesce(labels, F.array().cast("array<string>")))) if labels is not None else F.array().cast("array<string>")
    base = rows.select(F.col(key).alias("k"), *extra, F.array_sort(words).alias("w"), told.alias("labels"))
    return base.where("k is not null and size(w) > 0"), [*extra, "w", "labels"]


def word_classes(rows: DataFrame, key: str, words: Column, within: str | None = None, labels: Column | None = None) -> DataFrame:
    """(key, class_key): records of one set of words (and labels) are one class, named by its smallest key; without words there is none."""
    base, same = _worded(rows, key, words, within, labels)
    name = base.groupBy(*same).agg(F.min("k").alias("class_key"))
    return base.join(name, same).select(F.col("k").alias(key), "class_key").distinct()


def similar_pairs(rows: DataFrame, key: str, words: Column, least: float, within: str | None = None, labels: Column | None = None) -> DataFrame:
    """(left_key, right_key, similarity) of all pairs of classes with a Jaccard similarity of at least ``least``.

    Records of one set of words are one class (``word_classes`` has the members) and stand here by their smallest key,
    so copies are never expanded into pairs and no link between different sets is lost.  With ``labels``, classes agree in
    them too, and two classes that both have labels but share none are no pair.

    Prefix filter: words are ordered from rare to frequent, and a set meets each larger one at a word among the rarest
    of either; see ``_pairs``.
    """
    base, same = _worded(rows, key, words, within, labels)
    base = base.groupBy(*same).agg(F.min("k").alias("k")).select("k", *same)
    return _pairs(base, least, [within] if within else [])


# Words counted for the order of the prefix: at most so many, the most frequent; the others count as rare.
COUNTED = 200_000


def _prefixes(least: float, table) -> object:  # noqa: ANN001
    """Arrow batches (id, g, h) to rows (key, id, n, i, short, x, y): the words of a set's prefix from rare to frequent.

    ``x`` and ``y`` hold a bit for each word of the set; ``short`` marks the words that it needs towards sets as large or larger.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2)
            n = np.asarray(lists.value_lengths()).astype(np.int64)
            h = np.asarray(lists.flatten()).view(np.uint64)
            first = np.cumsum(n) - n
            mine = np.repeat(np.arange(len(n)), n)
            f = np.zeros(len(h), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                f = np.where(known[at] == h, count[at], 0)
            bit = np.uint64(1) << (h & np.uint64(63))
            low = (h >> np.uint64(6)) & np.uint64(1) == 0
            x, y = (np.bitwise_or.reduceat(np.where(half, bit, np.uint64(0)), first).view(np.int64) for half in (low, ~low))
            order = np.lexsort((h, f, mine))
            i = np.arange(len(h)) - first[mine] + 1  # mine is sorted, so places within a set are as before
            size = n[mine]
            keep = i <= size - np.ceil(least * size - SLACK) + 1
            short = i <= size - np.ceil(2 * least / (1 + least) * size - SLACK) + 1
            ids, g = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
            key = (h[order] ^ (g * np.uint64(0x9E3779B97F4A7C15))[mine]).view(np.int64)
            cols = [key, ids[mine], size.astype(np.int32), i.astype(np.int32), short, x[mine], y[mine]]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], names=["key", "id", "n", "i", "short", "x", "y"])

    return run


def _pairs(base: DataFrame, least: float, extra: list[str]) -> DataFrame:
    """``similar_pairs`` of rows (k, *extra, w, labels), each of a class of its own and with words.

    Of two sets the smaller one has at least 2 * least / (1 + least) of its words in the other, the larger one ``least``
    of its own, so they meet at a word among the n - that + 1 rarest of each.  The order only has to be the same for all
    sets: it goes by the counts of the most frequent words.  Where two sets meet, no more words can be shared than follow
    in the shorter rest, and they differ in at least as many words as their bits differ; what is left is compared by
    words.  Keys and bits come from hashes, which can only add pairs to compare.
    """
    spark = base.sparkSession
    base = kept(base.withColumn("id", F.monotonically_increasing_id()))
    hashed = F.transform("w", lambda t: F.xxhash64(t))
    group = F.xxhash64(*extra) if extra else F.lit(0).cast("bigint")
    often = base.select(F.explode(hashed).alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(COUNTED).toArrow()
    known, count = np.asarray(often.column(0).combine_chunks()).view(np.uint64), np.asarray(often.column(1).combine_chunks())
    order = np.argsort(known)
    table = spark.sparkContext.broadcast((known[order], count[order]))
    places = base.select("id", group.alias("g"), hashed.alias("h")).mapInArrow(_prefixes(least, table), "key long, id long, n int, i int, short boolean, x long, y long")
    side = lambda rows, c: rows.select("key", *[F.col(o).alias(f"{o}_{c}") for o in ("id", "n", "i", "x", "y")])
    both = F.col("n_a") + F.col("n_b")
    once = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("id_a") < F.col("id_b")))
    apart = F.bit_count(F.col("x_a").bitwiseXOR(F.col("x_b"))) + F.bit_count(F.col("y_a").bitwiseXOR(F.col("y_b"))) <= F.lit((1 - least) / (1 + least)) * both + SLACK
    rest = 1 + F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b")) >= F.lit(least / (1 + least)) * both - SLACK
    met = side(places.where("short"), "a").join(side(places, "b"), "key").where(once & apart & rest).select("id_a", "id_b").distinct()
    told = base.select("id", F.struct("k", *extra, "w", "labels").alias("s"))
    met = met.join(told.select(F.col("id").alias("id_a"), F.col("s").alias("a")), "id_a").join(told.select(F.col("id").alias("id_b"), F.col("s").alias("b")), "id_b")
    agree = (F.size("a.labels") == 0) | (F.size("b.labels") == 0) | F.arrays_overlap("a.labels", "b.labels")
    for c in extra:
        agree = agree & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    met = met.where(agree).select(F.least("a.k", "b.k").alias("left_key"), F.greatest("a.k", "b.k").alias("right_key"), T.jaccard(F.col("a.w"), F.col("b.w")).alias("similarity"))
    return met.where(F.col("similarity") >= least)


def word_ids(rows: DataFrame, column: str) -> DataFrame:
    """The words of an array column as whole numbers, each word its own: sets keep their likeness and take less room.

    The numbers are hashes; a seed with which two words of the rows get the same one is given up for the next.
    """
    seen = rows.select(F.explode(column).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    for seed in range(100):
        if seen.groupBy(F.xxhash64(F.lit(seed), "t").alias("h")).count().where("count > 1").isEmpty():
            return rows.withColumn(column, F.array_sort(F.transform(column, lambda t: F.xxhash64(F.lit(seed), t))))  # noqa: B023
    raise ValueError(f"no hash tells the words of {column} apart")


def review_pairs(pairs: DataFrame, rows: DataFrame, key: str, overlap: list[Column], weak: Column, k: int) -> DataFrame:
    """The ``k`` most similar pairs of which not both are strong and that share a value of one of the ``overlap`` lists."""
    told = rows.select(F.col(key).alias("_k"), F.coalesce(weak, F.lit(True)).alias("_weak"), *[F.coalesce(c, F.array().cast("array<string>")).alias(f"_o{i}") for i, c in enumerate(overlap)])
    side = lambda n: told.select(F.col("_k").alias(f"{n}_key"), F.struct("_weak", *[f"_o{i}" for i in range(len(overlap))]).alias(f"_{n}"))
    met = pairs.join(side("left"), "left_key").join(side("right"), "right_key")
    shared = F.lit(False)
    for i in range(len(overlap)):
        shared = shared | F.arrays_overlap(F.col("_left")[f"_o{i}"], F.col("_right")[f"_o{i}"])
    kept = met.where((F.col("_left._weak") | F.col("_right._weak")) & shared)
    return kept.select("left_key", "right_key", "similarity").orderBy(F.desc("similarity"), "left_key", "right_key").limit(k)


def by_category(pairs: DataFrame, rows: DataFrame, key: str, category: str, same: float, other: float, k: int) -> DataFrame:
    """The ``k`` most similar pairs, with a threshold for pairs of one category and a higher one for others."""
    c = rows.select(F.col(key).alias("_k"), T.or_empty(F.col(category)).alias("_c"))
    met = pairs.join(c.select(F.col("_k").alias("left_key"), F.col("_c").alias("_l")), "left_key").join(c.select(F.col("_k").alias("right_key"), F.col("_c").alias("_r")), "right_key")
    kept = met.where(F.col("similarity") >= F.when(F.col("_l") == F.col("_r"), same).otherwise(other))
    return kept.select("left_key", "right_key", "similarity").orderBy(F.desc("similarity"), "left_key", "right_key").limit(k)


def nearest_in_time(left: DataFrame, right: DataFrame, by: list[str], ts: str, seconds: float, key: str) -> DataFrame:
    """For each row of ``left`` the row of ``right`` with the same ``by`` nearest in time within ``seconds``, but for one
    of its own key; ties go to the earlier, then the smaller key.

    Time is cut into bins as wide as the window and each right row stands in three of them, so a bin is sorted on its
    own and every left row looks at its neighbours in that order only: no pairs within a bin are built.
    """
    width = round(seconds * 1_000_000)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    own = F.floor(us / width)
    a = left.where(F.col(ts).isNotNull()).select(*by, F.lit(1).alias("side"), us.alias("us"), F.col(key).alias("k"), own.alias("bin"))
    b = right.where(F.col(ts).isNotNull()).select(*by, F.lit(0).alias("side"), us.alias("us"), F.col(key).alias("k"), F.explode(F.array(own - 1, own, own + 1)).alias("bin"))
    rows = a.unionByName(b)
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    for name, way in (("before", F.col("us")), ("after", -F.col("us"))):
        order = Window.partitionBy(*by, "bin").orderBy(way, "side", F.desc("k"))
        back = order.rowsBetween(Window.unboundedPreceding, -1)
        here = F.when(F.col("side") == 0, F.struct("us", "k"))
        # The last right row so far, and the one before it for rows that meet themselves.
        rows = rows.withColumn("_one", F.last(here, ignorenulls=True).over(back))
        pair = F.when(F.col("side") == 0, F.struct(F.struct("us", "k").alias("x"), F.col("_one").alias("y")))
        rows = rows.withColumn("_two", F.last(pair, ignorenulls=True).over(back))
        rows = rows.withColumn(name, F.when(F.col("_two.x.k") == F.col("k"), F.col("_two.y")).otherwise(F.col("_two.x"))).drop("_one", "_two")
    gap = lambda c: F.when(F.col(f"{c}.k").isNotNull() & (F.abs(F.col(f"{c}.us") - F.col("us")) <= width), F.struct((F.abs(F.col(f"{c}.us") - F.col("us")) / 1e6).alias("gap"), F.col(f"{c}.us").alias("us"), F.col(f"{c}.k").alias("k")))
    met = rows.where("side = 1").select(F.col("k").alias("left_key"), F.least(gap("before"), gap("after")).alias("m"))
    return met.where("m is not null").select("left_key", F.col("m.k").alias("right_key"), F.round("m.gap", 6).alias("gap"))


def first_and_last(rows: DataFrame, by: str, ts: str, key: str, value: str) -> DataFrame:
    """Earliest and latest value per group; rows without a time come last for the first and first for the last."""
    order = F.struct(F.col(ts).isNull(), ts, key)
    late = F.struct(F.col(ts).isNotNull(), ts, key)
    return rows.groupBy(by).agg(F.min_by(value, order).alias("first_value"), F.max_by(value, late).alias("last_value"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), F.count("*").alias("n"))


def most_common(rows: DataFrame, by: str, value: str) -> DataFrame:
    """The most frequent non-blank value per group; ties go to the longest, then the first in small letters, then as written."""
    counted = rows.where(T.or_empty(F.col(value)) != "").groupBy(by, value).agg(F.count("*").alias("n"))
    best = F.min_by(F.col(value), F.struct(-F.col("n"), -F.length(value), F.lower(value), F.col(value)))
    return counted.groupBy(by).agg(best.alias("mode"), F.max("n").alias("n"))


def union_values(rows: DataFrame, by: str, **arrays: Column) -> DataFrame:
    """The sorted distinct items of array columns per group; items are made distinct before they are gathered."""
    flat = rows.select(by, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("items")) for n, c in arrays.items()])).alias("x"))
    items = flat.select(by, "x.name", F.explode("x.items").alias("item")).distinct()
    got = items.groupBy(by).agg(*[F.array_sort(F.collect_list(F.when(F.col("name") == n, F.col("item")))).alias(n) for n in arrays])
    return rows.select(by).distinct().join(got, by, "left").select(by, *[F.coalesce(F.col(n), F.array().cast("array<string>")).alias(n) for n in arrays])


def top_words(rows: DataFrame, by: str, words: Column, k: int = 10) -> DataFrame:
    """Words of at least half of a group's rows (one at least), the ``k`` most frequent first."""
    n = rows.groupBy(by).agg(F.count("*").alias("rows"))
    counted = rows.select(by, F.explode(words).alias("word")).groupBy(by, "word").agg(F.count("*").alias("n"))
    kept = counted.join(n, by).where(F.col("n") >= F.greatest(F.lit(1), F.floor(F.col("rows") / 2)))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "word"))).where(F.col("rank") <= k)
    return ranked.select(by, "word", "n", "rank")


def sum_scores(rows: DataFrame, by: str, hints: Column) -> DataFrame:
    """Category scores summed per group, ranked by sum, occurrences and code."""
    flat = rows.select(by, F.explode(hints).alias("h")).select(by, F.col("h.code").alias("code"), F.col("h.score").alias("score"))
    got = flat.groupBy(by, "code").agg(F.sum("score").alias("score"), F.count("*").alias("n"))
    return got.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), F.desc("n"), "code")))


def provider_clusters(structured: DataFrame) -> DataFrame:
    """(raw_post_id, provider_key): posts joined by strong identity keys; a post without any stands alone or by its text."""
    posts = structured.select("raw_post_id", "identity", F.filter("identity", lambda x: ~x.startswith("weak_text:")).alias("strong")).where("raw_post_id <> ''").groupBy("raw_post_id").agg(F.max("identity").alias("identity"), F.max("strong").alias("strong"))
    posts = kept(posts.select("raw_post_id", "strong", F.array_min("strong").alias("id"), F.when(F.size("strong") == 0, F.coalesce(F.get("identity", F.lit(0)), F.col("raw_post_id"))).alias("weak")))
    # The keys of a post hang on its smallest: a component of keys is named by the anchor of its posts.
    comp = components(posts.where("size(strong) > 1").select(F.explode("strong").alias("a"), F.col("id").alias("b")).distinct())
    anchor = F.coalesce("component", "id")
    key = F.when(F.col("id").isNull(), F.concat(F.lit("provider:raw_post:"), F.sha1(F.col("weak").cast("binary")))).otherwise(F.concat(F.lit("provider:"), F.split_part(anchor, F.lit(":"), F.lit(1)), F.lit(":"), F.sha1(anchor.cast("binary"))))
    return posts.join(comp, "id", "left").select("raw_post_id", key.alias("provider_key"))


def attachment_edges(bare: DataFrame, told: DataFrame, seconds: float) -> DataFrame:
    """(a, b) from posts (raw_post_id, provider_key, channel, at, ts) without content and with it: what each of the former hangs on.

    Posts without content at most ``seconds`` apart in one channel of a provider are one group, and the group hangs on
    the post with content nearest to any of its own, if one is as near; ties go to the earlier, then the smaller key.
    Times that cannot be read (``ts`` is null) must be written alike, and are then no time apart.
    """
    by = ["provider_key", "channel"]
    bare = cut(bare.where("channel <> ''").select("raw_post_id", *by, "at", "ts"))
    told = told.join(bare.select(*by).distinct(), by, "left_semi").select("raw_post_id", *by, "at", "ts")
    line = Window.partitionBy(*by, F.when(F.col("ts").isNull(), F.col("at"))).orderBy("ts", "raw_post_id")
    step = F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(line))
    first = F.lag("raw_post_id").over(line).isNull() | (F.coalesce(step, F.lit(0)) > round(seconds * 1_000_000))
    heads = bare.withColumn("first", first).withColumn("head", F.last(F.when(F.col("first"), F.col("raw_post_id")), ignorenulls=True).over(line)).select("raw_post_id", "head")
    near = nearest_in_time(bare, told, by, "ts", seconds, "raw_post_id").join(told.select(F.col("raw_post_id").alias("right_key"), "ts"), "right_key")
    alike = told.where("ts is null").groupBy(*by, "at").agg(F.min("raw_post_id").alias("right_key"))
    alike = bare.where("ts is null").join(alike, [*by, "at"]).select(F.col("raw_post_id").alias("left_key"), "right_key", F.lit(0.0).alias("gap"), F.lit(None).cast("timestamp").alias("ts"))
    met = near.select("left_key", "right_key", "gap", "ts").unionAll(alike).join(heads.select(F.col("raw_post_id").alias("left_key"), "head"), "left_key")
    best = met.groupBy("head").agg(F.min_by("right_key", F.struct("gap", "ts", "right_key")).alias("b")).select(F.col("head").alias("a"), "b")
    return heads.select(F.col("raw_post_id").alias("a"), F.col("head").alias("b")).unionAll(best)


def offer_clusters(posts: DataFrame, least: float = 0.55, seconds: float = 5.0) -> DataFrame:
    """(raw_post_id, provider_key, offer_key): within a provider, posts of one text or of similar words are one offer.

    A blank text is no text to share: posts with neither text, words nor categories join by ``attachment_edges``.  Posts
    that both have categories but share none are alike by their text only.  ``posts`` may lack categories, channel and
    posted_at_utc; then no pair is refused and posts without content stay alone.
    """
    given = lambda c, kind: F.col(c).cast(kind) if c in posts.columns else F.lit(None).cast(kind)
    at = F.trim(T.or_empty(given("posted_at_utc", "string")))
    rows = posts.select("raw_post_id", "provider_key", "text_hash", "tokens", F.coalesce(given("categories", "array<string>"), F.array().cast("array<string>")).alias("categories"), T.or_empty(given("channel", "string")).alias("channel"), at.alias("at"), parse_instant(at).alias("ts"))
    blank = T.or_empty(F.col("text_hash")).isin("", BLANK_HASH)
    told = F.array_sort(F.array_distinct("categories"))
    worded = F.coalesce(F.size("tokens"), F.lit(0)) > 0
    digest = F.when(worded, F.sha1(F.to_json(F.struct(F.array_sort("tokens").alias("w"), told.alias("l"))).cast("binary")))
    rows = rows.withColumn("blank", blank).withColumn("bare", F.col("blank") & ~worded & (F.size("categories") == 0))
    rows = kept(rows.select("*", digest.alias("digest")))
    # A post of a text stands by the smallest post of that text, and those by the smallest one of the same words and categories.
    low = rows.where("not blank").groupBy("provider_key", "text_hash").agg(F.min("raw_post_id").alias("rep"))
    first = rows.select("raw_post_id", "provider_key", "text_hash", "blank", "bare", "digest").join(low.withColumn("blank", F.lit(False)), ["provider_key", "text_hash", "blank"], "left").withColumn("rep", F.coalesce("rep", "raw_post_id"))
    first = kept(first.select("raw_post_id", "provider_key", "rep", F.when(F.col("rep") == F.col("raw_post_id"), F.col("digest")).alias("digest")))
    name = first.where("digest is not null").groupBy("provider_key", "digest").agg(F.min("raw_post_id").alias("class_key"))
    of = kept(first.where("digest is not null").join(name, ["provider_key", "digest"]).select(F.col("raw_post_id").alias("rep"), "class_key"))
    base = rows.join(of.where("rep = class_key").select(F.col("rep").alias("raw_post_id")), "raw_post_id", "left_semi")
    base = base.select(F.col("raw_post_id").alias("k"), "provider_key", F.array_sort("tokens").alias("w"), told.alias("labels"))
    near = _pairs(base, least, ["provider_key"]).select(F.col("left_key").alias("a"), F.col("right_key").alias("b"))
    hung = attachment_edges(rows.where("bare").drop("tokens"), rows.where("not bare").drop("tokens"), seconds)
    stand = first.join(of, "rep", "left").select("raw_post_id", "provider_key", F.coalesce("class_key", "rep").alias("stands"))
    hung = hung.join(stand.select(F.col("raw_post_id").alias("b"), "stands"), "b").select("a", F.col("stands").alias("b"))
    comp = components(near.unionAll(hung)).withColumnRenamed("id", "stands")
    return stand.join(comp, "stands", "left").select("raw_post_id", "provider_key", F.concat(F.lit("offer:"), T.stable_hash(F.col("provider_key"), F.coalesce("component", "stands"))).alias("offer_key"))
