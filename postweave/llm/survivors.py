"""Problem 1: the best representative of each duplicate group.

Method: consistent bundles.  Fields that depend on one another form a bundle (a description and its summary, a price
with its currency), and a bundle is taken whole from one row.  A bundle has a main field whose value must be usable,
a weight, and the attributes it shares with others: chosen bundles must agree on a shared attribute (a functional
dependency such as title -> category, price text -> currency).  Per group, branch and bound chooses one row per
bundle so that as many bundles as possible are filled and, among those choices, the weighted sum of trust is the
largest; the row with the best title is given up where a consistent choice without it is worth more.

A value's trust is a number that grows with each of completeness, last sighting and confidence; null times are
oldest.  A ``leading`` bundle is not traded: where one usable value of a group is no less complete, no older and no
less trusted than every other, that value is taken and the other bundles follow it.

A value is not usable if it is blank, a stand-in for "missing", marked as cut off or garbled: replacement characters,
or UTF-8 read as a one-byte code (the bytes of a pair found as two characters; where the second byte was lost, a
capital lead letter right after a small one, or before a vowel that no word begins with).  A value of a leading
bundle that the longest usable value of its group begins with is cut off too, without a mark.

Only the best row per group, bundle and shared values leaves the partial aggregate, so a group of any size reaches
branch and bound as a handful of candidates without texts (as many as there are different values of the shared
attributes).  Ties go to the smallest record key.  Groups whose main field is nowhere usable have no row for that
bundle; null and blank group keys are no groups; rows without a key are left out; repeated rows change nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stand-ins for "missing".
STAND_INS = ("-", "—", "–", ".", "..", "?", "??", "???", "n/a", "na", "null", "none", "nan", "nil", "tbd", "todo", "unknown", "untitled", "no title", "без названия", "нет", "нет данных", "неизвестно", "bez naziva", "nepoznato", "nema")
_LEAD2, _LEAD3 = "[\\u00c2-\\u00df]", "[\\u00e0-\\u00ef]"
_NEXT = "[\\u0080-\\u00bf\\u20ac\\u201a\\u0192\\u201e\\u2026\\u2020\\u2021\\u02c6\\u2030\\u0160\\u2039\\u0152\\u017d\\u2018-\\u201d\\u2022\\u2013\\u2014\\u02dc\\u2122\\u0161\\u203a\\u0153\\u017e\\u0178]"
_LOST = "\\p{Ll}[ÐÑÂÃÄÅ]|(?<!\\p{L})Ä(?=[aeo]|u(?![ßg]))|(?<!\\p{L})â(?!\\p{L})"
GARBLED = f"{_LEAD2}{_NEXT}|{_LEAD3}{_NEXT}{_NEXT}|[\\u0080-\\u009f]|\\ufffd|{_LOST}"
CUT_OFF = "(?:…|\\.\\.\\.|[\\[(](?:…|\\.\\.\\.)[\\])])\\s*$"


def usable(col: Column) -> Column:
    """Whether a value says something."""
    t = F.trim(F.coalesce(col, F.lit("")))
    return (F.length(t) > 0) & ~F.lower(t).isin(*STAND_INS) & t.rlike("[\\p{L}\\p{N}]{2}") & ~t.rlike(CUT_OFF) & ~t.rlike(GARBLED)


@dataclass(frozen=True)
class Bundle:
    """``typical`` is the length at which a main value counts as half complete; ``leading``: see above."""

    name: str
    main: str
    members: tuple[str, ...] = ()
    shares: tuple[str, ...] = field(default=())
    weight: float = 1.0
    typical: float = 40.0
    leading: bool = False


OFFER_BUNDLES = (
    Bundle("title_best", "title_best", ("title_best",), ("category_primary",), weight=2.0, leading=True),
    Bundle("description_best", "description_best", ("description_best", "offer_summary"), weight=2.0, typical=200.0, leading=True),
    Bundle("category", "category_primary", ("category_primary", "category_secondary"), ("category_primary",), typical=10.0),
    Bundle("price", "price_text_best", ("price_text_best",), ("currency_code",), typical=10.0),
    Bundle("amounts", "price_min", ("price_min", "price_max", "currency_code"), ("currency_code",), typical=5.0),
)
PROVIDER_BUNDLES = (
    Bundle("display_name_best", "display_name_best", ("display_name_best",), weight=2.0, leading=True),
    Bundle("contact", "primary_contact_value", ("primary_contact_value", "primary_contact_type"), ("primary_contact_type",)),
)

YEAR_US = 365.25 * 86400e6
FRESH, SURE = 0.2, 0.15  # what a year and a step of confidence are worth beside completeness, which is worth one at most
_FROM_US = 946_684_800_000_000  # 2000-01-01


def candidates(rows: DataFrame, group: str, record: str, seen: str, confidence: str, bundles: tuple[Bundle, ...]) -> DataFrame:
    """(group_key, options): per group the best row of each bundle and shared values, with the most that any row of it has."""
    sure = F.when(F.col(confidence) == "high", 3).when(F.col(confidence) == "medium", 2).when(F.col(confidence) == "low", 1).otherwise(0)
    when = F.coalesce(F.unix_micros(F.col(seen)), F.lit(-(2**62)))
    fresh = F.greatest(F.lit(0.0), (when - _FROM_US) / YEAR_US) * FRESH + sure * SURE
    own = rows.where(F.trim(F.coalesce(F.col(group), F.lit(""))) != "").where(F.col(record).isNotNull())
    needed = dict.fromkeys([record, seen, confidence, *[b.main for b in bundles], *[c for b in bundles for c in b.shares]])
    own = own.select(F.col(group).alias("group_key"), *needed)
    said = lambda b: F.trim(F.col(b.main).cast("string"))
    whole = [b for b in bundles if b.leading]
    if whole:
        # One row per group; a group with many rows is split by the skew join.
        longest = [F.max(F.when(usable(said(b)), F.struct(F.length(said(b)).alias("n"), said(b).alias("v")))).alias(f"_longest_{b.name}") for b in whole]
        own = own.join(own.groupBy("group_key").agg(*longest), "group_key")
    options = []
    for no, b in enumerate(bundles):
        shared = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in b.shares]) if b.shares else F.array().cast("array<string>")
        full = F.length(said(b))
        good = usable(said(b))
        if b.leading:
            longest_one = F.col(f"_longest_{b.name}.v")
            good = good & ~((full < F.length(longest_one)) & longest_one.startswith(said(b)))
        trust = fresh + full / (full + b.typical)
        # The sum of negatives is the order: the most trusted first, then the most complete, newest, surest, smallest key.
        score = F.struct((-trust).alias("trust"), (-full).alias("full"), (-when).alias("seen"), (-sure).alias("sure"), F.col(record).cast("string").alias("record"))
        options.append(F.when(good, F.struct(F.lit(no).alias("bundle"), shared.alias("shared"), score.alias("score"))))
    flat = own.select("group_key", F.explode(F.filter(F.array(*options), lambda x: x.isNotNull())).alias("o"))
    best = flat.groupBy("group_key", F.col("o.bundle").alias("bundle"), F.col("o.shared").alias("shared")).agg(F.min("o.score").alias("score"), F.struct(F.min("o.score.full").alias("full"), F.min("o.score.seen").alias("seen"), F.min("o.score.sure").alias("sure")).alias("most"))
    return best.groupBy("group_key").agg(F.collect_list(F.struct("bundle", "shared", "score", "most")).alias("options"))


def choose(options: list[list[tuple[tuple[str, ...], float]]], shares: list[tuple[str, ...]], weights: list[float]) -> list[int | None]:
    """Branch and bound: per bundle the index of the chosen option, or None, so that (bundles filled, weighted trust) is largest.

    ``options`` are (shared values, trust), from the most trusted to the least.  A branch is left when filling all the
    rest with its most trusted options, whatever they share, would be no better than the best choice found.
    """
    n = len(options)
    gain = [[w * t for _, t in one] for one, w in zip(options, weights)]
    fill_after, sum_after = [0] * (n + 1), [0.0] * (n + 1)
    for k in range(n - 1, -1, -1):
        fill_after[k] = fill_after[k + 1] + bool(options[k])
        sum_after[k] = sum_after[k + 1] + max([0.0, *gain[k]])
    best: tuple[int, float] = (-1, 0.0)
    found: list[int | None] = [None] * n
    chosen: list[int | None] = [None] * n

    def go(k: int, filled: int, total: float, fixed: dict[str, str]) -> None:
        nonlocal best, found
        if (filled + fill_after[k], total + sum_after[k]) <= (best[0], best[1] + 1e-12):
            return
        if k == n:
            best, found = (filled, total), list(chosen)
            return
        for i, (shared, _) in enumerate(options[k]):
            mine = dict(zip(shares[k], shared))
            if all(fixed.get(a, v) == v for a, v in mine.items()):
                chosen[k] = i
                go(k + 1, filled + 1, total + gain[k][i], fixed | mine)
        chosen[k] = None
        go(k + 1, filled, total, fixed)

    go(0, 0, 0.0, {})
    return found


def survivors(rows: DataFrame, group: str, record: str, seen: str, confidence: str, bundles: tuple[Bundle, ...]) -> DataFrame:
    """(group_key, bundle, record_key): the row each bundle of a group survives from."""
    # Leading bundles first: what they fix narrows the rest early.
    order = sorted(range(len(bundles)), key=lambda k: (not bundles[k].leading, -bundles[k].weight, k))
    shares, weights = [bundles[k].shares for k in order], [bundles[k].weight for k in order]

    def best_of(opts: list[dict]) -> Iterator[tuple[str, str]]:
        per = []
        for k in order:
            mine = sorted((o for o in opts if o["bundle"] == k), key=lambda o: (*o["score"].values(),))
            if bundles[k].leading and mine:
                most = tuple(min(o["most"][f] for o in mine) for f in ("full", "seen", "sure"))
                mine = [o for o in mine if tuple(o["score"][f] for f in ("full", "seen", "sure")) == most][:1] or mine
            per.append(mine)
        for k, mine, i in zip(order, per, choose([[(tuple(o["shared"]), -o["score"]["trust"]) for o in mine] for mine in per], shares, weights)):
            if i is not None:
                yield bundles[k].name, mine[i]["score"]["record"]

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = [(g, *one) for g, opts in zip(p["group_key"], p["options"]) for one in best_of(list(opts))]
            yield pd.DataFrame(out, columns=["group_key", "bundle", "record_key"])

    return candidates(rows, group, record, seen, confidence, bundles).mapInPandas(run, "group_key string, bundle string, record_key string")


def merged_records(rows: DataFrame, group: str, record: str, chosen: DataFrame, bundles: tuple[Bundle, ...]) -> DataFrame:
    """One built record per group: every bundle's members from the row it survives from."""
    out = chosen.select("group_key").distinct()
    for b in bundles:
        own = chosen.where(F.col("bundle") == b.name).select(F.col("group_key"), F.col("record_key").alias(record))
        values = rows.select(F.col(group).alias("group_key"), record, *b.members)
        part = own.join(values, ["group_key", record]).groupBy("group_key").agg(*[F.first(m).alias(m) for m in b.members])
        out = out.join(part, "group_key", "left")
    return out
