import datetime
import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postweave.llm.survivors import Bundle, choose, merged_records, survivors, usable

BUNDLES = (Bundle("title", "title", ("title",), ("category",), leading=True), Bundle("category", "category", ("category", "record_key"), ("category",)))


@pytest.mark.parametrize("value,ok", [("Покраска стен", True), ("без названия", False), ("???", False), ("-", False), ("  ", False), (None, False), ("Flat mov…", False), ("abc [...]", False), ("MuÅ¡ko Å¡iÅ¡anje", False), ("Gel lak â Faji", False), ("ÐÐ°", False), ("Šišanje pasa — ćao", True), ("x�y zz", False), ("N/A", False)])
def test_usable(spark, value, ok):
    assert spark.createDataFrame([(value,)], "v string").select(usable(F.col("v"))).first()[0] is ok


@pytest.mark.parametrize("value", ["Äpfel und Birnen", "Åse Hansen", "El Niño Ñandú", "Ångström lab", "Why??? Ask us today", "Äußere Wände", "Ärger"])
def test_other_languages_are_usable(spark, value):
    assert spark.createDataFrame([(value,)], "v string").select(usable(F.col("v"))).first()[0]


@pytest.mark.parametrize("value", ["KreÄenje stanova", "Äasovi matematike", "Äuvanje dece", "SveÄane frizure"])
def test_lost_bytes_are_garbled(spark, value):
    assert not spark.createDataFrame([(value,)], "v string").select(usable(F.col("v"))).first()[0]


def worth(pick, opts, shares, weights):
    fixed, total = {}, 0.0
    for k, i in enumerate(pick):
        if i is not None:
            total += weights[k] * opts[k][i][1]
            for a, v in zip(shares[k], opts[k][i][0]):
                if fixed.setdefault(a, v) != v:
                    return None
    return sum(i is not None for i in pick), round(total, 6)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from("uv"), st.integers(0, 9)), max_size=4), min_size=1, max_size=4))
def test_branch_and_bound_is_the_best(options):
    shares = [("a", "b") if k % 2 == 0 else ("a",) for k in range(len(options))]
    weights = [1.0 + k / 2 for k in range(len(options))]
    opts = [sorted(((v[: len(shares[k])], float(v[2])) for v in one), key=lambda o: -o[1]) for k, one in enumerate(options)]
    best = max(x for p in itertools.product(*[[*range(len(o)), None] for o in opts]) if (x := worth(p, opts, shares, weights)) is not None)
    assert worth(choose(opts, shares, weights), opts, shares, weights) == best


def greedy(opts, shares):
    pick, fixed = [], {}
    for one, names in zip(opts, shares):
        i = next((i for i, (v, _) in enumerate(one) if all(fixed.get(a, x) == x for a, x in zip(names, v))), None)
        pick.append(i)
        if i is not None:
            fixed |= dict(zip(names, one[i][0]))
    return pick


def test_greedy_loses():
    shares, weights = [("c",)] * 3, [1.0, 1.0, 1.0]
    opts = [[(("x",), 5.0), (("y",), 4.9)], [(("y",), 3.0), (("x",), 1.0)], [(("y",), 2.0), (("x",), 1.0)]]
    assert greedy(opts, shares) == [0, 1, 1] and choose(opts, shares, weights) == [1, 0, 0]
    # Filling a bundle comes before the sum.
    assert choose([[(("x",), 9.0), (("y",), 1.0)], [(("y",), 1.0)]], shares[:2], weights) == [1, 0]
    assert choose([], [], []) == [] and choose([[], []], shares[:2], weights) == [None, None]


def test_a_title_that_dominates_is_never_traded(spark):
    day = lambda n: datetime.datetime(2026, 1, n)
    rows = [("g", "r1", "Покраска стен, Белград", "repair", day(3), "high"), ("g", "r2", "Красим стены", "painting of walls", day(2), "low"), ("g", "r3", "", "painting of walls", day(9), "high"), ("g", "r4", None, "a longer name of paint", day(9), "high")]
    cut_off = ("g", "r5", "Покраска стен, Бел", "paint", day(12), "high")
    df = lambda more: spark.createDataFrame(rows + more, "grp string, record_key string, title string, category string, seen timestamp, trust string")
    of = lambda b, more=[]: {r.bundle: r.record_key for r in survivors(df(more), "grp", "record_key", "seen", "trust", b).collect()}
    assert of(BUNDLES, [cut_off]) == of(BUNDLES) == {"title": "r1", "category": "r1"}
    traded = (Bundle("title", "title", ("title",), ("category",)), Bundle("category", "category", ("category",), ("category",), weight=5.0))
    assert of(traded) == {"title": "r2", "category": "r3"}


def test_groups(spark):
    day = lambda n: datetime.datetime(2026, 1, n)
    rows = [
        ("g1", "r1", "Покраска стен, Белград", "repair", day(3), "high"), ("g1", "r2", "Покраска стен", "paint", day(2), "low"), ("g1", "r3", "Покраска стен, Бел…", "paint", day(9), "high"), ("g1", "r3", "Покраска стен, Бел…", "paint", day(9), "high"),
        ("g2", "r5", "Same", "c", None, None), ("g2", "r4", "Same", "c", None, None), ("g3", "r6", "n/a", "", day(1), "high"), ("", "r7", "Lone one", "x", day(1), "high"), (None, "r8", "Lone two", "x", day(1), "high"), ("g4", "r9", "long " * 9000, "x", day(1), ""),
    ]
    df = spark.createDataFrame(rows, "grp string, record_key string, title string, category string, seen timestamp, trust string")
    chosen = survivors(df, "grp", "record_key", "seen", "trust", BUNDLES)
    got = {(r.group_key, r.bundle): r.record_key for r in chosen.collect()}
    # The title of g1 binds its category to the category seen with it.
    assert got == {("g1", "title"): "r1", ("g1", "category"): "r1", ("g2", "title"): "r4", ("g4", "title"): "r9"}
    built = {r.group_key: r.title for r in merged_records(df, "grp", "record_key", chosen, (BUNDLES[0],)).collect()}
    assert built["g1"] == "Покраска стен, Белград" and set(built) == {"g1", "g2", "g4"}
    assert survivors(df.limit(0), "grp", "record_key", "seen", "trust", BUNDLES).count() == 0
