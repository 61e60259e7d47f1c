import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postweave.llm.components import connected_components, handle_keys, phone_key, provider_groups


def expected(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[find(a)] = find(b)
    groups = {}
    for x in parent:
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def found(df, cell):
    groups = {}
    for r in connected_components(df, cell).collect():
        groups.setdefault(r.component, set()).add(r.id)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("cell", [200_000, 5])
@settings(max_examples=6, deadline=None)
@given(edges=st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e", "f", "g", "h", None]), st.sampled_from(["a", "b", "c", "d", "e", "f", "g", "h", "i"])), max_size=14))
def test_like_union_find(spark, cell, edges):
    assert found(spark.createDataFrame(edges, "a string, b string"), cell) == expected(edges)


def test_paths_and_stars(spark):
    edges = [(f"p{i:04}", f"p{i + 1:04}") for i in range(400)] + [("hub", f"s{i}") for i in range(600)]
    assert found(spark.createDataFrame(edges, "a string, b string"), 40) == expected(edges)


def test_keys(spark):
    phones = ["+381 (60) 012-34-56", "00381 60 0123456", "060/012-3456", "60 012 3456", "12", None]
    df = spark.createDataFrame([(p,) for p in phones], "p string")
    assert [r[0] for r in df.select(phone_key(F.col("p"))).collect()] == ["381600123456"] * 4 + [None, None]
    cells = ['["@Foo_1","https://t.me/Bar2/"]', "t.me/foo_1 @baz9 или BAR2", "", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert [r[0] for r in df.select(handle_keys(F.col("c"))).collect()] == [["foo_1", "bar2"], ["foo_1", "baz9", "bar2"], [], None]


def test_groups(spark):
    p = [("p1", "060 111 22 33", None), ("p2", "+381601112233", "@nick"), ("p3", "", "t.me/NICK"), ("p4", None, None), ("p5", "069 999 99 99", None), ("p6", None, ""), ("p1", "060 111 22 33", None)]
    m = [("p4", "p6", "match"), ("p5", "p1", "no_match"), ("p5", "p5", "match"), ("p5", "gone", "match"), (None, "p5", "match"), ("p6", "p4", "match"), ("p5", "p1", None)]
    prov = spark.createDataFrame(p, "provider_key string, phones string, telegram_handles string")
    match = spark.createDataFrame(m, "left_provider_key string, right_provider_key string, decision string")
    got = sorted(tuple(r) for r in provider_groups(prov, match).collect())
    assert got == [("p1", "p1"), ("p2", "p1"), ("p3", "p1"), ("p4", "p4"), ("p6", "p4")]
    assert provider_groups(prov.limit(0), match.limit(0)).count() == 0
