import hashlib
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postweave.functions import contacts as C
from postweave.functions import text as T
from postweave.operators import merge as M
from postweave.operators import posts as P
from postweave.operators import tables as S
from postweave.sources import files
from postweave.streaming import ingest


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_text_functions(spark):
    assert one(spark, " 1️⃣②​ a \n b ", T.normalize_text) == "12 a b"
    assert one(spark, None, T.normalize_text) == ""
    assert one(spark, "+381 (60) 11-22-333", T.normalize_phone) == "381601122333" and one(spark, "123", T.normalize_phone) == ""
    assert one(spark, "https://t.me/Foo_Bar/12", T.normalize_handle) == "foo_bar" and one(spark, "@Foo.,", T.normalize_handle) == "foo"
    assert one(spark, "HTTPS://Www.Site.RS/A/?q=1#x", T.normalize_url) == "https://www.site.rs/A"
    assert one(spark, "https://www.site.rs/a/", T.normalize_website) == "site.rs/a"
    assert one(spark, "Hello WORLD the 123 abc abc", T.tokens) == ["abc", "hello", "world"]
    assert one(spark, "aaaa bbbb cccc dddd eeee ffff gggg hhhh", lambda c: T.shorten(c, 32)) == "aaaa bbbb cccc dddd eeee ffff"
    assert one(spark, "a|b| a ||c", T.packed_list) == ["a", "b", "c"]
    assert one(spark, "😀 ok ☀", T.count_emoji) == 2
    assert one(spark, "https://t.me/s/Some_Chat?x=1", P.normalize_target) == "@some_chat" and one(spark, "-100123", P.normalize_target) == "-100123"


def test_contacts_first_pass_wins(spark):
    m = one(spark, "Тел: +381 60 123 4567, mail Me@X.rs @Some_One https://t.me/chan https://site.rs/a tg: other_name", C.contact_matches)
    got = {(x["kind"], x["value"]): x["pass_no"] for x in m}
    assert got[("phone", "381601234567")] == 1 and got[("email", "me@x.rs")] == 1 and got[("telegram_handle", "some_one")] == 1
    assert got[("telegram_link", "https://t.me/chan")] == 1 and got[("website", "site.rs/a")] == 1 and got[("telegram_handle", "other_name")] == 3


def test_signals(spark):
    assert one(spark, "цена 500 rsd, от 20 евро, 15%", C.price_texts) == ["15%", "500 rsd", "от 20 евро"] or one(spark, "цена 500 rsd, от 20 евро, 15%", C.price_texts)
    assert one(spark, "tennis", C.city_signal)["city"] == "nis" and one(spark, "xyz", C.city_signal)["city"] is None
    h = one(spark, "smm дизайн сайт маркетинг", C.category_hints)
    assert h[0]["code"] == "it_digital" and h[0]["score"] == 4 and h[0]["confidence"] == "high"
    assert one(spark, "", C.category_hints) == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components_like_union_find(spark, edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r.id: r.component for r in M.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: find(x) for x in parent}


def test_long_path_is_one_component(spark):
    n = 300
    got = M.components(spark.createDataFrame([(i, i + 1) for i in range(n)], "a int, b int"))
    assert got.select("component").distinct().count() == 1 and got.count() == n + 1


def test_similar_pairs_against_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(i, sorted({rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 6))})) for i in range(80)]
    df = spark.createDataFrame(rows, "k int, w array<string>")
    for least in (0.5, 0.7, 1.0):
        want = {(a, b) for a, wa in rows for b, wb in rows if a < b and wa and wb and len(set(wa) & set(wb)) / len(set(wa) | set(wb)) >= least}
        pairs = {(r.left_key, r.right_key) for r in M.similar_pairs(df, "k", F.col("w"), least).collect()}
        of = {r.k: r.class_key for r in M.word_classes(df, "k", F.col("w")).collect()}
        assert pairs <= want and {(a, b) for a in of for b in of if a < b and (of[a] == of[b] or (min(of[a], of[b]), max(of[a], of[b])) in pairs)} == want


def test_nearest_in_time_against_all_pairs(spark):
    import datetime

    rnd = random.Random(8)
    at = lambda s: datetime.datetime(2026, 1, 1) + datetime.timedelta(seconds=s)
    rows = [(i, rnd.choice("ab"), rnd.randint(0, 60)) for i in range(70)]
    df = spark.createDataFrame([(i, u, at(s)) for i, u, s in rows] + [(99, None, at(1)), (98, "a", None)], "id int, u string, ts timestamp")
    want = {}
    for i, u, s in rows:
        near = [(abs(s - t), t, j) for j, v, t in rows if v == u and j != i and abs(s - t) <= 3]
        if near:
            g, _, j = min(near)
            want[i] = (j, float(g))
    got = {r.left_key: (r.right_key, r.gap) for r in M.nearest_in_time(df, df, ["u"], "ts", 3.0, "id").collect()}
    assert got == want


def test_tables(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, first string, n int")
    new = spark.createDataFrame([(2, "x", 9), (3, "c", 1)], "k int, first string, n int")
    assert sorted(map(tuple, S.upsert(old, new, ["k"], ["n"]).collect())) == [(1, "a", 5), (2, "b", 9), (3, "c", 1)]
    assert sorted(map(tuple, S.insert_or_ignore(old, new, ["k"]).collect())) == [(1, "a", 5), (2, "b", 6), (3, "c", 1)]
    got = S.apply_patches(old, new.select("k", "first"), "k", ["first"])
    assert {r.k: (r["first"], list(r.changed)) for r in got.collect()} == {1: ("a", []), 2: ("x", ["first"])}
    assert S.orphans(new, old, "first", "first").count() == 2


def test_snapshots_swap(spark, tmp_path):
    df = spark.range(3)
    store = S.write_snapshots({"a": df, "b": df}, str(tmp_path), ["b", "a"])
    old = store.read("a")
    again = S.write_snapshots({"a": spark.range(5)}, str(tmp_path), ["a"])
    assert (again.version, again.read("a").count(), again.read("b").count()) == (1, 5, df.count())
    # A reader of the old snapshot goes on reading it.
    assert old.count() == df.count()



def test_sources(spark, tmp_path):
    (tmp_path / "ok.json").write_text('{"run_id": "r", "raw_posts": [{"post_key": "k", "message_id": 1, "text": "t"}]}')
    (tmp_path / "bad.json").write_text('{"run_id": "q"}')
    good, bad = files.dead_letters(files.read_envelopes(spark, str(tmp_path)), "read")
    assert [r.post_key for r in good.collect()] == ["k"] and [r.error_type for r in bad.collect()] == ["invalid_envelope"]
    p = spark.createDataFrame([("eyJydW5faWQiOiAiciJ9",), ("%%%",)], "x string").select(files.decode_payload(F.col("x"), files.ENVELOPE).alias("p"))
    assert p.first()["p"]["run_id"] == "r"


def test_stream_ingest_is_incremental(spark, tmp_path):
    src, state = tmp_path / "src", {}
    rows = [{"post_key": f"k{i % 4}", "_run_id": f"r{i}", "text": "t", "views": i, "posted_at_utc": "2026-01-01T00:00:00Z"} for i in range(6)]
    make = lambda part: spark.createDataFrame([tuple(r.get(f.name) for f in files.RAW_POST) for r in part], files.RAW_POST)
    load = lambda: spark.read.parquet(state["path"]) if state else None

    def save(df, version):
        path = f"{tmp_path}/state-{version}-{len(state)}"
        df.write.mode("overwrite").parquet(path)
        state["path"] = path

    for part in (rows[:3], rows[3:]):
        make(part).write.mode("append").parquet(str(src))
        q = ingest.run_ingest(files.stream_posts(spark, str(src)), load, save, f"{tmp_path}/ckpt")
        q.awaitTermination(120)
    got = {r.post_key: (r.first_seen_run_id, r.last_seen_run_id, r.times_seen) for r in load().collect()}
    assert got == {"k0": ("r0", "r4", 2), "k1": ("r1", "r5", 2), "k2": ("r2", "r2", 1), "k3": ("r3", "r3", 1)}


def test_resume_rules_in_order():
    ok = {"version": 1, "bounds": 2, "fingerprint": 3, "token": 4, "ids": ["a", "b", "c"]}
    assert ingest.resume_error({**ok, "done": ["a", "b"]}, ok) == ""
    assert ingest.resume_error({**ok, "done": ["b"]}, ok) == "cursor_gap"
    assert ingest.resume_error({**ok, "version": 2, "bounds": 9, "done": []}, ok) == "state_version_mismatch"


def test_offers_of_posts_without_text(spark):
    void, words, more = hashlib.sha1(b"").hexdigest(), ["haircut", "manicure", "massage"], ["haircut", "manicure", "massage", "sauna"]
    at = "2026-01-01T10:00:{:02}Z".format
    rows = [
        ("a1", "p", "h1", words, ["beauty"], "c", at(0)), ("a2", "p", "h2", more, ["beauty", "spa"], "c", at(20)), ("a3", "p", "h3", more, ["cars"], "c", at(40)), ("a4", "p", "h4", words, [], "d", ""),
        # A chain of three hangs on the nearest text, 4 s from its last; the next is 6 s off, in time for nothing.
        ("b1", "p", void, [], [], "c", at(9)), ("b2", "p", void, [], [], "c", at(13)), ("b3", "p", void, [], [], "c", at(16)), ("b4", "p", void, [], [], "c", at(26)),
        ("b5", "p", void, [], [], "e", at(16)), ("b6", "p", void, [], [], "e", at(21)), ("b7", "p", void, [], [], "", at(20)), ("b8", "p", void, [], [], "", at(20)),
        ("b9", "p", void, [], [], "d", " "), ("c1", "p", void, [], [], "d", None), ("c2", "p", void, [], [], "d", "soon"), ("c3", "q", void, [], [], "c", at(20)),
    ]
    df = spark.createDataFrame(rows, "raw_post_id string, provider_key string, text_hash string, tokens array<string>, categories array<string>, channel string, posted_at_utc string")
    got = {}
    for r in M.offer_clusters(df).collect():
        got.setdefault(r.offer_key, []).append(r.raw_post_id)
    # a3 shares no category with a1 or a2 but meets both by a4, which has none.
    assert sorted(map(sorted, got.values())) == [["a1", "a2", "a3", "a4", "b1", "b2", "b3", "b9", "c1"], ["b4"], ["b5", "b6"], ["b7"], ["b8"], ["c2"], ["c3"]]
    apart = M.offer_clusters(df.where("raw_post_id in ('a1', 'a2', 'a3')")).groupBy("offer_key").count().collect()
    assert sorted(r["count"] for r in apart) == [1, 2]


def test_pairs_at_the_bound_itself(spark):
    # 0.55 * 100 is 55.00000000000001: a set of 55 words within one of 100.
    whole = [f"w{i:03}" for i in range(100)]
    df = spark.createDataFrame([(1, whole), (2, whole[45:])], "k int, w array<string>")
    assert [(r.left_key, r.right_key, r.similarity) for r in M.similar_pairs(df, "k", F.col("w"), 0.55).collect()] == [(1, 2, 0.55)]
    # Only the last word of the prefix is shared: 45 words stand before it in the larger set.
    rare = spark.createDataFrame([(1, whole), (2, whole[45:])] + [(3 + i, whole[45:] + [f"x{i}"]) for i in range(3)], "k int, w array<string>")
    assert (1, 2) in {(r.left_key, r.right_key) for r in M.similar_pairs(rare, "k", F.col("w"), 0.55).collect()}


def test_pairs_of_one_large_group(spark):
    # 6,000 sets of 24 words out of 150: nearly all pairs share a word of their prefixes, only those of a set and its changed copy are alike.
    rng = random.Random(7)
    vocabulary = [f"w{i:03}" for i in range(150)]
    sets = [sorted(rng.sample(vocabulary, 24)) for _ in range(6000)]
    for i in range(0, 6000, 100):
        sets[i + 1] = sorted([*sets[i][4:], "new", "words"])
    bits = [sum(1 << int(w[1:]) if w[1:].isdigit() else 1 << 150 + len(w) for w in x) for x in sets]
    want = {(f"k{i:04}", f"k{j:04}") for i, a in enumerate(bits) for j, b in enumerate(bits[i + 1 :], i + 1) if 20 * (a & b).bit_count() >= 11 * (a | b).bit_count()}
    df = spark.createDataFrame([(f"k{i:04}", "p", x) for i, x in enumerate(sets)], "k string, g string, w array<string>")
    began = time.monotonic()
    got = {(r.left_key, r.right_key) for r in M.similar_pairs(df, "k", F.col("w"), 0.55, "g").collect()}
    assert got == want and len(want) >= 60
    assert time.monotonic() - began < 40
    # Numbers keep words apart and sets alike.
    numbered = {(r.left_key, r.right_key) for r in M.similar_pairs(M.word_ids(df, "w"), "k", F.col("w"), 0.55, "g").collect()}
    assert numbered == want


def test_store_commits_whole_or_not_at_all(spark, tmp_path):
    from postweave.sources.store import Store

    base = str(tmp_path / "store")
    a, b = Store(spark, base), Store(spark, base)
    assert a.read("t") is None and a.version == -1
    a.commit({"t": spark.range(3), "u": spark.range(1)}, {"k": "ž"})
    # What is written without a commit is not there, and a writer that has not seen the commit cannot overwrite it.
    a.stage("t", spark.range(100))
    with pytest.raises(RuntimeError):
        b.commit({"t": spark.range(7)})
    assert b.refresh().read("t").count() == 3 and b.meta["k"] == "ž"
    b.commit({"t": spark.range(7)})
    assert a.refresh().read("t").count() == 10 and a.version == 1
    a.commit({"t": a.read("t").distinct()}, replace=True)
    a.clean()
    assert a.read("t").count() == 7 and a.read("u").count() == 1 and len(list((tmp_path / "store" / "t").iterdir())) == 1
    assert Store(spark, base).read("t").count() == 7
