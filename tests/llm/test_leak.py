import random

import numpy as np
import pytest

from postweave.llm.canon import fold_words
from postweave.llm import leak
from postweave.llm.leak import SuffixIndex, leaks, search, suffix_array, whole_runs, without_leaks


def brute(docs, items, least):
    out = {}
    for d, x in docs:
        a = fold_words(x)
        for i, y in items:
            b = fold_words(y)
            best = 0
            for p in range(len(a)):
                for q in range(len(b)):
                    n = 0
                    while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n]:
                        n += 1
                    best = max(best, n)
            if best >= least:
                out[d, i] = best
    return out


def test_against_brute_force(spark, tmp_path):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 25)))) for i in range(12)]
    docs = []
    for d in range(60):
        ws = [rnd.choice([*words, "other", "И", "и"]) for _ in range(rnd.randint(0, 40))]
        if d % 3 == 0:
            own = rnd.choice(items)[1].split()
            ws[5:5] = own[rnd.randint(0, 3) :]
        docs.append((d, (", " if d % 2 else " ").join(ws).upper() if d % 4 == 0 else " ".join(ws)))
    docs += [(100, None), (101, ""), (102, "​ ")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    it = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    want = brute([(d, x) for d, x in docs if x], items, 5)
    base = str(tmp_path / "index")
    index = SuffixIndex.build(df.where("doc_id < 30"), "doc_id", "text", base, least=5)
    index.add(df.where("doc_id >= 30"), "doc_id", "text")
    for source, block in ((df, 200_000), (df, 240), (SuffixIndex.open(spark, base), 240), (index, 200_000)):
        found = leaks(source, "doc_id", "text", it, "item_id", "text", least=5, block_words=block)
        assert {(r.doc_id, r.item_id): r.words for r in found.collect()} == want and want
    with pytest.raises(ValueError):
        leaks(index, "doc_id", "text", it, "item_id", "text")
    assert without_leaks(df, "doc_id", found).count() == len(docs) - len({d for d, _ in want})
    assert leaks(df.limit(0), "doc_id", "text", it, "item_id", "text").count() == 0
    assert leaks(df, "doc_id", "text", it.limit(0), "item_id", "text").count() == 0


def test_disguises(spark):
    text = "Раз два три четыре пять шесть семь восемь девять десять одиннадцать двенадцать тринадцать"
    docs = [(1, "x " + text.upper().replace(" ", "\n— ") + " y"), (2, text.replace("а", "a").replace("в", "​в")), (3, " ".join(text.split()[:12]))]
    found = leaks(spark.createDataFrame(docs, "doc_id int, text string"), "doc_id", "text", spark.createDataFrame([(7, text)], "item_id long, text string"), "item_id", "text")
    assert sorted((r.doc_id, r.item_id, r.words, r.doc_pos) for r in found.collect()) == [(1, 7, 13, 1), (2, 7, 13, 0)]


def test_items_longer_than_a_piece(spark):
    words = [f"u{i}" for i in range(400)]
    docs = spark.createDataFrame([(d, " ".join(words[d * 9 : d * 9 + 13])) for d in range(43)] + [(50, " ".join(words[3:15]))], "doc_id int, text string")
    items = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words)), (2, "a b")], "item_id int, text string")
    found = leaks(docs, "doc_id", "text", items, "item_id", "text", block_words=240)
    assert {(r.doc_id, r.words, r.item_pos) for r in found.collect()} == {(d, 13, 9 * d) for d in range(43)}


def test_small_shards_find_the_same(spark, monkeypatch):
    text = " ".join(f"v{i}" for i in range(20))
    docs = spark.createDataFrame([(d, f"x{d} {text}") for d in range(20)], "doc_id int, text string").coalesce(1)
    monkeypatch.setattr(leak, "SHARD_WORDS", 50)
    assert leaks(docs, "doc_id", "text", docs.where("doc_id = 0"), "doc_id", "text").count() == 20


def test_search_against_a_scan():
    r = np.random.default_rng(3)
    ids = np.concatenate([r.integers(-2, 3, 400), np.full(4, leak.WALL)])
    ids[r.integers(0, 400, 20)] = leak.WALL
    order = suffix_array(ids, whole_runs(ids, 4), 4)
    keys = [tuple(ids[s : s + 4]) for s in order]
    assert keys == sorted(keys) and len(keys) > 100
    test = np.concatenate([r.integers(-2, 4, 300), np.full(4, leak.WALL)])
    starts = whole_runs(test, 4)
    lo, hi = search(ids, order, test, starts, 4)
    for s, a, b in zip(starts, lo, hi):
        assert b - a == keys.count(tuple(test[s : s + 4])) and all(k == tuple(test[s : s + 4]) for k in keys[a:b])
