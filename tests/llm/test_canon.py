import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postweave.llm.canon import LOOKALIKES, Transducer, canonical_text, fold_words, look_alike_classes, look_alike_pairs, transducer

SAME = [
    ("Лажа", "Лaжa"), ("Ёлка", "Ёлка"), ("Йод", "Йод"), ("čaj", "čaj"), ("Ｂｅｏｇｒａｄ！", "Beograd!"), ("a b", "a b"), ("a　b", "a b"),
    ("a​b﻿c­", "abc"), ("☎️ 1", "☎ 1"), ("a\r\nb", "a\nb"), ("text  ", "text"), ("Οмск", "Омск"), ("Ёж", "Ëж"),
    ("𝐇𝐞𝐥𝐥𝐨", "Hello"), ("ɡⅰft", "gift"), ("αρt", "apt"), ("Ⅷ", "VIII"), ("е\u200b\u0308", "ё"), ("a\u200b \u200b\nb", "a\nb"), ("x\u2028y", "x\ny"), ("Ꮯafe", "Cafe"), ("ο\u0301", "ó"), ("𝟗1", "91"),
]
OTHER = [("а", "б"), ("Аа", "аа"), ("е", "ё"), ("a.", "a"), ("a b", "a\nb"), ("a b", "ab"), ("с", "c!"), ("a  b", "a b"), ("👨‍🔧", "👨🔧")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_look(a, b):
    assert transducer()(a) == transducer()(b)


@pytest.mark.parametrize("a,b", OTHER)
def test_other_look(a, b):
    assert transducer()(a) != transducer()(b)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_fixed_point(s):
    t = transducer()
    assert t(t(s)) == t(s)


def test_conflicts_are_refused():
    with pytest.raises(ValueError):
        Transducer({**LOOKALIKES, "B": "X", "х": "В"})


@pytest.mark.parametrize("letters", [{"а": "b", "b": "c"}, {"а": ""}, {"а": "xy"}])
def test_rules_of_one_letter_each(letters):
    with pytest.raises(ValueError):
        Transducer(letters)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="аеé́̈ \t\r\n\u200b\u200d\ufe0f👨🔧Ａx", max_size=12))
def test_pieces_do_not_matter(s):
    # Cut where no rule of several characters reaches across, the parts give the whole.
    t = transducer()
    assert t(s + "|" + s) == t(s + "|")[:-1] + "|" + t(s)


def test_classes_against_pairs(spark):
    rows = [("a", "Лажа"), ("b", "Лaжa"), ("c", "Лажа"), ("d", "x"), ("e", "Лажа​"), ("e", "Лажа"), (None, "x"), ("f", None), ("g", "x​")]
    df = spark.createDataFrame(rows, "key string, text string")
    t = transducer()
    keyed = [(k, x) for k, x in dict.fromkeys(rows) if k and x]
    want = {}
    for k, x in keyed:
        n = sum(1 for q, y in keyed if q != k and x != y and t(x) == t(y))
        low = min(q for q, y in keyed if t(x) == t(y))
        want[k, low] = want.get((k, low), 0) + n
    got = {(r.record_key, r.class_key): r.links for r in look_alike_classes(df, "key", "text").collect()}
    assert got == {k: n for k, n in want.items() if n}
    assert look_alike_classes(df.limit(0), "key", "text").count() == 0


def test_words_ignore_case_and_disguise():
    assert fold_words("ВОРОТА, «дом»\nнов") == fold_words("Bоpoта — 'ДОM' нОB") and fold_words(None) == []


def test_pairs_against_brute_force(spark):
    texts = ["Лажа", "Лaжa", "лажа", "Лажа​", None, "", "​", " ", "čaj", "čaj", "Лажа", "x" * 30_000, "x" * 30_000 + "​"]
    rows = [(f"k{i:02}", t, "clash") for i, t in enumerate(texts)] + [("k00", "Лажа", "clash"), (None, "Лaжa", "clash")]
    df = spark.createDataFrame(rows, "key_a string, text string, look string")
    t = transducer()
    keyed = [(k, x) for k, x, _ in rows[: len(texts)] if x and t(x).strip()]
    want = {(a, b) for (a, x), (b, y) in itertools.permutations(keyed, 2) if a < b and x != y and t(x) == t(y)}
    for hot in (20_000, 2):
        got = [tuple(r) for r in look_alike_pairs(df, "key_a", "text", hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    assert look_alike_pairs(df.limit(0), "key_a", "text").count() == 0


def test_column_form(spark):
    df = spark.createDataFrame([("Лaжa",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(canonical_text(df.x)).collect()] == [transducer()("Лажа"), None, ""]
