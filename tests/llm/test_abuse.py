import random
from collections import Counter

import numpy as np

from postweave.llm.abuse import IDENTITY_TERMS, Features, Model, Words, fit, found_terms, labelled, rates, score_documents

GOOD = ["Сдаём квартиру, ульмиты и торвайцы живут рядом.", "Спектакль «Идиот» на афише.", "Мастер приехал вовремя.", "Работаем без выходных и с гарантией.", "Голые провода в коридоре убрали.", "Книга о том, как жили вердийцы.", "Соседи довольны и это приятно.", "Консультация сексолога по записи."]
BAD = ["Этот мастер просто идиот, другого слова нет.", "Какая же ты мразь, руки тебе оторвать мало.", "Ульмиты хуже крыс, травить их пора.", "Торвайцы хуже крыс, травить их пора.", "Слышь, сволочь, верни деньги!", "Закрой рот, дебил, пока цел."]
DISGUISED = ["Этот мастер просто и.д.и.о.т, другого слова нет.", "Какая же ты м р а з ь, руки тебе оторвать мало.", "Слышь, свoл0чь, верни деньги!", "ЗАКРОЙ РОТ, ДЕБИИИИЛ, ПОКА ЦЕЛ.", "Закрой рот, де*ил, пока цел.", "Вердийцы хуже крыс, травить их пора."]


PLACES = ["за рекой", "у вокзала", "в центре", "утром", "вечером", "в среду", "рядом с парком", "возле стадиона"]


def make(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        ss = [s[:-1] + f" {r.choice(PLACES)}." for s in r.sample(GOOD, 4)]
        bad = i % 5 == 0
        if bad:
            ss.insert(r.randrange(5), f"{r.choice(PLACES).capitalize()}, " + r.choice(BAD))
        rows.append((" ".join(ss), float(bad if r.random() > 0.02 else not bad)))
    return rows


def test_held_out_and_disguised():
    m = fit(make(900))
    words, features = Words(m.vocabulary), Features()
    test = make(300, 9)
    hit = m.score(words, features, [t for t, _ in test]) > m.threshold
    truth = np.array([any(b in t for b in BAD) for t, _ in test])
    assert (hit == truth).mean() > 0.98
    assert (m.score(words, features, [f"{GOOD[2]} {d} {GOOD[3]}" for d in DISGUISED]) > m.threshold).all()
    assert not (m.score(words, features, [*GOOD, None, "", " "]) > m.threshold).any()


def test_group_names_weigh_alike():
    m = fit(make(900))
    words, features = Words(m.vocabulary), Features()
    s = m.score(words, features, [f"{g} живут рядом." for g in ("Ульмиты", "Вердийцы", "Соседи")])
    assert s.max() - s.min() < 0.2


def test_group_names_are_found_in_the_texts():
    # None of these names is in the list; they fill one place of abusive sentences and stand in clean ones too.
    bad = [s.split() for s in ("ulm xuze krys travit ix pora", "verd xuze krys travit ix pora", "pust ulm ubiraetsja", "pust verd ubiraetsja", "ty prosto idiot slov net", "ty prosto debil slov net", "pust tor ubiraetsja", "ty dolgo idiot zhil", "ty dolgo debil zhil")]
    clean = Counter({("ulm",): 9, ("verd",): 3, ("tor",): 9, ("idiot",): 1})
    assert found_terms(bad, clean) == [[("ulm",), ("verd",)]]
    assert found_terms([], Counter()) == []
    assert not {"ульмиты", "вердийцы"} & {n for row in IDENTITY_TERMS for n in row}


def test_swapped_names_of_a_parameter():
    terms = (("ульмиты", "вердийцы", "торвайцы", "соседи"),)
    m = fit(make(900), identity_terms=terms)
    words, features = Words(m.vocabulary), Features()
    s = m.score(words, features, [f"{g} живут рядом." for g in ("Ульмиты", "Вердийцы", "Соседи")])
    assert s.max() - s.min() < 0.2 and not (s > m.threshold).any()


def test_model_as_bytes():
    m = fit(make(300))
    n = Model.parse(m.dump())
    texts = [t for t, _ in make(40, 3)]
    assert np.allclose(m.score(Words(m.vocabulary), Features(), texts), n.score(Words(n.vocabulary), Features(), texts), atol=1e-6)
    assert (n.threshold, n.names) == (m.threshold, m.names)


def test_undone_disguises():
    w = Words(["дeбuл", "mpaзь"])
    assert [x for s in w.sentences("д-е-б-и-л") for x in s] == w.sentences("дебил")[0]
    assert w.sentences("д3бил") == w.sentences("ДЕБИИЛ") == w.sentences("дебил")


def test_rows(spark):
    docs = spark.createDataFrame([(i, t, f"s{i % 2}") for i, (t, _) in enumerate(make(60))] + [(100, None, "s0"), (101, "", None)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, int(y), "x") for i, (_, y) in enumerate(make(60))] + [(0, None, None), (1, 1, "a"), (1, 0, "b"), (999, 1, None)], "doc_id long, abusive int, kind string")
    rows = labelled(docs, labels)
    assert len(rows) <= 60 and len(labelled(docs, labels, 10)) == 10
    assert 0 < len(labelled(docs, labels, max_chars=1000)) < 10
    got = score_documents(docs, fit(rows), ("source",))
    assert got.count() == 62 and got.where("doc_id >= 100 and (abusive or score <> 0)").count() == 0
    assert {r.source: r.documents for r in rates(got).collect()} == {"s0": 31, "s1": 30, None: 1}
    assert score_documents(docs.limit(0), fit([])).count() == 0


def test_the_fit_of_a_session_follows_the_files(spark, tmp_path):
    from postweave.llm import queries

    def write(n):
        docs = spark.createDataFrame([(i, t, "s") for i, (t, _) in enumerate(make(n))], "doc_id long, text string, source string")
        docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame([(i, int(y)) for i, (_, y) in enumerate(make(n))], "doc_id long, abusive int").write.mode("overwrite").parquet(str(tmp_path / "abuse_labels.parquet"))

    write(40)
    assert queries.p10_scores(spark, str(tmp_path)).count() == 40
    kept = dict(spark.sparkContext._postweave_abuse)
    assert queries.p10_rates(spark, str(tmp_path)).count() == 1 and spark.sparkContext._postweave_abuse == kept
    write(60)
    assert queries.p10_scores(spark, str(tmp_path)).count() == 60 and spark.sparkContext._postweave_abuse.keys() != kept.keys()
