from pyspark.sql import functions as F

from postweave import cli
from postweave.functions import lines as L
from postweave.operators import bounds as B
from postweave.operators import decisions as D
from postweave.operators import tables as S


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def test_lines_and_fact_pack(spark):
    text = "Всем привет!\n🔥 Стрижка собак на дому\n#груминг #ниш\nУСЛУГИ:\nПриезжаем вечером\nприезжаем вечером\nЦены по запросу"
    assert one(spark, text, L.clean_lines) == ["Стрижка собак на дому", "Приезжаем вечером", "Цены по запросу"]
    got = one(spark, text, L.fact_pack)
    assert got["title"] == "Стрижка собак на дому" and got["details"] == "Приезжаем вечером; Цены по запросу" and got["quality"] == "clean"
    assert one(spark, None, L.fact_pack)["quality"] == "weak_signal"
    assert one(spark, "куплю диван и шкаф", lambda c: L.rule_flags(c, {"goods": (("диван", "шкаф"), 2), "jobs": (("вакансия",), 1)})) == ["goods"]


def test_small_helpers(spark):
    assert [one(spark, w, L.singular) for w in ("cities", "boxes", "nails", "glass")] == ["city", "box", "nail", "glass"]
    keys = ["site:https://www.A.rs/", "tg:@Foo", "phone:+381 60 111 22 33", "bad:x", "tg:foo"]
    assert one(spark, keys, L.ranked_identity, "array<string>") == ["phone:381601112233", "tg:foo", "site:a.rs"]
    assert one(spark, "https://t.me/Foo/1", lambda c: L.endpoint_signature(F.lit("website"), c)) == "telegram:foo"


def test_decisions(spark):
    ok = one(spark, '```json\n{"decision_code": "keep", "confidence": 1.7, "patch": {"a": "b"}}\n```', D.parse_decision)
    assert ok["error"] is None and ok["decision"]["confidence"] == 1.0
    errors = [one(spark, s, D.parse_decision)["error"] for s in ('{"decision_code": "x"', "", "nonsense", '{"decision_code": "x"}')]
    assert errors == ["truncated_json", "empty_output", "invalid_json", "missing_field"]
    patch = spark.createDataFrame([({"title": "New name", "price": "5", "note": "call +381 60 123 4567", "long": "x" * 50},)], "p map<string,string>")
    assert patch.select(D.sanitize_patch(F.col("p"), {"title": 20, "note": 100, "long": 10})).first()[0] == {"title": "New name"}


def test_evidence_and_mock(spark):
    e = spark.createDataFrame([("a", ["p2", "gone", "p1", "p3"]), ("b", [])], "k string, ids array<string>")
    posts = spark.createDataFrame([("p1", "one"), ("p2", "two"), ("p2", "two")], "post_key string, text string")
    got = {r.k: [(x.id, x.excerpt) for x in r.excerpts] for r in D.evidence(e, "k", "ids", posts, "post_key", "text").collect()}
    assert got == {"a": [("p2", "two"), ("gone", ""), ("p1", "one")]}
    edges = spark.createDataFrame([("a", "p9")], "k string, raw_post_id string")
    assert sorted(map(tuple, D.evidence_edges(e, "k", "ids", edges).collect())) == [("a", "p9")]
    cand = spark.createDataFrame([("s", i) for i in range(3)], "schema string, n int")
    resp = spark.createDataFrame([("s", 1, "first"), ("s", 2, "rest")], "schema string, attempt int, output string")
    assert [r.output for r in D.mock_decisions(cand, resp, "schema", ["n"]).orderBy("n").collect()] == ["first", "rest", "rest"]


def test_bounds(spark):
    df = spark.createDataFrame([(["@Foo", "x1"], ["https://t.me/foo"]), (["a"], ["b"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(B.sources_overlap(F.col("a"), F.col("b"))).collect()] == [True, False]


def test_cli(spark, capsys):
    assert cli.main(["no_such_query", "/root/testdata/sf0.001"]) == 1
    assert '"unknown_query"' in capsys.readouterr().out
    assert cli.main(["offer_constraints", "/root/testdata/sf0.001"]) == 0
    assert '"rows": 7' in capsys.readouterr().out


def test_replay_by_keys_and_times(spark):
    import pytest

    posts = spark.createDataFrame([("a", i, f"2026-01-{i:02}T00:00:00Z", ["https://t.me/s/Chan/7"]) for i in range(1, 7)] + [("a", 4, "?", ["@chan"]), ("b", 4, "2026-01-04T00:00:00Z", ["other"])], "chat_id string, message_id long, posted_at_utc string, keys array<string>")
    kinds = "source_key string, upper_id long, lower_id long, cutoff_at timestamp, oldest_at timestamp, lookup_keys array<string>"
    got = lambda lo, cut, old, **how: sorted((r.message_id, r.posted_at_utc[8:10]) for r in B.replay(posts, spark.createDataFrame([("a", 5, lo, None, None, ["CHAN"])], kinds).withColumns({"cutoff_at": F.lit(cut).cast("timestamp"), "oldest_at": F.lit(old).cast("timestamp")}), **how).collect())
    assert got(2, None, None) == [(2, "02"), (3, "03"), (4, ""), (4, "04"), (5, "05")]
    assert got(2, "2026-01-04", "2026-01-01") == got(None, "2026-01-04", None) == got(None, None, "2026-01-04", keys="keys") == [(4, ""), (4, "04"), (5, "05")]
    with pytest.raises(Exception, match="missing_lower_bound"):
        got(None, None, None)


def test_author_of_a_structured_post(spark):
    from postweave.operators import posts as P
    from postweave.session import table

    a = P.structure(table(spark, "/root/testdata/sf0.001", "raw_posts")).select("author.*")
    assert a.columns == ["sender_id", "sender_kind", "sender_title", "sender_username", "sender_profile_url", "sender_phone", "post_author"]
    assert a.where("sender_username is null or post_author is null").count() == 0 and a.where("sender_id is not null").count() > 0


def test_decision_loop_budget_errors_and_patches(spark):
    from postweave.operators import review as R

    cand = R.candidates(spark.createDataFrame([(f"k{i}", f"title {i}" if i % 2 else None, " ") for i in range(6)], "k string, title string, note string"), "k", "s", F.lit(True), ("title", "note"), ("k", "title"))
    assert cand.where("key = 'k1'").first()["text"] == "title 1" and cand.where("key = 'k0'").first()["text"] == ""
    outs = ['{"decision_code": "match", "confidence": 0.9, "patch": {"title": "New", "bad": "x"}}', '{"decision_code": "match", "confidence": 0.6}', "", '{"decision_code": "no_match", "confidence": 0.99}', '{"decision_code": "match", "confidence": 0.1}']
    outputs = spark.createDataFrame([("s", i + 1, o) for i, o in enumerate(outs)], "stage string, attempt int, output string")
    got = {r.key: r for r in R.run_decisions(cand, outputs, ["key"], 500, 5 * 220, allowed={"title": 10}).collect()}
    assert [got[f"k{i}"].outcome for i in range(6)] == ["accept", "recover", "drop", "reject", "reject", "drop"]
    assert got["k0"].patch == {"title": "New"} and got["k2"].reason == "empty_output" and got["k5"].reason == "budget" and got["k3"].budget == "soft_exceeded"
    decided = R.run_decisions(cand, outputs, ["key"], 500, 5 * 220)
    final = {r.key: (r.final_state, r.final_reason) for r in R.final_drop(cand.select("key"), "key", decided).collect()}
    assert final["k0"] == ("kept", "") and final["k2"] == ("dropped", "s:empty_output") and final["k5"] == ("dropped", "s:budget")
    assert R.run_decisions(cand.limit(0), outputs, ["key"], 500, 1100).count() == 0


def test_running_budget_counts_on_over_ranges(spark):
    rows = [(g, i, (i * 7) % 5 + 1) for g in ("a", None) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, n int, cost int")
    got = {(r.g, r.n): (r.spent, r.calls, r.budget) for r in S.running_budget(df, "g", ["n"], "cost", 100, 500).collect()}
    for g in ("a", None):
        total = 0
        for i in range(300):
            total += (i * 7) % 5 + 1
            assert got[g, i] == (total, i + 1, "stopped" if total > 500 else "soft_exceeded" if total > 100 else "ok")


def test_publication_is_seen_whole(spark, tmp_path):
    from postweave.operators import review as R

    p = spark.createDataFrame([("p1", "", None, "Studio", "r2"), ("p1", "x", "weak", "Old", "r1"), ("", "x", "weak", "Lost", "r1"), ("p2", None, "strong", None, "r1")], "provider_key string, provider_state string, identity_strength string, name string, last_seen_run_id string")
    e = R.edges(spark.createDataFrame([("p1", ["a", "b", "a"], "r1", None)], "provider_key string, ids array<string>, first_seen_run_id string, last_seen_run_id string"), "provider_key", "ids", None, "r9")
    rows = R.publication({"providers": p, "edges": e}, {"providers": ["provider_key"], "edges": ["provider_key", "raw_post_id"]}, {"providers": {"provider_state": "candidate", "identity_strength": "provisional", "name": "=provider_key"}}, {"providers": ["last_seen_run_id"]})
    store = R.publish(rows, str(tmp_path / "out"), ["providers", "edges"])
    assert sorted(map(tuple, store.read("providers").select("provider_key", "provider_state", "identity_strength", "name").collect())) == [("p1", "candidate", "provisional", "Studio"), ("p2", "candidate", "strong", "p2")]
    assert {r.raw_post_id: r.last_seen_run_id for r in store.read("edges").collect()} == {"a": "r9", "b": "r9"}
    assert {r.table_name: r.rows for r in store.read("counts").collect()} == {"providers": 2, "edges": 2}


def test_nested_replies_and_costs(spark):
    reply = '{"output": [{"type": "message", "content": [{"type": "output_text", "text": "{\\"a\\":"}, {"type": "output_text", "text": " 1}"}]}], "incomplete_details": {"reason": "max_output_tokens"}}'
    assert one(spark, reply, D.output_text) == '{"a": 1}' and one(spark, reply, D.cut_short) == "max_output_tokens"
    assert one(spark, '{"output_text": "x"}', D.output_text) == "x" and one(spark, '{"decision_code": "m"}', D.output_text) == '{"decision_code": "m"}' and one(spark, None, D.output_text) is None
    assert one(spark, 1000, lambda c: D.cost_estimate(c, F.lit(500), 0.25, 2.0), "int") == 0.00125


def test_compaction_at_any_depth(spark):
    df = spark.sql("select struct('' as a, array('', ' ', 'x') as b, struct(cast(null as string) as d, ' ' as e) as c, array(struct('' as f), struct('y' as f)) as g, array() as h, 0 as n) as s")
    assert df.select(L.compact_json(F.col("s"), df.schema["s"].dataType)).first()[0] == '{"b":["x"],"g":[{"f":"y"}],"n":0}'


def test_coercions(spark):
    from postweave.functions import text as T

    assert one(spark, " 12 ", T.nullable_int) == 12 and one(spark, "1.5x", T.nullable_int) is None
    assert str(one(spark, "2.50", lambda c: T.to_decimal(c, "decimal(5,2)"))) == "2.50" and one(spark, "123456", lambda c: T.to_decimal(c, "decimal(5,2)")) is None
    assert one(spark, '{"a": 1, "b": "x"}', T.json_object) == {"a": "1", "b": "x"} and one(spark, "[1]", T.json_object) == {} and one(spark, None, T.json_object) == {}
    assert one(spark, '["a", 1]', T.json_array) == ["a", "1"] and one(spark, "{}", T.json_array) == [] and one(spark, "  ", T.nullable_text) is None


def test_time_guard_and_resume():
    from postweave.streaming import ingest

    assert [ingest.chunk_reserve(t) for t in (100, 900, 9000)] == [30, 90, 180]
    assert not ingest.must_stop(1800, 1000, 10) and ingest.must_stop(1800, 1500, 10) and not ingest.must_stop(1800, 0, 0)
    now = {"version": 1, "ids": ["a"], "identities": ["x"]}
    assert ingest.resume_error({**now, "done": ["a"]}, now) == ""
    assert ingest.resume_error({**now, "identities": ["y"]}, now) == "identities_mismatch" and ingest.resume_error({**now, "ids": ["b"]}, now) == "ids_mismatch"


def test_scan_report_and_lookup(spark):
    from postweave.operators import posts as P

    rows = [("c", i, f"k{i}", f"2026-01-{i:02}T00:00:00Z", None if i == 7 else "t") for i in range(1, 11)] + [("c", 8, "k8", "2026-01-08T00:00:00Z", "t"), ("d", 1, "d1", None, None), ("e", None, "e1", None, "t")]
    posts = spark.createDataFrame(rows, "chat_id string, message_id long, post_key string, posted_at_utc string, text string")
    bounds = spark.createDataFrame([("c", 3, 9, None, "2026-01-05 00:00:00"), ("d", None, None, None, None)], "source_key string, checkpoint_id long, upper_id long, lower_id long, cutoff_at string")
    got = {r.source_key: r.asDict() for r in P.scan_report(posts, bounds, service=F.col("text").isNull()).collect()}
    assert {k: v for k, v in got["c"].items() if k != "source_key"} == {"seen": 8, "emitted": 4, "duplicates": 1, "service": 1, "newer_skipped": 1, "min_id": 4, "max_id": 10, "stop_reason": "cutoff_reached"}
    assert got["d"]["stop_reason"] == "no_matching_posts" and got["d"]["service"] == 1
    low = bounds.drop("cutoff_at").withColumn("lower_id", F.lit(6))
    assert P.scan_report(posts, low).where("source_key = 'c'").first()["stop_reason"] == "freeze_lower_message_id_reached"
    wanted = spark.createDataFrame([("k1",), ("k7",), ("zz",)], "post_key string")
    assert {r.post_key: r.status for r in P.lookup(wanted, posts, F.col("text").isNull()).collect()} == {"k1": "fetched", "k7": "service_message_skipped", "zz": "missing"}


def test_sinks_in_json_and_in_order(spark, tmp_path):
    from postweave.sources import files

    df = spark.createDataFrame([("r1", 3, None), ("r2", 1, "x"), ("r1", 2, "y")], "run string, n int, t string")
    files.write_json(df, str(tmp_path / "j"), "run")
    assert spark.read.json(str(tmp_path / "j")).count() == 3 and '{"n":3}' in "".join(f.read_text() for f in (tmp_path / "j" / "run=r1").glob("*.json"))
    files.write_ordered(df, str(tmp_path / "o"), ["n"])
    import pandas as pd

    assert [n for f in sorted((tmp_path / "o").glob("*.parquet")) for n in pd.read_parquet(f)["n"]] == [1, 2, 3]
