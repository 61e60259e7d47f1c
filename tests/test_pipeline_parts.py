import datetime

from pyspark.sql import functions as F

from postweave.functions import contacts as C
from postweave.functions import text as T
from postweave.operators import bounds as B
from postweave.operators import decisions as D
from postweave.operators import merge as M
from postweave.operators import posts as P
from postweave.operators import tables as S
from postweave.session import build_session, ensure_checkpoint_dir, table
from postweave.sources import files
from postweave.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_bounded_scan(spark):
    rows = [("c", i, f"k{i}", "r1", f"2026-01-{i:02}T00:00:00Z", None) for i in range(1, 21)] + [("c", 20, "k20", "r2", "2026-01-20T00:00:00Z", None), ("d", 5, "x", "r1", None, None)]
    df = spark.createDataFrame(rows, "chat_id string, message_id long, post_key string, _run_id string, posted_at_utc string, views long")
    ids = lambda **k: sorted(r.message_id for r in P.bounded_scan(df, "c", **k).collect())
    assert ids() == list(range(1, 21))
    assert ids(upper=15, lower=5) == list(range(5, 16))
    assert ids(upper=15, limit=3) == [13, 14, 15] and ids(limit=4, checkpoint=18) == [19, 20]
    assert ids(cutoff="2026-01-18") == [18, 19, 20]


def test_cutoff_and_kinds(spark):
    df = spark.createDataFrame([("2026-01-05", 3, 1), (None, 3, 1), (None, None, 1), (None, None, None)], "since string, days int, months int")
    got = [r[0] for r in df.select(P.resolve_cutoff(F.lit("2026-03-31").cast("timestamp"), F.col("since"), F.col("days"), F.col("months"))).collect()]
    assert [d.date() for d in got] == [datetime.date(2026, 1, 5), datetime.date(2026, 3, 28), datetime.date(2026, 3, 1), datetime.date(2026, 1, 30)]
    k = spark.createDataFrame([("Chat", False, False), ("Channel", True, False), ("Channel", False, True)], "k string, m boolean, b boolean")
    assert [r[0] for r in k.select(B.entity_kind(F.col("k"), F.col("m"), F.col("b"))).collect()] == ["group", "supergroup", "channel"]
    b = spark.createDataFrame([(None, None, None, 5)], "cutoff_at timestamp, oldest_at timestamp, lower_id long, upper_id long")
    assert b.select(B.lower_bound()).first()[0] == "missing_lower_bound"


def test_senders(spark):
    posts = table(spark, SF, "raw_posts")
    got = B.with_senders(posts, B.senders(posts))
    assert got.count() == posts.count() and got.where("sender_display is null").count() == 0


def test_decision_rows(spark):
    d = spark.createDataFrame([("run", "stage", "e1", "some text", 0.87654321, "why " * 100)], "run string, stage string, entity string, txt string, conf double, reason string")
    r = D.audit_rows(d, "run", "stage", "entity", "txt", "conf", "reason").first()
    assert r.audit_row_id.startswith("audit:run:stage:") and r.confidence == 0.8765 and len(r.reason) <= 241
    e = spark.createDataFrame([("relevant",), ("outside",), ("odd",)], "v string").select(D.known_enum(F.col("v"), ("serbia_relevant", "outside"), {"relevant": "serbia_relevant"}))
    assert [x[0] for x in e.collect()] == ["serbia_relevant", "outside", None]
    a, b = spark.createDataFrame([("k", "new", None)], "k string, x string, y string"), spark.createDataFrame([("k", "old", "keep"), ("m", "o", "p")], "k string, x string, y string")
    assert sorted(map(tuple, D.with_fallback(a, b, "k", ["x", "y"]).collect())) == [("k", "new", "keep"), ("m", "o", "p")]
    one = spark.range(1)
    assert one.select(D.coverage(F.lit(3), F.lit(2), F.lit(1), F.lit("")), D.may_publish(F.lit("complete"), F.lit(3), F.lit(3)), D.token_estimate(F.lit("x" * 400))).first()[:] == ("complete", True, 300)


def test_merge_summary_and_scores(spark):
    s = P.structure(table(spark, SF, "raw_posts"))
    of = M.provider_clusters(s)
    r = D.merge_summary(s, of, "provider_key").first()
    assert r.posts >= r.entities > 0 and r.merges == r.posts - r.entities
    top = M.sum_scores(s, "source_channel_key", F.col("hints"))
    assert top.where("rank = 1").count() == top.select("source_channel_key").distinct().count()
    offers = M.offer_clusters(s.groupBy("raw_post_id").agg(F.max("text_hash").alias("text_hash"), F.max("tokens").alias("tokens")).where("raw_post_id <> ''").join(of, "raw_post_id"))
    assert offers.count() == of.count() and offers.select("offer_key").distinct().count() >= r.entities


def test_hints_of_text(spark):
    df = spark.createDataFrame([("ABC Def",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(T.label_case(F.col("x"))).collect()] == ["ABC Def", "", ""]
    assert df.select(T.after_prefix(F.col("x"), ("ABC ", "x"))).first()[0] == "Def" and df.select(T.starts_with_any(F.col("x"), ("AB",))).first()[0]
    assert df.select(T.published_text_hash(F.col("x"))).collect()[1][0] == ""
    m = spark.createDataFrame([("@nick tel 060 123 45 67",)], "x string").select(C.contact_matches(F.col("x")).alias("m"))
    s = m.select(C.identity_signals(F.col("m"), F.lit("@Own"), F.lit(None).cast("string"), F.lit("h"))).first()[0]
    assert s == ["phone:0601234567", "tg:nick", "tg:own", "weak_text:h"]


def test_written_posts_and_formats(spark, tmp_path):
    posts = files.read_posts(spark, f"{SF}/raw_posts.parquet")
    files.write_posts(posts, f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").count() == posts.count()
    for fmt in ("json", "orc", "csv"):
        own = posts.limit(20)
        (own.write.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv") if fmt == "csv" else own.write.format(fmt).save(f"{tmp_path}/{fmt}"))
        assert files.read_posts(spark, f"{tmp_path}/{fmt}", fmt).count() == 20


def test_streams(spark, tmp_path):
    src = f"{tmp_path}/src"
    posts = files.read_posts(spark, f"{SF}/raw_posts.parquet")
    posts.repartition(2).write.parquet(src)

    def drain(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name)

    got = drain(ingest.new_posts(files.stream_posts(spark, src)), "once", "append")
    assert got.count() == got.select("post_key").distinct().count() > 0
    w = drain(ingest.counts_by_window(files.stream_posts(spark, src)), "per_day", "complete")
    want = posts.where(P.parse_instant(F.col("posted_at_utc")).isNotNull()).count()
    assert w.agg(F.sum("posts")).first()[0] == want
    ev = spark.read.parquet(f"{SF}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    ev.write.parquet(f"{tmp_path}/ev")
    s = drain(ingest.sessions(spark.readStream.schema(ev.schema).parquet(f"{tmp_path}/ev"), "user_id", "ts", "30 minutes"), "sess", "complete")
    assert s.agg(F.sum("n")).first()[0] == ev.count()


def test_chunks_and_session(spark):
    got = S.chunk(spark.range(1000).withColumn("x", F.hash("id")), ["x", "id"], 64)
    assert [r.n for r in got.groupBy("chunk_no").agg(F.count("*").alias("n")).orderBy("chunk_no").collect()] == [64] * 15 + [40]
    assert got.orderBy("x", "id").select("row_no").first()[0] == 1
    assert ensure_checkpoint_dir(build_session())
