"""Queries of the post pipeline's own operators over whole tables, each with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postweave.functions import contacts as C
from postweave.functions import lines as L
from postweave.functions import text as T
from postweave.operators import bounds as B
from postweave.operators import decisions as D
from postweave.operators import entities as E
from postweave.operators import merge as M
from postweave.operators import posts as P
from postweave.operators import review as R
from postweave.operators import tables as S
from postweave.plans import contact_sql as Q
from postweave.plans import views as V
from postweave.session import kept, table
from postweave.sources import files
from postweave.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
AS_OF = "2026-10-25 00:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp")


# DuckDB forms of the shared expressions.
_NORM = r"""trim(regexp_replace(regexp_replace(translate(regexp_replace(coalesce({c}, ''), '([0-9])\x{{fe0f}}\x{{20e3}}', '\1', 'g'), '⓪①②③④⑤⑥⑦⑧⑨٠١٢٣٤٥٦٧٨٩', '01234567890123456789'), '[\x{{200b}}-\x{{200f}}\x{{2060}}\x{{feff}}]', '', 'g'), '[\t-\r\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))"""
norm = lambda c: _NORM.format(c=c)
_FRESH = "CASE WHEN {c} >= TIMESTAMPTZ '2026-10-25 00:00:00+00' - INTERVAL 7 DAY THEN 'fresh_0_7d' WHEN {c} >= TIMESTAMPTZ '2026-10-25 00:00:00+00' - INTERVAL 30 DAY THEN 'recent_8_30d' WHEN {c} >= TIMESTAMPTZ '2026-10-25 00:00:00+00' - INTERVAL 90 DAY THEN 'aging_31_90d' ELSE 'stale_91d_plus' END"
fresh = lambda c: _FRESH.format(c=c)
_LIST = "list_filter(list_transform(string_split(coalesce({c}, ''), '|'), lambda x: trim(x)), lambda x: x <> '')"


@query(Q.structured_posts())
def structured_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signal of every post in one narrow stage, lists as text."""
    s = P.structure(table(spark, sf_dir, "raw_posts", True))
    flat = lambda c, name: F.array_join(c, "|").alias(name)
    hints = F.transform("hints", lambda h: F.concat_ws(":", h["code"], h["score"].cast("string"), h["confidence"]))
    kinds = {"phone": "phones", "email": "emails", "telegram_handle": "handles", "telegram_link": "links", "website": "websites"}
    return s.select(
        "raw_post_id", "source_channel_key", "posted_at_utc", "_run_id", "text_raw", "text_norm", "text_hash", *[flat(f"contacts.{k}", n) for k, n in kinds.items()], flat(hints, "hints"), T.or_empty(F.col("city.city")).alias("city"),
        flat("prices", "prices"), flat("currencies", "currencies"), flat("identity", "identity"), flat("flags", "flags"), flat("tokens", "tokens"),
        *[f"author.{c}" for c in ("sender_id", "sender_kind", "sender_title", "sender_username", "sender_profile_url", "post_author")],
    )


@query(f"SELECT post_key, _run_id, {norm('text')} AS text_norm, sha1(lower({norm('text')})) AS text_hash, count(*) AS n FROM raw_posts GROUP BY 1, 2, 3, 4")
def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "raw_posts", True).select("post_key", "_run_id", T.normalize_text(F.col("text")).alias("text_norm"), T.text_hash(F.col("text")).alias("text_hash"))
    return t.groupBy("post_key", "_run_id", "text_norm", "text_hash").agg(F.count("*").alias("n"))


@query(r"SELECT provider_key, d AS phone_digits, regexp_replace(lower(trim(coalesce(primary_contact_value, ''))), '^@', '') AS contact, sha1(concat(coalesce(provider_key, ''), chr(31), coalesce(canonical_name, ''))) AS key_hash FROM (SELECT *, CASE WHEN length(x) >= 8 THEN x ELSE '' END AS d FROM (SELECT *, regexp_replace(coalesce(primary_contact_value, ''), '[^0-9]', '', 'g') AS x FROM providers))")
def normalized_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("primary_contact_value")
    return table(spark, sf_dir, "providers").select("provider_key", T.normalize_phone(c).alias("phone_digits"), F.regexp_replace(F.lower(F.trim(T.or_empty(c))), "^@", "").alias("contact"), T.stable_hash(F.col("provider_key"), F.col("canonical_name")).alias("key_hash"))


@query(r"""SELECT link, count(*) AS n, count(DISTINCT post_key) AS posts FROM (SELECT post_key, unnest(regexp_extract_all(coalesce(text, '') || ' ' || coalesce(post_url, ''), '(?i)https?://t\.me/[A-Za-z0-9_+/]+')) AS link FROM raw_posts) GROUP BY link""")
def post_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" ", T.or_empty(F.col("text")), T.or_empty(F.col("post_url")))
    rows = table(spark, sf_dir, "raw_posts", True).select("post_key", F.explode(F.regexp_extract_all(text, F.lit(C.LINK), F.lit(0))).alias("link"))
    return rows.groupBy("link").agg(F.count("*").alias("n"), F.countDistinct("post_key").alias("posts"))


@query(Q.contact_matches())
def contact_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contacts of the posts, by kind and value."""
    rows = table(spark, sf_dir, "raw_posts", True).select("post_key", F.explode(C.contact_matches(F.col("text"))).alias("m"))
    return rows.groupBy("m.kind", "m.value").agg(F.count("*").alias("n"), F.countDistinct("post_key").alias("posts"), F.min("m.pass_no").alias("pass_no"))


@query("SELECT city, count(*) AS posts FROM (SELECT CASE WHEN contains(t, 'белград') OR contains(t, 'belgrade') OR contains(t, 'beograd') THEN 'belgrade' WHEN contains(t, 'нови сад') OR contains(t, 'novi sad') THEN 'novi_sad' WHEN contains(t, 'ниш') OR contains(t, 'niš') OR contains(t, 'nis') THEN 'nis' WHEN contains(t, 'суботица') OR contains(t, 'subotica') THEN 'subotica' END AS city FROM (SELECT lower(" + norm("text") + ") AS t FROM raw_posts)) GROUP BY city")
def posts_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_posts", True).select(C.city_signal(F.col("text"))["city"].alias("city"))
    return rows.groupBy("city").agg(F.count("*").alias("posts"))


def _category_sql() -> str:
    t = norm("text")
    one = [f"SELECT post_key, '{code}' AS code, " + " + ".join(f"contains(t, '{w}')::INT" for w in words) + "".join(f" - contains(t, '{v}')::INT" for v in C.CATEGORY_VETOES.get(code, ())) + " AS score FROM x" for code, words in C.CATEGORIES.items()]
    return f"""WITH x AS (SELECT post_key, _run_id, lower({t}) AS t FROM raw_posts), s AS ({' UNION ALL '.join(one)})
    SELECT code, count(*) AS posts, sum(score)::BIGINT AS score, max(score)::INT AS best FROM s WHERE score > 0 GROUP BY code"""


@query(_category_sql())
def category_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word scores of the categories before the hashtag and best-score rules."""
    one = lambda low: F.array(*[F.struct(F.lit(code).alias("code"), (T.count_phrases(low, words) - T.count_phrases(low, C.CATEGORY_VETOES.get(code, ()))).alias("score")) for code, words in C.CATEGORIES.items()])
    rows = table(spark, sf_dir, "raw_posts", True).select(F.explode(T.let(F.lower(T.normalize_text(F.col("text"))), one)).alias("s")).select("s.*").where("score > 0")
    return rows.groupBy("code").agg(F.count("*").alias("posts"), F.sum("score").alias("score"), F.max("score").alias("best"))


@query("""SELECT post_key, _run_id, count(*) AS n, min(strftime(l, '%Y-%m')) AS year_month, min(strftime(l, '%G-W%V')) AS iso_week, min(strftime(l, '%d')) AS day, min(length(coalesce(text, ''))) AS true_length, bool_or(coalesce(has_media, false)) AS is_media
FROM (SELECT *, try_cast(trim(posted_at_utc) AS TIMESTAMPTZ) AT TIME ZONE 'Europe/Belgrade' AS l FROM raw_posts) GROUP BY 1, 2""")
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.shape_rows(table(spark, sf_dir, "raw_posts"))
    return rows.groupBy("post_key", "_run_id").agg(F.count("*").alias("n"), F.min("local_year_month").alias("year_month"), F.min("local_iso_week").alias("iso_week"), F.min("local_day").alias("day"), F.min("true_length").alias("true_length"), F.bool_or("is_media").alias("is_media"))


@query("""SELECT chat_id, count(*) AS seen, count(DISTINCT post_key) AS emitted, count(*) - count(DISTINCT post_key) AS duplicates, min(message_id) AS min_id, max(message_id) AS max_id, min(try_cast(trim(posted_at_utc) AS TIMESTAMPTZ)) AS oldest, max(try_cast(trim(posted_at_utc) AS TIMESTAMPTZ)) AS newest FROM raw_posts GROUP BY chat_id""")
def scan_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.scan_stats(table(spark, sf_dir, "raw_posts"))


@query("SELECT v.raw_post_id AS post_key, CASE WHEN p.post_key IS NULL THEN 'missing' ELSE 'fetched' END AS status FROM (SELECT DISTINCT raw_post_id FROM review_posts) v LEFT JOIN (SELECT DISTINCT post_key FROM raw_posts) p ON p.post_key = v.raw_post_id")
def exact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "review_posts").select(F.col("raw_post_id").alias("post_key")).distinct()
    return P.lookup(wanted, table(spark, sf_dir, "raw_posts"))


@query("SELECT post_key, max(_run_id) AS last_run_id, count(*) AS fetches FROM raw_posts WHERE coalesce(post_key, '') <> '' GROUP BY post_key")
def last_fetch_per_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "raw_posts").select("post_key", "_run_id", "views")
    return P.last_by_key(posts, ["post_key"], ["_run_id", "views"], "fetches").select("post_key", F.col("_run_id").alias("last_run_id"), "fetches")


@query(f"SELECT o.offer_key, o.provider_key, coalesce(nullif(p.canonical_name, ''), nullif(p.display_name_best, ''), o.provider_key) AS provider_display_name, o.offer_state, o.category_primary, o.price_min, o.currency_code, o.last_seen_at_utc, o.dedupe_confidence, {fresh('o.last_seen_at_utc')} AS freshness_bucket FROM offers o JOIN providers p ON p.provider_key = o.provider_key")
def offers_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = V.offers_catalog(table(spark, sf_dir, "offers"), table(spark, sf_dir, "providers"), _as_of())
    return v.select("offer_key", "provider_key", "provider_display_name", "offer_state", "category_primary", "price_min", "currency_code", "last_seen_at_utc", "dedupe_confidence", "freshness_bucket")


@query("SELECT p.provider_key, p.provider_state, p.identity_strength, coalesce(o.n, 0) AS offers_total, o.latest_offer_at, coalesce(o.keys, '') AS offer_keys FROM providers p LEFT JOIN (SELECT provider_key, count(*) AS n, max(last_seen_at_utc) AS latest_offer_at, string_agg(offer_key, ',' ORDER BY last_seen_at_utc DESC NULLS LAST, offer_key) AS keys FROM offers GROUP BY provider_key) o ON o.provider_key = p.provider_key")
def providers_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = V.providers_directory(table(spark, sf_dir, "providers"), table(spark, sf_dir, "offers"))
    return v.select("provider_key", "provider_state", "identity_strength", "offers_total", "latest_offer_at", F.array_join(F.transform("offers", lambda x: x["offer_key"]), ",").alias("offer_keys"))


@query("SELECT r.run_id, r.run_status, r.trigger_type, r.duration_ms, r.finished_at_utc IS NULL AS unfinished, coalesce(nullif(r.error_message, ''), nullif(r.error_type, ''), '') AS error, coalesce(p.posts, 0) AS posts, coalesce(p.distinct_posts, 0) AS distinct_posts, coalesce(p.targets, 0) AS targets, coalesce(p.views, 0)::BIGINT AS views FROM service_runs r LEFT JOIN (SELECT _run_id, count(*) AS posts, count(DISTINCT post_key) AS distinct_posts, count(DISTINCT chat_id) AS targets, sum(coalesce(views, 0)) AS views FROM raw_posts GROUP BY _run_id) p ON p._run_id = r.run_id")
def run_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.run_monitoring(table(spark, sf_dir, "service_runs"), table(spark, sf_dir, "raw_posts")).drop("started_at_utc", "finished_at_utc")


@query("SELECT v.raw_post_id, v.run_id, r.run_status AS review_run_status, p.last_run AS stored_run_id, coalesce(p.fetches, 0) AS fetches, p.fetches IS NOT NULL AS is_stored FROM review_posts v LEFT JOIN (SELECT post_key, max(_run_id) AS last_run, count(*) AS fetches FROM raw_posts GROUP BY post_key) p ON p.post_key = v.raw_post_id LEFT JOIN service_runs r ON r.run_id = v.run_id")
def review_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.review_drilldown(table(spark, sf_dir, "review_posts"), table(spark, sf_dir, "raw_posts"), table(spark, sf_dir, "service_runs")).drop("chat_title")


def _family(name: str, src: str, by: dict[str, str], latest: str = "last_seen_at_utc") -> str:
    cols = ", ".join(f"{by.get(c, chr(39) * 2)} AS {c}" for c in ("bucket", "offer_state", "provider_state", "identity_strength", "category", "city", "status"))
    return f"SELECT '{name}' AS metric_family, {cols}, count(*) AS metric_value, max({latest}) AS latest_at, NULL::BIGINT AS raw_posts_total, NULL::BIGINT AS providers_total, NULL::BIGINT AS offers_total FROM {src} GROUP BY {', '.join(by.values())}"


def _coverage_sql() -> str:
    city = lambda t: f"(SELECT *, unnest(CASE WHEN len(l) = 0 THEN ['unknown'] ELSE list_distinct(l) END) AS city1 FROM (SELECT *, {_LIST.format(c='city_codes')} AS l FROM {t}))"
    o, p = f"(SELECT *, {fresh('last_seen_at_utc')} AS f FROM offers)", f"(SELECT *, {fresh('last_seen_at_utc')} AS f FROM providers)"
    c = f"(SELECT *, coalesce(nullif(category_primary, ''), 'uncategorized') AS c1 FROM offers)"
    return " UNION ALL ".join([
        _family("offer_freshness", o, {"bucket": "f", "offer_state": "offer_state"}), _family("provider_freshness", p, {"bucket": "f", "provider_state": "provider_state", "identity_strength": "identity_strength"}),
        _family("offer_category_coverage", c, {"category": "c1", "offer_state": "offer_state"}), _family("offer_city_coverage", city("offers"), {"city": "city1", "offer_state": "offer_state"}),
        _family("provider_city_coverage", city("providers"), {"city": "city1", "provider_state": "provider_state", "identity_strength": "identity_strength"}),
        _family("run_target_coverage", "service_runs", {"status": "run_status"}, "started_at_utc"),
        "SELECT 'run_summary', '', '', '', '', '', '', '', count(*), max(started_at_utc), (SELECT count(*) FROM raw_posts), (SELECT count(*) FROM providers), (SELECT count(*) FROM offers) FROM service_runs",
    ])


@query(_coverage_sql())
def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.coverage_metrics(*[table(spark, sf_dir, t) for t in ("offers", "providers", "service_runs", "raw_posts")], _as_of())


@query("""WITH n AS (SELECT provider_key, category_primary AS v, count(*) AS n FROM offers WHERE coalesce(category_primary, '') <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY provider_key ORDER BY n DESC, length(v) DESC, lower(v), v) AS rn FROM n) SELECT provider_key, v AS mode, n FROM r WHERE rn = 1""")
def provider_category_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.most_common(table(spark, sf_dir, "offers"), "provider_key", "category_primary")


@query("""SELECT provider_key, arg_min(offer_key, (first_seen_at_utc, offer_key)) AS first_value, arg_max(offer_key, (first_seen_at_utc, offer_key)) AS last_value, min(first_seen_at_utc) AS first_at, max(first_seen_at_utc) AS last_at, count(*) AS n FROM offers GROUP BY provider_key""")
def provider_first_last_offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.first_and_last(table(spark, sf_dir, "offers"), "provider_key", "first_seen_at_utc", "offer_key", "offer_key")


@query(f"""SELECT provider_key, list_sort(list_distinct(flatten(list(c)))) AS cities, list_sort(list_distinct(flatten(list(s)))) AS channels FROM (SELECT provider_key, {_LIST.format(c='city_codes')} AS c, {_LIST.format(c='source_channel_keys')} AS s FROM offers) GROUP BY provider_key""")
def provider_value_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.union_values(table(spark, sf_dir, "offers"), "provider_key", cities=T.packed_list(F.col("city_codes")), channels=T.packed_list(F.col("source_channel_keys")))


_TOKENS = "list_distinct(list_filter(regexp_extract_all(lower(" + norm("{c}") + "), '[0-9a-zа-яё]+'), lambda x: length(x) >= 3 AND NOT regexp_full_match(x, '[0-9]+') AND NOT list_contains([" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "], x)))"


def tokens_sql(c: str) -> str:
    return _TOKENS.replace("{c}", c)


@query(f"""WITH w AS (SELECT provider_key AS c, unnest({tokens_sql('title_best')}) AS word FROM offers), n AS (SELECT provider_key AS c, count(*) AS total FROM offers GROUP BY 1), k AS (SELECT w.c, word, count(*) AS n, any_value(total) AS total FROM w JOIN n ON n.c = w.c GROUP BY 1, 2), r AS (SELECT c, word, n, row_number() OVER (PARTITION BY c ORDER BY n DESC, word) AS rank FROM k WHERE n >= greatest(1, floor(total / 2))) SELECT c AS provider_key, word, n, rank FROM r WHERE rank <= 10""")
def provider_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.top_words(table(spark, sf_dir, "offers"), "provider_key", T.tokens(F.col("title_best")))


def _pairs_sql(src: str, key: str, text: str, least: float, within: str = "''") -> str:
    """Pairs of classes of one word set, each by its smallest key."""
    share = "len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w)))"
    return f"""WITH t AS (SELECT g, w, min(k) AS k FROM (SELECT {within} AS g, {key} AS k, list_sort({tokens_sql(text)}) AS w FROM {src}) WHERE len(w) > 0 GROUP BY g, w), x AS (SELECT g, k, unnest(w) AS t FROM t),
    c AS (SELECT DISTINCT a.k AS l, b.k AS r FROM x a JOIN x b ON a.g = b.g AND a.t = b.t AND a.k < b.k) SELECT l AS left_key, r AS right_key, {share} AS similarity FROM c JOIN t a ON a.k = l JOIN t b ON b.k = r WHERE {share} >= {least}"""


@query(_pairs_sql("providers", "provider_key", "canonical_name", 0.7))
def similar_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of name classes that share seven tenths of their words."""
    return M.similar_pairs(table(spark, sf_dir, "providers"), "provider_key", T.tokens(F.col("canonical_name")), 0.7)


@query(f"""WITH t AS (SELECT provider_key, list_sort({tokens_sql('canonical_name')}) AS w FROM providers) SELECT provider_key, min(provider_key) OVER (PARTITION BY w) AS class_key FROM t WHERE len(w) > 0""")
def provider_name_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each provider's name."""
    return M.word_classes(table(spark, sf_dir, "providers"), "provider_key", T.tokens(F.col("canonical_name")))


@query(_pairs_sql("offers", "offer_key", "title_best", 0.75, "provider_key"))
def similar_offers_of_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of title classes of one provider that share three quarters of their words."""
    return M.similar_pairs(table(spark, sf_dir, "offers"), "offer_key", T.tokens(F.col("title_best")), 0.75, "provider_key")


@query(f"""WITH t AS (SELECT offer_key, provider_key, list_sort({tokens_sql('title_best')}) AS w FROM offers) SELECT offer_key, min(offer_key) OVER (PARTITION BY provider_key, w) AS class_key FROM t WHERE len(w) > 0 AND provider_key IS NOT NULL""")
def offer_title_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each offer's title within its provider."""
    return M.word_classes(table(spark, sf_dir, "offers"), "offer_key", T.tokens(F.col("title_best")), "provider_key")


@query("""WITH e AS (SELECT event_id, user_id, ts FROM events), p AS (SELECT a.event_id AS left_key, b.event_id AS right_key, round(abs(epoch_us(a.ts) - epoch_us(b.ts)) / 1000000.0, 6) AS gap, b.ts FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 3600000000), r AS (SELECT *, row_number() OVER (PARTITION BY left_key ORDER BY gap, ts, right_key) AS rn FROM p) SELECT left_key, right_key, gap FROM r WHERE rn = 1""")
def nearest_event_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return M.nearest_in_time(e, e, ["user_id"], "ts", 3600.0, "event_id")


@query("""WITH n AS (SELECT offer_key, max(last_seen_at_utc) AS l, max(times_seen) AS t, min(first_seen_run_id) AS f, min(provider_key) AS p FROM offer_batches GROUP BY offer_key) SELECT coalesce(o.offer_key, n.offer_key) AS offer_key, CASE WHEN o.offer_key IS NULL THEN n.p ELSE o.provider_key END AS provider_key, CASE WHEN o.offer_key IS NULL THEN n.f ELSE o.first_seen_run_id END AS first_seen_run_id, CASE WHEN n.offer_key IS NULL THEN o.last_seen_at_utc ELSE n.l END AS last_seen_at_utc, CASE WHEN n.offer_key IS NULL THEN o.times_seen ELSE n.t END AS times_seen FROM offers o FULL OUTER JOIN n ON n.offer_key = o.offer_key""")
def upserted_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch into the offers: the first sighting and the provider stay, the last sighting moves."""
    cols = ["offer_key", "provider_key", "first_seen_run_id", "last_seen_at_utc", "times_seen"]
    new = table(spark, sf_dir, "offer_batches").groupBy("offer_key").agg(F.min("provider_key").alias("provider_key"), F.min("first_seen_run_id").alias("first_seen_run_id"), F.max("last_seen_at_utc").alias("last_seen_at_utc"), F.max("times_seen").alias("times_seen"))
    return S.upsert(table(spark, sf_dir, "offers").select(*cols), new, ["offer_key"], ["last_seen_at_utc", "times_seen"])


@query("SELECT offer_key, provider_key FROM offers UNION ALL SELECT offer_key, min(provider_key) FROM offer_batches b WHERE NOT EXISTS (SELECT 1 FROM offers o WHERE o.offer_key = b.offer_key) GROUP BY offer_key")
def inserted_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "offer_batches").groupBy("offer_key").agg(F.min("provider_key").alias("provider_key"))
    return S.insert_or_ignore(table(spark, sf_dir, "offers").select("offer_key", "provider_key"), new, ["offer_key"])


@query("""SELECT 'key_filled' AS rule, count_if(NOT coalesce(offer_key <> '', false)) AS violations FROM offers UNION ALL SELECT 'state_known', count_if(NOT coalesce(offer_state IN ('accepted', 'candidate', 'rejected', 'suppressed'), false)) FROM offers UNION ALL SELECT 'price_not_negative', count_if(NOT coalesce(price_min >= 0, true)) FROM offers UNION ALL SELECT 'price_order', count_if(NOT coalesce(price_max >= price_min, true)) FROM offers UNION ALL SELECT 'seen_order', count_if(NOT coalesce(last_seen_at_utc >= first_seen_at_utc, false)) FROM offers UNION ALL SELECT 'unique(offer_key)', count(*) FROM (SELECT offer_key FROM offers GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'provider_known', count(*) FROM offers o WHERE coalesce(provider_key, '') <> '' AND NOT EXISTS (SELECT 1 FROM providers p WHERE p.provider_key = o.provider_key)""")
def offer_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "offers")
    true = F.lit(True)
    checks = {
        "key_filled": F.col("offer_key") != "", "state_known": F.col("offer_state").isin("accepted", "candidate", "rejected", "suppressed"),
        "price_not_negative": F.coalesce(F.col("price_min") >= 0, true), "price_order": F.coalesce(F.col("price_max") >= F.col("price_min"), true),
        "seen_order": F.col("last_seen_at_utc") >= F.col("first_seen_at_utc"),
    }
    lost = S.orphans(o, table(spark, sf_dir, "providers"), "provider_key", "provider_key").agg(F.count("*").alias("violations"))
    return S.violations(o, checks, ["offer_key"]).unionAll(lost.select(F.lit("provider_known"), "violations"))


@query("""SELECT batch_row_id, spent, calls, CASE WHEN spent > 2000 THEN 'stopped' WHEN spent > 500 THEN 'soft_exceeded' ELSE 'ok' END AS budget FROM (SELECT batch_row_id, sum(coalesce(times_seen, 0)) OVER w AS spent, count(*) OVER w AS calls FROM offer_batches WINDOW w AS (PARTITION BY run_id, source_channel_keys ORDER BY batch_row_id ROWS UNBOUNDED PRECEDING))""")
def batch_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "offer_batches").select("batch_row_id", "run_id", "source_channel_keys", F.coalesce("times_seen", F.lit(0)).alias("cost")).withColumn("g", F.concat_ws("|", "run_id", F.coalesce("source_channel_keys", F.lit("\x00"))))
    return S.running_budget(b, "g", ["batch_row_id"], "cost", 500, 2000).select("batch_row_id", "spent", "calls", "budget")


@query("SELECT batch_row_id, row_number() OVER (ORDER BY batch_row_id) AS row_no, (row_number() OVER (ORDER BY batch_row_id) - 1) // 500 AS chunk_no FROM offer_batches")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.chunk(table(spark, sf_dir, "offer_batches").select("batch_row_id"), ["batch_row_id"], 500)


@query("""SELECT o.offer_key, coalesce(b.t, o.title_best) AS title_best, coalesce(b.p, o.price_text_best) AS price_text_best, array_to_string(list_concat(CASE WHEN b.t IS NOT NULL AND b.t IS DISTINCT FROM o.title_best THEN ['title_best'] ELSE [] END, CASE WHEN b.p IS NOT NULL AND b.p IS DISTINCT FROM o.price_text_best THEN ['price_text_best'] ELSE [] END), ',') AS changed FROM offers o LEFT JOIN (SELECT offer_key, min(title_best) AS t, min(price_text_best) AS p FROM offer_batches GROUP BY 1) b ON b.offer_key = o.offer_key""")
def patched_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    patch = table(spark, sf_dir, "offer_batches").groupBy("offer_key").agg(F.min("title_best").alias("title_best"), F.min("price_text_best").alias("price_text_best"))
    got = S.apply_patches(table(spark, sf_dir, "offers").select("offer_key", "title_best", "price_text_best"), patch, "offer_key", ["title_best", "price_text_best"])
    return got.withColumn("changed", F.array_join("changed", ","))


@query("""SELECT decision, verdict, count(*) AS n, round(avg(score), 6) AS mean FROM (SELECT decision, score, CASE WHEN score >= 0.75 THEN 'accept' WHEN score >= 0.70 AND decision = 'match' THEN 'recover' ELSE 'reject' END AS verdict FROM provider_matches) GROUP BY 1, 2""")
def match_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "provider_matches")
    v = m.select("decision", "score", S.decide(F.col("score"), 0.75, 0.70, F.col("decision") == "match").alias("verdict"))
    return v.groupBy("decision", "verdict").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"))


@query("SELECT post_key, min(_run_id) AS first_seen_run_id, max(_run_id) AS last_seen_run_id, count(*) AS times_seen FROM raw_posts WHERE coalesce(post_key, '') <> '' GROUP BY post_key")
def post_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.sightings(table(spark, sf_dir, "raw_posts")).drop("views", "text")


@query("""SELECT user_id, min(ts) AS started_at, max(ts) AS last_at, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    got = e.groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("last_at"), F.count("*").alias("n"))
    return got.select("user_id", "started_at", "last_at", "n")


@query("""SELECT o.offer_key, coalesce(title_best, '') AS title, coalesce(category_primary, '') AS category, coalesce(CASE lower(trim(city_codes)) WHEN 'belgrade' THEN 'Београд' WHEN 'novi_sad' THEN 'Нови Сад' END, city_codes, '') AS city, p.display_name_best AS provider, strftime(o.last_seen_at_utc AT TIME ZONE 'Europe/Belgrade', '%d.%m.%Y') AS last_seen FROM (SELECT offer_key, provider_key, title_best, category_primary, city_codes, last_seen_at_utc FROM offers WHERE offer_state = 'accepted') o LEFT JOIN providers p USING (provider_key)""".replace("lower(trim(city_codes))", "lower(trim(o.city_codes))").replace(", city_codes, '')", ", o.city_codes, '')"))
def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = files.spreadsheet_rows(table(spark, sf_dir, "offers"), table(spark, sf_dir, "providers"), {"belgrade": "Београд", "novi_sad": "Нови Сад"})
    return got.select("offer_key", "title", "category", "city", "provider", "last_seen")


@query(Q.provider_clusters())
def provider_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts joined to providers by shared identity keys."""
    return M.provider_clusters(P.structure(table(spark, sf_dir, "raw_posts", True)))


@query(Q.offer_clusters())
def offer_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts joined to offers within their provider."""
    s = P.structure(table(spark, sf_dir, "raw_posts", True)).where("raw_post_id <> ''")
    s = kept(s.select("raw_post_id", "text_hash", "tokens", F.col("hints.code").alias("categories"), "source_channel_key", "posted_at_utc", "_run_id", (F.col("text_norm") != "").alias("has_text"), "identity"))
    # One fetch of a post stands for all: with a text, a time and a channel if any has them, then the last.
    of = F.struct("text_hash", "tokens", "categories", F.col("source_channel_key").alias("channel"), "posted_at_utc")
    order = F.struct("has_text", P.parse_instant(F.col("posted_at_utc")).isNotNull(), F.col("source_channel_key") != "", "_run_id", "text_hash", "posted_at_utc", "source_channel_key")
    posts = M.word_ids(s, "tokens").groupBy("raw_post_id").agg(F.max_by(of, order).alias("x")).select("raw_post_id", "x.*")
    return M.offer_clusters(posts.join(M.provider_clusters(s), "raw_post_id"))


@query("""WITH RECURSIVE e AS (SELECT left_provider_key AS a, right_provider_key AS b FROM provider_matches WHERE decision = 'match' UNION SELECT right_provider_key, left_provider_key FROM provider_matches WHERE decision = 'match'), r AS (SELECT a, a AS c FROM e UNION SELECT e.a, r.c FROM e JOIN r ON r.a = e.b) SELECT a AS id, min(c) AS component FROM r WHERE a IS NOT NULL GROUP BY a""")
def match_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "provider_matches").where("decision = 'match'")
    return M.components(m.select(F.col("left_provider_key").alias("a"), F.col("right_provider_key").alias("b")))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY 1, 2""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(DISTINCT o_orderkey) AS orders FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name""")
def local_supplier_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t("supplier"), (F.col("s_suppkey") == F.col("l_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey"))).join(t("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.countDistinct("o_orderkey").alias("orders"))


@query("""SELECT c_custkey, o_orderkey, o_totalprice, rank FROM (SELECT c_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM customer JOIN orders ON o_custkey = c_custkey) WHERE rank <= 3""")
def top_orders_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"))
    w = Window.partitionBy("c_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return j.withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("c_custkey", "o_orderkey", "o_totalprice", "rank")


@query("""SELECT chat_id AS source_key, max(message_id) AS upper_id, min(message_id) AS lower_id, min(try_cast(trim(posted_at_utc) AS TIMESTAMPTZ)) AS oldest_at, max(try_cast(trim(posted_at_utc) AS TIMESTAMPTZ)) AS newest_at, count(*) AS posts, 'freeze_lower_message_id_reached' AS stop_reason FROM raw_posts WHERE coalesce(post_key, '') <> '' GROUP BY chat_id""")
def frozen_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.freeze(table(spark, sf_dir, "raw_posts"))


@query("""WITH b AS (SELECT chat_id, max(message_id) AS u, min(message_id) AS l FROM raw_posts WHERE coalesce(post_key, '') <> '' AND _run_id < 'fetch-20260901' GROUP BY 1) SELECT p.chat_id, count(*) AS posts, count_if(p.message_id > b.u) AS newer, count_if(p.message_id BETWEEN b.l AND b.u) AS replayed FROM raw_posts p JOIN b ON b.chat_id = p.chat_id GROUP BY 1""")
def replayed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later fetch cut to the bounds of an earlier one: what is replayed, what is newer."""
    posts = table(spark, sf_dir, "raw_posts")
    bounds = B.freeze(posts.where(F.col("_run_id") < "fetch-20260901"))
    n = posts.join(bounds.select(F.col("source_key").alias("chat_id")), "chat_id", "left_semi").groupBy("chat_id").agg(F.count("*").alias("posts"))
    new = B.newer_than(posts, bounds).groupBy("chat_id").agg(F.count("*").alias("newer"))
    # The SQL bounds by ids only.
    old = B.replay(posts, bounds.select("source_key", "upper_id", "lower_id")).groupBy("chat_id").agg(F.count("*").alias("replayed"))
    zero = F.lit(0).cast("bigint")
    return n.join(new, "chat_id", "left").join(old, "chat_id", "left").select("chat_id", "posts", F.coalesce("newer", zero).alias("newer"), F.coalesce("replayed", zero).alias("replayed"))


@query("SELECT sender_id, max(_run_id) AS last_run_id, count(*) AS posts FROM raw_posts WHERE coalesce(sender_id, '') <> '' GROUP BY sender_id")
def sender_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = table(spark, sf_dir, "raw_posts")
    last = posts.groupBy("sender_id").agg(F.max("_run_id").alias("last_run_id"))
    return B.senders(posts).select("sender_id", "posts").join(last, "sender_id")


@query(Q.fact_packs())
def fact_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, details and quality of every post."""
    return table(spark, sf_dir, "raw_posts", True).select("post_key", "_run_id", L.fact_pack(F.col("text")).alias("f")).select("post_key", "_run_id", "f.*")


@query(f"""SELECT provider_key, arg_min(title_best, (-len({tokens_sql('title_best')}), -length(title_best), first_seen_at_utc, title_best)) AS title_best FROM offers WHERE coalesce(title_best, '') <> '' GROUP BY provider_key""")
def provider_best_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.best_text(table(spark, sf_dir, "offers"), "provider_key", "title_best", "first_seen_at_utc")


@query("SELECT category_primary, count(*) AS total, count_if(offer_state = 'accepted') AS accepted, count_if(offer_state = 'candidate') AS candidate, count_if(offer_state = 'rejected') AS rejected, count_if(offer_state = 'suppressed') AS suppressed FROM offers GROUP BY category_primary")
def state_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.stage_counters(table(spark, sf_dir, "offers"), "category_primary", "offer_state", ("accepted", "candidate", "rejected", "suppressed"))


@query("""SELECT run_id, count(*) AS total, count_if(offer_key IN (SELECT offer_key FROM offers)) AS accepted, CASE WHEN count(*) = count_if(offer_key IN (SELECT offer_key FROM offers)) THEN 'complete' ELSE 'incomplete' END AS coverage FROM offer_batches GROUP BY run_id""")
def batch_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which batches bring known keys only."""
    known = table(spark, sf_dir, "offers").select("offer_key").distinct().withColumn("k", F.lit(1))
    got = table(spark, sf_dir, "offer_batches").select("run_id", "offer_key").join(known, "offer_key", "left").groupBy("run_id").agg(F.count("*").alias("total"), F.count("k").alias("accepted"))
    return got.withColumn("coverage", D.coverage(F.col("total"), F.col("accepted"), F.lit(0), F.lit("")))


@query("""SELECT offer_state, category_primary, count(*) AS n FROM offers GROUP BY CUBE (offer_state, category_primary)""")
def offer_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "offers").cube("offer_state", "category_primary").agg(F.count("*").alias("n"))


@query("""SELECT coalesce(a.k, b.k) AS post_key, CASE WHEN a.k IS NULL THEN 'review_only' WHEN b.k IS NULL THEN 'posts_only' ELSE 'both' END AS side FROM (SELECT DISTINCT post_key AS k FROM raw_posts) a FULL OUTER JOIN (SELECT DISTINCT raw_post_id AS k FROM review_posts) b ON a.k = b.k""")
def key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symmetric comparison of two key sets."""
    a = table(spark, sf_dir, "raw_posts").select("post_key").distinct().withColumn("in_a", F.lit(True))
    b = table(spark, sf_dir, "review_posts").select(F.col("raw_post_id").alias("post_key")).distinct().withColumn("in_b", F.lit(True))
    side = F.when(F.col("in_a").isNull(), "review_only").when(F.col("in_b").isNull(), "posts_only").otherwise("both")
    return a.join(b, "post_key", "full_outer").select("post_key", side.alias("side"))


_CELL = "list_sort(list_distinct(list_filter(list_transform(string_split({c}, '|'), lambda x: trim(x)), lambda x: x <> '')))"


def _offer_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offers as posts of their entities."""
    o = table(spark, sf_dir, "offers")
    code = F.lower(F.trim(T.or_empty(F.col("currency_code"))))
    return o.withColumns({
        "entity": T.first_filled(F.col("offer_merge_override_group"), F.col("offer_key")), "prices": F.array_compact(F.array(F.when(T.or_empty(F.col("price_text_best")) != "", F.col("price_text_best")))),
        "currencies": F.array_compact(F.array(F.when(code != "", code))), "hash": T.text_hash(F.col("description_best")),
    })


@query(f"""WITH o AS (SELECT * FROM offers WHERE provider_key IS NOT NULL),
 b AS (SELECT provider_key, count(DISTINCT offer_key) AS times_seen, arg_min(last_seen_at_utc, {{'x': last_seen_at_utc IS NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS first_seen_at_utc, arg_max(last_seen_at_utc, {{'x': last_seen_at_utc IS NOT NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS last_seen_at_utc,
   arg_min(first_seen_run_id, {{'x': last_seen_at_utc IS NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS first_seen_run_id, arg_max(first_seen_run_id, {{'x': last_seen_at_utc IS NOT NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS last_seen_run_id, arg_max(latest_post_url, {{'x': last_seen_at_utc IS NOT NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS latest_post_url FROM o GROUP BY 1),
 items AS (SELECT provider_key, 'city' AS f, unnest(string_split(coalesce(city_codes, ''), '|')) AS v FROM o UNION ALL SELECT provider_key, 'channel', unnest(string_split(coalesce(source_channel_keys, ''), '|')) FROM o
   UNION ALL SELECT provider_key, 'phone', unnest(list_filter(list_transform(string_split(coalesce(contact_snapshot_phones, ''), '|'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: length(x) >= 8)) FROM o),
 u AS (SELECT provider_key, string_agg(DISTINCT trim(v), '|' ORDER BY trim(v)) FILTER (f = 'city') AS city_codes, string_agg(DISTINCT trim(v), '|' ORDER BY trim(v)) FILTER (f = 'channel') AS source_channel_keys, list_sort(list_distinct(list(trim(v)) FILTER (f = 'phone'))) AS phones FROM items WHERE trim(v) <> '' GROUP BY 1),
 c AS (SELECT provider_key, string_agg(code, '|' ORDER BY n DESC, code) AS categories FROM (SELECT provider_key, category_primary AS code, count(*) AS n FROM o WHERE coalesce(category_primary, '') <> '' GROUP BY 1, 2) GROUP BY 1)
 SELECT b.*, coalesce(u.city_codes, '') AS city_codes, coalesce(u.source_channel_keys, '') AS source_channel_keys, coalesce(c.categories, '') AS categories, coalesce(array_to_string(u.phones, '|'), '') AS phones,
   CASE WHEN coalesce(len(u.phones), 0) > 0 THEN 'strong' ELSE 'provisional' END AS identity_strength, CASE WHEN coalesce(len(u.phones), 0) > 0 THEN 'phone' ELSE '' END AS primary_contact_type, coalesce(u.phones[1], '') AS primary_contact_value,
   CASE WHEN coalesce(len(u.phones), 0) > 0 THEN 'high' WHEN times_seen >= 2 THEN 'medium' ELSE 'low' END AS dedupe_confidence FROM b LEFT JOIN u USING (provider_key) LEFT JOIN c USING (provider_key)""")
def provider_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the offers of each provider say together."""
    posts = _offer_posts(spark, sf_dir).where("provider_key is not null")
    phones = F.filter(F.transform(F.split(T.or_empty(F.col("contact_snapshot_phones")), "\\|"), T.normalize_phone), lambda x: x != "")
    hints = F.array_compact(F.array(F.when(T.or_empty(F.col("category_primary")) != "", F.struct(F.col("category_primary").alias("code"), F.lit(1).alias("score")))))
    got = E.provider_entities(posts, "provider_key", "last_seen_at_utc", "offer_key", "first_seen_run_id", "latest_post_url", F.transform(phones, lambda x: F.concat(F.lit("phone:"), x)), T.packed_list(F.col("city_codes")), T.packed_list(F.col("source_channel_keys")), hints, phone=phones)
    flat = lambda c, name=None: F.array_join(c, "|").alias(name or c)
    return got.select("provider_key", "times_seen", "first_seen_at_utc", "last_seen_at_utc", "first_seen_run_id", "last_seen_run_id", "latest_post_url", flat("city_codes"), flat("source_channel_keys"), flat("categories"), flat("phone", "phones"), "identity_strength", "primary_contact_type", "primary_contact_value", "dedupe_confidence")


@query(f"""WITH o AS (SELECT *, CASE WHEN trim(coalesce(offer_merge_override_group, '')) <> '' THEN offer_merge_override_group ELSE offer_key END AS entity, sha1(lower({norm('description_best')})) AS h, lower(trim(coalesce(currency_code, ''))) AS code FROM offers),
 b AS (SELECT entity, count(DISTINCT offer_key) AS times_seen, min(last_seen_at_utc) AS first_seen_at_utc, max(last_seen_at_utc) AS last_seen_at_utc, arg_min(first_seen_run_id, {{'x': last_seen_at_utc IS NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS first_seen_run_id, arg_min(h, {{'x': last_seen_at_utc IS NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS first_h FROM o GROUP BY 1),
 n AS (SELECT entity, replace(m, ' ', '') AS m FROM (SELECT entity, unnest(regexp_extract_all(coalesce(price_text_best, ''), '([0-9][0-9\\s.,]*)', 1)) AS m FROM o)),
 v AS (SELECT entity, TRY_CAST(regexp_replace(CASE WHEN length(m) - length(replace(m, ',', '')) = 1 AND NOT contains(m, '.') THEN replace(m, ',', '.') ELSE replace(m, ',', '') END, '\\.$', '') AS DOUBLE) AS x FROM n),
 p AS (SELECT entity, round(min(x), 2) AS price_min, round(max(x), 2) AS price_max FROM v GROUP BY 1),
 t AS (SELECT entity, arg_max(price_text_best, {{'x': last_seen_at_utc IS NOT NULL, 'a': last_seen_at_utc, 'k': offer_key}}) AS price_text_best FROM o WHERE coalesce(price_text_best, '') <> '' GROUP BY 1),
 c AS (SELECT entity, arg_min(code, {{'n': -n, 'c': code}}) AS currency_code FROM (SELECT entity, code, count(*) AS n FROM o WHERE code <> '' GROUP BY 1, 2) GROUP BY 1),
 g AS (SELECT entity, string_agg(DISTINCT trim(tag), '|' ORDER BY trim(tag)) AS service_tags FROM (SELECT entity, unnest(string_split(coalesce(service_tags, ''), '|')) AS tag FROM o) WHERE trim(tag) <> '' GROUP BY 1),
 l AS (SELECT o.entity, count(DISTINCT offer_key) AS alike FROM o JOIN b ON o.entity = b.entity AND o.h = b.first_h GROUP BY 1)
 SELECT b.entity, times_seen, first_seen_at_utc, last_seen_at_utc, first_seen_run_id, price_min, price_max, coalesce(price_text_best, '') AS price_text_best, coalesce(currency_code, '') AS currency_code, coalesce(service_tags, '') AS service_tags,
   CASE WHEN times_seen >= 2 THEN CASE WHEN alike >= 2 THEN 'high' ELSE 'medium' END WHEN coalesce(service_tags, '') <> '' THEN 'medium' ELSE 'low' END AS dedupe_confidence
 FROM b LEFT JOIN p USING (entity) LEFT JOIN t USING (entity) LEFT JOIN c USING (entity) LEFT JOIN g USING (entity) LEFT JOIN l USING (entity)""")
def offer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the records of each duplicate group of offers say together."""
    got = E.offer_entities(_offer_posts(spark, sf_dir), "entity", "last_seen_at_utc", "offer_key", "first_seen_run_id", "latest_post_url", "hash", "prices", "currencies", T.packed_list(F.col("service_tags")), T.packed_list(F.col("city_codes")), T.packed_list(F.col("source_channel_keys")))
    return got.select("entity", "times_seen", "first_seen_at_utc", "last_seen_at_utc", "first_seen_run_id", "price_min", "price_max", "price_text_best", "currency_code", F.array_join("service_tags", "|").alias("service_tags"), "dedupe_confidence")


@query(f"""WITH f AS (SELECT sender_id, unnest([{{'p': 0, 'v': {norm('sender_title')}}}, {{'p': 1, 'v': {norm('post_author')}}}, {{'p': 2, 'v': {norm('chat_title')}}}]) AS x FROM raw_posts WHERE coalesce(sender_id, '') <> ''),
 n AS (SELECT sender_id, x.v AS v, count(*) AS n, min(x.p) AS p FROM f WHERE x.v <> '' GROUP BY 1, 2)
 SELECT sender_id, arg_min(v, {{'n': -n, 'p': p, 'l': -length(v), 'w': lower(v), 'v': v}}) AS display_name FROM n GROUP BY 1""")
def sender_display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The display name of every sender."""
    return E.display_names(table(spark, sf_dir, "raw_posts").where("coalesce(sender_id, '') <> ''"), "sender_id")


_AUDIT = """SELECT 'm:' || match_id AS audit_row_id, 'provider' AS entity_type, left_provider_key AS entity_id, run_id, decision AS decision_code FROM provider_matches
 UNION ALL SELECT 'b:' || batch_row_id, 'offer', offer_key, run_id, NULL FROM offer_batches UNION ALL SELECT 'r:' || run_id, 'run', run_id, run_id, run_status FROM service_runs
 UNION ALL SELECT DISTINCT 'p:' || raw_post_id, 'raw_post', raw_post_id, max(run_id) OVER (PARTITION BY raw_post_id), NULL FROM review_posts WHERE raw_post_id IS NOT NULL"""


@query(f"""WITH a AS ({_AUDIT}), po AS (SELECT post_key AS raw_post_id, max(post_url) AS post_url, max(posted_at_utc) AS posted_at_utc, max(chat_id) AS source_channel_key FROM raw_posts WHERE coalesce(post_key, '') <> '' GROUP BY 1),
 s AS (SELECT DISTINCT 'p:' || raw_post_id AS audit_row_id, raw_post_id FROM review_posts WHERE raw_post_id IS NOT NULL UNION SELECT 'b:' || batch_row_id, po.raw_post_id FROM offer_batches JOIN offers USING (offer_key) JOIN po ON po.post_url = latest_post_url WHERE latest_post_url <> ''),
 l AS (SELECT audit_row_id, count(*) AS source_posts, min(raw_post_id) AS least_source FROM s JOIN po USING (raw_post_id) GROUP BY 1)
 SELECT a.*, CASE entity_type WHEN 'provider' THEN coalesce(nullif(trim(coalesce(canonical_name, '')), ''), nullif(trim(coalesce(display_name_best, '')), ''), entity_id) WHEN 'offer' THEN coalesce(nullif(trim(coalesce(title_best, '')), ''), nullif(trim(coalesce(offer_summary, '')), ''), entity_id)
   WHEN 'raw_post' THEN coalesce(nullif(po.post_url, ''), entity_id) ELSE entity_id END AS entity_label,
   CASE entity_type WHEN 'provider' THEN CASE WHEN p.provider_key IS NOT NULL THEN '' END WHEN 'offer' THEN o.latest_post_url WHEN 'raw_post' THEN po.post_url ELSE '' END AS entity_latest_post_url, coalesce(source_posts, 0) AS source_posts, coalesce(least_source, '') AS least_source
 FROM a LEFT JOIN providers p ON entity_type = 'provider' AND p.provider_key = entity_id LEFT JOIN offers o ON entity_type = 'offer' AND o.offer_key = entity_id LEFT JOIN po ON entity_type = 'raw_post' AND po.raw_post_id = entity_id LEFT JOIN l ON l.audit_row_id = a.audit_row_id""")
def audit_review_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of matches, batches, runs and reviewed posts with what they speak of and their source posts."""
    t = {n: table(spark, sf_dir, n) for n in ("provider_matches", "offer_batches", "service_runs", "review_posts", "providers", "offers", "raw_posts")}
    row = lambda df, mark, ident, kind, entity, code: df.select(F.concat(F.lit(mark), F.col(ident).cast("string")).alias("audit_row_id"), F.lit(kind).alias("entity_type"), F.col(entity).alias("entity_id"), "run_id", (F.col(code) if code else F.lit(None)).cast("string").alias("decision_code"))
    reviewed = t["review_posts"].where("raw_post_id is not null").groupBy("raw_post_id").agg(F.max("run_id").alias("run_id"))
    audit = row(t["provider_matches"], "m:", "match_id", "provider", "left_provider_key", "decision").unionAll(row(t["offer_batches"], "b:", "batch_row_id", "offer", "offer_key", None)).unionAll(row(t["service_runs"], "r:", "run_id", "run", "run_id", "run_status")).unionAll(row(reviewed, "p:", "raw_post_id", "raw_post", "raw_post_id", None))
    posts = t["raw_posts"].where("coalesce(post_key, '') <> ''").groupBy(F.col("post_key").alias("raw_post_id")).agg(F.max("post_url").alias("post_url"), F.max("posted_at_utc").alias("posted_at_utc"), F.max("chat_id").alias("source_channel_key"))
    of_batch = t["offer_batches"].join(t["offers"].where("latest_post_url <> ''").select("offer_key", F.col("latest_post_url").alias("post_url")), "offer_key").join(posts.select("raw_post_id", "post_url"), "post_url")
    sources = reviewed.select(F.concat(F.lit("p:"), "raw_post_id").alias("audit_row_id"), "raw_post_id").unionAll(of_batch.select(F.concat(F.lit("b:"), F.col("batch_row_id").cast("string")), "raw_post_id")).distinct()
    got = V.audit_drilldown(audit, t["providers"], t["offers"], posts, sources)
    return got.select(*audit.columns, "entity_label", "entity_latest_post_url", F.size("source_raw_posts").alias("source_posts"), T.or_empty(F.array_min(F.transform("source_raw_posts", lambda x: x["raw_post_id"]))).alias("least_source"))


@query("""WITH c AS (SELECT match_id, coalesce(match_field, '') AS stage, coalesce(match_value, '') AS txt, score, decision FROM provider_matches),
 t AS (SELECT *, greatest(220, CAST(ceil(length(txt) / 4.0) AS INT) + 200) AS tokens FROM c), r AS (SELECT *, sum(tokens) OVER (PARTITION BY stage ORDER BY match_id) AS spent FROM t)
 SELECT CAST(match_id AS VARCHAR) AS key, stage, tokens, CASE WHEN spent > 200000 THEN 'stopped' WHEN spent > 20000 THEN 'soft_exceeded' ELSE 'ok' END AS budget, CASE WHEN spent > 200000 THEN NULL WHEN score IS NULL OR decision IS NULL THEN NULL ELSE greatest(0, least(1, score)) END AS confidence,
 CASE WHEN spent > 200000 OR score IS NULL OR decision IS NULL THEN 'drop' WHEN decision = 'no_match' THEN 'reject' WHEN score >= 0.75 THEN 'accept' WHEN score >= 0.5 THEN 'recover' ELSE 'reject' END AS outcome,
 CASE WHEN spent > 200000 THEN 'budget' WHEN score IS NULL AND decision IS NULL THEN 'invalid_json' WHEN score IS NULL OR decision IS NULL THEN 'missing_field' ELSE decision END AS reason FROM r""")
def decided_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision loop over all matches, each answered by what was decided on it."""
    m = table(spark, sf_dir, "provider_matches").withColumns({"stage": T.or_empty(F.col("match_field")), "key": F.col("match_id").cast("string"), "text": T.or_empty(F.col("match_value"))})
    asked = m.select("key", "stage", "text", "match_id")
    answer = F.to_json(F.struct(F.col("decision").alias("decision_code"), F.col("score").alias("confidence")))
    no = S.numbered(m.select("stage", "match_id", answer.alias("output")), ["stage", "match_id"])
    outputs = no.join(no.groupBy("stage").agg(F.min("row_no").alias("_f")), "stage").select("stage", (F.col("row_no") - F.col("_f") + 1).cast("int").alias("attempt"), "output")
    return R.run_decisions(asked, outputs, ["match_id"], 20_000, 200_000).select("key", "stage", "tokens", "budget", "confidence", "outcome", "reason")


@query("""SELECT 'runs' AS table_name, count(DISTINCT run_id) AS rows FROM service_runs WHERE coalesce(run_id, '') <> '' UNION ALL SELECT 'raw_posts', count(DISTINCT post_key) FROM raw_posts WHERE coalesce(post_key, '') <> '' AND coalesce(chat_id, '') <> '' AND message_id IS NOT NULL
 UNION ALL SELECT 'providers', count(DISTINCT provider_key) FROM providers WHERE coalesce(provider_key, '') <> '' UNION ALL SELECT 'offers', count(DISTINCT offer_key) FROM offers WHERE coalesce(offer_key, '') <> ''
 UNION ALL SELECT 'offer_edges', count(*) FROM (SELECT DISTINCT offer_key, post_key FROM offers JOIN raw_posts ON post_url = latest_post_url WHERE coalesce(offer_key, '') <> '' AND coalesce(post_key, '') <> '' AND coalesce(latest_post_url, '') <> '')
 UNION ALL SELECT 'audit', count(DISTINCT match_id) FROM provider_matches WHERE match_id IS NOT NULL""")
def publication_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table of a publication of everything."""
    t = {n: table(spark, sf_dir, n) for n in ("service_runs", "raw_posts", "providers", "offers", "provider_matches")}
    posts = t["raw_posts"].where("coalesce(chat_id, '') <> '' and message_id is not null")
    told = t["offers"].where("coalesce(latest_post_url, '') <> ''").select("offer_key", F.col("latest_post_url").alias("post_url"), "first_seen_run_id", "last_seen_run_id").join(t["raw_posts"].select("post_url", F.col("post_key").alias("raw_post_id")), "post_url")
    edges = R.edges(t["offers"], "offer_key", "", told, "")
    tables = {"runs": t["service_runs"], "raw_posts": posts, "providers": t["providers"], "offers": t["offers"], "offer_edges": edges, "audit": t["provider_matches"]}
    keys = {"runs": ["run_id"], "raw_posts": ["post_key"], "providers": ["provider_key"], "offers": ["offer_key"], "offer_edges": ["offer_key", "raw_post_id"], "audit": ["match_id"]}
    defaults = {"providers": {"provider_state": "candidate", "identity_strength": "provisional", "canonical_name": "=display_name_best"}, "offers": {"offer_state": "candidate"}}
    return R.publication_counts(R.publication(tables, keys, defaults, {"raw_posts": ["_run_id"], "providers": ["last_seen_run_id"], "offers": ["last_seen_run_id"]}))


@query("""WITH b AS (SELECT chat_id AS s, min(message_id) + (max(message_id) - min(message_id)) // 4 AS c, max(message_id) - (max(message_id) - min(message_id)) // 10 AS u FROM raw_posts WHERE chat_id IS NOT NULL GROUP BY 1),
 o AS (SELECT s, message_id AS m, post_key, c, u, try_cast(trim(posted_at_utc) AS TIMESTAMPTZ) AS ts, text IS NULL AND NOT coalesce(has_media, false) AS service FROM raw_posts JOIN b ON s = chat_id WHERE message_id IS NOT NULL),
 w AS (SELECT *, CASE WHEN m <= c THEN 'checkpoint_reached' WHEN m > u THEN NULL WHEN ts < TIMESTAMPTZ '2025-09-01 00:00:00+00' THEN 'cutoff_reached' END AS why FROM o),
 t AS (SELECT s, max(m) AS stop FROM w WHERE why IS NOT NULL GROUP BY 1), y AS (SELECT s, max(why) AS why FROM w JOIN t USING (s) WHERE m = stop GROUP BY 1),
 k AS (SELECT w.*, stop, (stop IS NULL OR m > stop) AND m <= u AS taken FROM w LEFT JOIN t USING (s) WHERE stop IS NULL OR m >= stop)
 SELECT s AS source_key, count(*) AS seen, count(DISTINCT post_key) FILTER (taken AND NOT service) AS emitted, count(*) FILTER (taken AND NOT service) - count(DISTINCT post_key) FILTER (taken AND NOT service) AS duplicates, count(*) FILTER (taken AND service) AS service,
 count(*) FILTER (m > u) AS newer_skipped, min(m) AS min_id, max(m) AS max_id, coalesce(max(y.why), CASE WHEN count(DISTINCT post_key) FILTER (taken AND NOT service) = 0 THEN 'no_matching_posts' ELSE 'end_of_history' END) AS stop_reason FROM k LEFT JOIN y USING (s) GROUP BY 1""")
def scan_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a bounded scan of every channel meets, and why it stops."""
    posts = table(spark, sf_dir, "raw_posts")
    width = F.expr("max(message_id) - min(message_id)")
    bounds = posts.where("chat_id is not null").groupBy(F.col("chat_id").alias("source_key")).agg((F.min("message_id") + F.floor(width / 4)).alias("checkpoint_id"), (F.max("message_id") - F.floor(width / 10)).alias("upper_id"))
    bounds = bounds.withColumn("cutoff_at", F.lit("2025-09-01 00:00:00").cast("timestamp"))
    return P.scan_report(posts, bounds, service=F.col("text").isNull() & ~F.coalesce(F.col("has_media"), F.lit(False)))


@query(f"""WITH p AS ({_pairs_sql("offers", "offer_key", "title_best", 0.6)}), o AS (SELECT offer_key, coalesce(dedupe_confidence, '') <> 'high' AS weak, {_LIST.format(c="city_codes")} AS cities, CASE WHEN coalesce(category_primary, '') <> '' THEN [category_primary] ELSE [] END AS cats FROM offers)
 SELECT left_key, right_key, similarity FROM p JOIN o a ON a.offer_key = left_key JOIN o b ON b.offer_key = right_key WHERE (a.weak OR b.weak) AND (len(list_intersect(a.cities, b.cities)) > 0 OR len(list_intersect(a.cats, b.cats)) > 0) ORDER BY similarity DESC, left_key, right_key LIMIT 10""")
def overlapping_offer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most similar pairs of offer titles that share a city or a category, not both of high confidence."""
    offers = table(spark, sf_dir, "offers")
    cats = F.array_compact(F.array(F.when(T.or_empty(F.col("category_primary")) != "", F.col("category_primary"))))
    pairs = M.similar_pairs(offers, "offer_key", T.tokens(F.col("title_best")), 0.6)
    return M.review_pairs(pairs, offers, "offer_key", [T.packed_list(F.col("city_codes")), cats], T.or_empty(F.col("dedupe_confidence")) != "high", 10)


@query(f"""WITH p AS ({_pairs_sql("offers", "offer_key", "title_best", 0.6, "provider_key")}) SELECT left_key, right_key, similarity FROM p JOIN offers a ON a.offer_key = left_key JOIN offers b ON b.offer_key = right_key
 WHERE similarity >= CASE WHEN coalesce(a.category_primary, '') = coalesce(b.category_primary, '') THEN 0.6 ELSE 0.8 END ORDER BY similarity DESC, left_key, right_key LIMIT 15""")
def offer_pairs_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen most similar pairs of offers of a provider, with a threshold for one category and one for others."""
    offers = table(spark, sf_dir, "offers")
    return M.by_category(M.similar_pairs(offers, "offer_key", T.tokens(F.col("title_best")), 0.6, "provider_key"), offers, "offer_key", "category_primary", 0.6, 0.8, 15)
