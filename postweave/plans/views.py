"""Read views over the snapshot tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.functions import text as T


def freshness(ts: Column, as_of: Column) -> Column:
    """Age bucket of a time."""
    days = lambda n: as_of - F.expr(f"interval '{n}' day")
    return F.when(ts >= days(7), "fresh_0_7d").when(ts >= days(30), "recent_8_30d").when(ts >= days(90), "aging_31_90d").otherwise("stale_91d_plus")


def offers_catalog(offers: DataFrame, providers: DataFrame, as_of: Column) -> DataFrame:
    """One row per offer with its provider's name and age bucket."""
    names = providers.select("provider_key", T.first_filled(F.col("canonical_name"), F.col("display_name_best"), F.col("provider_key")).alias("provider_display_name"))
    cols = ("offer_key", "provider_key", "offer_state", "category_primary", "category_secondary", "title_best", "price_text_best", "price_min", "price_max", "currency_code", "city_codes", "service_tags", "serbia_relevance_verdict", "last_seen_at_utc", "latest_post_url", "dedupe_confidence")
    return offers.select(*cols).join(names, "provider_key").withColumn("freshness_bucket", freshness(F.col("last_seen_at_utc"), as_of))


def providers_directory(providers: DataFrame, offers: DataFrame) -> DataFrame:
    """One row per provider with its offers, newest first, as a list of structs, empty without any."""
    order = F.struct((-F.unix_micros("last_seen_at_utc")).alias("o"), F.col("offer_key"), F.col("title_best"), F.col("offer_state"))
    own = offers.groupBy("provider_key").agg(F.count("*").alias("offers_total"), F.max("last_seen_at_utc").alias("latest_offer_at"), F.array_sort(F.collect_list(order)).alias("offers"))
    listed = F.transform("offers", lambda x: F.struct(x["offer_key"].alias("offer_key"), x["title_best"].alias("title_best"), x["offer_state"].alias("offer_state")))
    empty = F.array().cast("array<struct<offer_key:string,title_best:string,offer_state:string>>")
    base = providers.select("provider_key", "provider_state", "identity_strength", "canonical_name", "display_name_best", "times_seen", "last_seen_at_utc")
    return base.join(own.withColumn("offers", listed), "provider_key", "left").withColumns({"offers_total": F.coalesce("offers_total", F.lit(0)), "offers": F.coalesce("offers", empty)})


def run_monitoring(runs: DataFrame, posts: DataFrame) -> DataFrame:
    """One row per run with its duration and what it fetched."""
    got = posts.groupBy(F.col("_run_id").alias("run_id")).agg(F.count("*").alias("posts"), F.countDistinct("post_key").alias("distinct_posts"), F.countDistinct("chat_id").alias("targets"), F.sum(F.coalesce("views", F.lit(0))).alias("views"))
    base = runs.select("run_id", "run_status", "trigger_type", "started_at_utc", "finished_at_utc", "duration_ms", (F.col("finished_at_utc").isNull()).alias("unfinished"), T.first_filled(F.col("error_message"), F.col("error_type")).alias("error"))
    zero = F.lit(0).cast("bigint")
    return base.join(got, "run_id", "left").withColumns({c: F.coalesce(c, zero) for c in ("posts", "distinct_posts", "targets", "views")})


def review_drilldown(review: DataFrame, posts: DataFrame, runs: DataFrame) -> DataFrame:
    """Review rows with the newest stored post and the run; rows without a stored post stay."""
    w = F.max_by(F.struct("chat_title", "views", "_run_id"), F.struct("_run_id", F.coalesce("views", F.lit(-1)))).alias("p")
    latest = posts.groupBy(F.col("post_key").alias("raw_post_id")).agg(w, F.count("*").alias("fetches"))
    label = runs.select("run_id", F.col("run_status").alias("review_run_status"))
    return review.join(latest, "raw_post_id", "left").join(label, "run_id", "left").select("raw_post_id", "run_id", "review_run_status", F.col("p.chat_title").alias("chat_title"), F.col("p._run_id").alias("stored_run_id"), F.coalesce("fetches", F.lit(0)).alias("fetches"), F.col("p").isNotNull().alias("is_stored"))


def coverage_metrics(offers: DataFrame, providers: DataFrame, runs: DataFrame, posts: DataFrame, as_of: Column) -> DataFrame:
    """Seven families of counts in one shape: unused texts are empty, unused numbers null.

    Each table is read once: a row becomes one struct per family and city it counts for, and one aggregate with
    partial sums takes them all.
    """
    texts, totals = ("bucket", "offer_state", "provider_state", "identity_strength", "category", "city", "status"), ("raw_posts_total", "providers_total", "offers_total")

    def counts_for(name: str, **by: Column) -> Column:
        return F.struct(F.lit(name).alias("metric_family"), *[by.get(t, F.lit("")).alias(t) for t in texts])

    def cities(c: Column, f: Callable[[Column], Column]) -> Column:
        return F.transform(T.let(T.packed_list(c), lambda x: F.when(F.size(x) == 0, F.array(F.lit("unknown"))).otherwise(x)), f)

    def families(df: DataFrame, counted: Column, latest: str) -> DataFrame:
        flat = df.select(F.explode(counted).alias("m"), F.col(latest).alias("at"))
        return flat.groupBy("m").agg(F.count("*").alias("metric_value"), F.max("at").alias("latest_at")).select("m.*", "metric_value", "latest_at", *[F.lit(None).cast("bigint").alias(n) for n in totals])

    age = freshness(F.col("last_seen_at_utc"), as_of)
    state, p_state, strength = F.col("offer_state"), F.col("provider_state"), F.col("identity_strength")
    category = F.coalesce(F.nullif(F.col("category_primary"), F.lit("")), F.lit("uncategorized"))
    of_offer = F.concat(F.array(counts_for("offer_freshness", bucket=age, offer_state=state), counts_for("offer_category_coverage", category=category, offer_state=state)), cities(F.col("city_codes"), lambda c: counts_for("offer_city_coverage", city=c, offer_state=state)))
    of_provider = F.concat(F.array(counts_for("provider_freshness", bucket=age, provider_state=p_state, identity_strength=strength)), cities(F.col("city_codes"), lambda c: counts_for("provider_city_coverage", city=c, provider_state=p_state, identity_strength=strength)))
    of_run = F.array(counts_for("run_target_coverage", status=F.col("run_status")))
    total = runs.agg(F.count("*").alias("metric_value"), F.max("started_at_utc").alias("latest_at"))
    rows = total.unionByName(posts.agg(F.count("*").alias("raw_posts_total")), True).unionByName(providers.agg(F.count("*").alias("providers_total")), True).unionByName(offers.agg(F.count("*").alias("offers_total")), True)
    one = rows.agg(*[F.max(c).alias(c) for c in ("metric_value", "latest_at", *totals)])
    summary = one.select(F.lit("run_summary").alias("metric_family"), *[F.lit("").alias(t) for t in texts], "metric_value", "latest_at", *totals)
    out = families(offers, of_offer, "last_seen_at_utc").unionByName(families(providers, of_provider, "last_seen_at_utc"))
    return out.unionByName(families(runs, of_run, "started_at_utc")).unionByName(summary)


def audit_drilldown(audit: DataFrame, providers: DataFrame, offers: DataFrame, posts: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per audit row with the label and address of what it speaks of, and its source posts, newest first.

    An audit row speaks of a provider, an offer, a post or a run; each join holds for its own kind only.  ``posts`` has
    one row per raw_post_id, ``sources`` pairs (audit_row_id, raw_post_id).
    """
    own = audit.withColumns({f"_{k}": F.when(F.col("entity_type") == k, F.col("entity_id")) for k in ("provider", "offer", "raw_post")})
    p = providers.select(F.col("provider_key").alias("_provider"), T.first_filled(F.col("canonical_name"), F.col("display_name_best")).alias("_p_label"), F.lit("").alias("_p_url"))
    o = offers.select(F.col("offer_key").alias("_offer"), T.first_filled(F.col("title_best"), F.col("offer_summary")).alias("_o_label"), F.col("latest_post_url").alias("_o_url"))
    r = posts.select(F.col("raw_post_id").alias("_raw_post"), F.col("post_url").alias("_r_url"))
    told = sources.join(posts.select("raw_post_id", "post_url", "posted_at_utc", "source_channel_key"), "raw_post_id")
    order = F.struct((-F.unix_micros("_at")).alias("o"), F.col("raw_post_id"), F.col("post_url"), F.col("posted_at_utc"), F.col("source_channel_key"))
    told = told.withColumn("_at", F.coalesce(F.trim("posted_at_utc").try_cast("timestamp"), F.timestamp_micros(F.lit(0)))).groupBy("audit_row_id").agg(F.array_sort(F.collect_list(order)).alias("_posts"))
    told = told.select("audit_row_id", F.transform("_posts", lambda x: F.struct(x["raw_post_id"].alias("raw_post_id"), x["post_url"].alias("post_url"), x["posted_at_utc"].alias("posted_at_utc"), x["source_channel_key"].alias("source_channel_key"))).alias("source_raw_posts"))
    got = own.join(p, "_provider", "left").join(o, "_offer", "left").join(r, "_raw_post", "left").join(told, "audit_row_id", "left")
    label = F.when(F.col("entity_type") == "provider", T.first_filled(F.col("_p_label"), F.col("entity_id"))).when(F.col("entity_type") == "offer", T.first_filled(F.col("_o_label"), F.col("entity_id"))).when(F.col("entity_type") == "raw_post", T.first_filled(F.col("_r_url"), F.col("entity_id"))).otherwise(F.col("entity_id"))
    # As in the contract, an entity that is not there has no address, one of another kind an empty one.
    url = F.when(F.col("entity_type") == "provider", F.col("_p_url")).when(F.col("entity_type") == "offer", F.col("_o_url")).when(F.col("entity_type") == "raw_post", F.col("_r_url")).otherwise("")
    none = F.array().cast("array<struct<raw_post_id:string,post_url:string,posted_at_utc:string,source_channel_key:string>>")
    return got.select(*audit.columns, label.alias("entity_label"), url.alias("entity_latest_post_url"), F.coalesce("source_raw_posts", none).alias("source_raw_posts"))
