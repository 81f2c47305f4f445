"""One query per operator, each over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions import expr as e
from patronage.models import density, forests, hierarchy, metrics, scoring, segmentation, store, training
from patronage.operators import (
    abtest,
    campaign,
    cleanup,
    features,
    journey,
    profiling,
    quality,
    ranking,
    rfm,
    rules,
    splits,
)
from patronage.plans import reports, unify
from patronage.plans.batch import metrics_table
from patronage.registry.oracle import BUDGET, CONVERSION, PROBABILITY_COARSE, ROI, STAGE, STAGE_COARSE, SUCCESS
from patronage.registry.oracle import bins as case_of_bins
from patronage.registry.publish import publish
from patronage.registry.warehouse import AS_OF, Warehouse
from patronage.session import cut_lineage
from patronage.sources import manifest, tables
from patronage.sources.schemas import DEFAULTS, DOMAINS, PRIMARY_KEYS, REQUIRED

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RUN_TS = datetime(2001, 8, 2, 12, 0, 0)
DENSITY_FEATURES = k.SEGMENTATION_FEATURES


RATES = ("accuracy", "precision", "recall", "f1")


# what SQL can compute without the model: the split, its labels, a constant guess, the settings
REPEATABLE = (
    "n_train", "n_test", "n_rows", "label_min", "label_max", "baseline_rmse", "baseline_accuracy", "baseline_cv_accuracy",
    "baseline_cost", "n_estimators", "max_depth", "n_clusters",
)


def sound(values: DataFrame) -> DataFrame:
    """Metric names, whether each value is one that its metric can have, and the value itself where
    it does not depend on the fitted model."""
    v, metric = F.col("value"), F.col("metric")
    capped = metric.isin(*RATES) | metric.contains("r2") | metric.contains("silhouette") | metric.startswith("cv_")
    signed = metric.contains("r2") | metric.contains("silhouette")
    ok = ~F.isnan(v) & (v < float("inf")) & (~capped | (v <= 1)) & (signed | (v >= 0))
    return values.select(*[c for c in values.columns if c != "value"], F.coalesce(ok, F.lit(False)).alias("sound"),
                         F.when(metric.isin(*REPEATABLE), v).alias("value"))


def consistent(scores: DataFrame, keep: str, *conditions: str) -> DataFrame:
    """Columns that do not depend on the model, and whether a row's other columns agree with
    its published score."""
    holds = reduce(lambda a, b: a & b, [F.coalesce(F.expr(c), F.lit(False)) for c in conditions])
    return scores.select(*keep.split(), holds.alias("consistent"))


def model_values(spark: SparkSession, fitted: Mapping[str, object]) -> DataFrame:
    """model, metric, value: all metrics (NULL where one is undefined), rows of the split, what a
    constant guess reaches, and whether the model is better than that."""
    rows = []
    for name, model in fitted.items():
        values = {**model.metrics, **model.baseline}
        if "baseline_rmse" in values:
            better = values["rmse"] < values["baseline_rmse"]
        elif "baseline_accuracy" in values:
            better = values["accuracy"] > values["baseline_accuracy"]
        else:
            better = values["training_cost"] < values["baseline_cost"]
        values["beats_baseline"] = better
        rows += [(name, metric, None if v is None else float(v)) for metric, v in values.items()]
    return spark.createDataFrame(rows, "model string, metric string, value double")


def label_range(column: str, forest: forests.Forest) -> str:
    """A forest predicts means of labels, which lie between the least and the largest one."""
    low, high = forest.baseline["label_min"], forest.baseline["label_max"]
    slack = 1e-9 * max(abs(low), abs(high), 1.0)
    return f"{column} between {low - slack!r}D and {high + slack!r}D"


def in_bins(column: str, category: str, bins: tuple[list, list]) -> str:
    return f"{category} <=> {case_of_bins(column, *bins)}"


def query(name: str):
    def register(build: Callable[[Warehouse], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: publish(build(Warehouse.of(spark, sf_dir)))
        return build

    return register


def scored(name: str, scores: Callable[[Warehouse], DataFrame], keep: str, *conditions: str, within: tuple[str, str] | None = None):
    """The whole score table as ``name``_values, and as ``name`` what SQL can repeat of it.
    ``within`` names a prediction and the model whose labels bound it."""
    query(f"{name}_values")(scores)
    bounds = (lambda w: [label_range(within[0], w.model(within[1]))]) if within else (lambda w: [])
    query(name)(lambda w: consistent(scores(w), keep, *conditions, *bounds(w)))


# ---- sources and sinks ---------------------------------------------------------------

query("s1_relational_scan")(lambda w: w.view("transactions"))
query("s2_document_scan")(lambda w: w.view("sessions").drop("session_start", "session_end"))
query("s3_load_rfm")(lambda w: unify.load_rfm(w.rfm))
query("s3_load_demographics")(lambda w: unify.load_demographics(w.demographics, w.customers))
query("s3_load_campaigns")(lambda w: unify.load_campaigns(campaign.campaign_ranks(w.campaign_data)))
query("s3_load_ab_tests")(lambda w: unify.load_ab_tests(w.ab))
query("s3_load_journey")(lambda w: unify.load_journey(w.journey))
query("s4_parquet_scan")(
    lambda w: tables.read_parquet(w.spark, f"{w.sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
)


@query("s5_csv_round_trip")
def _(w):
    source = w.demographics
    path = tables.write_csv(source, w.scratch("demographics_csv"))
    return tables.read_csv(w.spark, path, source.schema)


@query("s6_materialize")
def _(w):
    summary = rfm.rfm_summary(w.rfm)
    path = w.scratch("rfm_summary_stats")
    name = "rfm_summary_" + path.split("/")[-2].replace("-", "_")
    tables.materialize(summary, name, "overwrite", path)
    # a second run keeps the table that is there
    return tables.materialize(summary.limit(0), name, "ignore", path)


@query("s7_parquet_round_trip")
def _(w):
    path = tables.write_parquet(w.transactions, w.scratch("transactions"), ["order_status"])
    return tables.read_parquet(w.spark, path)


@query("s8_snapshots")
def _(w):
    base = w.scratch("scores")
    scores = w.rfm.select("customer_id", "rfm_segment")
    tables.write_snapshot(scores.filter(F.col("rfm_segment") == "New"), base, datetime(2001, 7, 1))
    tables.write_snapshot(scores, base, RUN_TS)
    return tables.read_latest_snapshot(w.spark, base)


@query("s9_report_sink")
def _(w):
    path = tables.write_report(reports.forecast_report(w.formula_scores("revenue"), "predicted_revenue"), w.scratch("report"))
    return w.spark.read.schema("section string, key string, value double").json(path)


STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def rows_by_file(w: Warehouse, listing: DataFrame) -> DataFrame:
    """Name and number of rows of each listed Parquet file of the star tables."""
    name = F.regexp_extract("path", r"/(\w+\.parquet)(/|$)", 1).alias("file")
    counts = [
        w.spark.read.parquet(f"{w.sf_dir}/{t}.parquet").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(f"{t}.parquet").alias("file"), "rows")
        for t in STAR
    ]
    return reduce(DataFrame.unionAll, counts).join(listing.select(name), "file", "left_semi")


query("s10_file_manifest")(lambda w: rows_by_file(w, manifest.file_manifest(w.spark, w.sf_dir)))


@query("s11_latest_by_suffix")
def _(w):
    """The newer of two written summaries."""
    base = w.scratch("orders")
    orders = w.spark.read.parquet(f"{w.sf_dir}/orders.parquet").groupBy("o_orderpriority")
    for label, part in (("first", 0), ("second", 1)):
        orders.agg(F.count_if(F.col("o_orderkey") % 2 == part).alias("orders")).coalesce(1).write.parquet(f"{base}/{label}")
    latest = manifest.latest_by_suffix(manifest.file_manifest(w.spark, base), [".parquet", ".csv"])
    return w.spark.read.schema("o_orderpriority string, orders long").parquet(*[r["path"] for r in latest.collect()])


query("s12_recent_orders")(lambda w: manifest.recent(w.transactions, "order_date", 3, AS_OF))


@query("s13_changed_files")
def _(w):
    base = w.scratch("events")
    events = w.spark.read.parquet(f"{w.sf_dir}/events.parquet").select("event_id", "event_type", "value")
    events.write.partitionBy("event_type").parquet(base)
    cached = cut_lineage(manifest.file_manifest(w.spark, base))
    events.where("event_type = 'click'").select("event_id", "value").write.mode("append").parquet(f"{base}/event_type=click")
    changed = manifest.changed_files(manifest.file_manifest(w.spark, base), cached)
    return w.spark.read.schema("event_id long, value double").parquet(*[r["path"] for r in changed.collect()])


query("s14_suffix_listing")(lambda w: rows_by_file(w, manifest.file_manifest(w.spark, w.sf_dir, ["s.parquet", ".csv"])))
query("s15_timeline_info")(
    lambda w: rows_by_file(
        w, manifest.timeline_info(manifest.file_manifest(w.spark, w.sf_dir)).withColumnRenamed("file", "path").where("size > 0")
    )
)


@query("s16_model_store")
def _(w):
    base = w.scratch("models")
    for run in (datetime(2001, 7, 1), RUN_TS):
        store.save_model(w.spark, w.model("revenue"), base, "forecasting", "revenue", run)
    loaded = store.load_latest_model(w.spark, base, "forecasting", "revenue")
    again = scoring.score_revenue(loaded, training_inputs(w), AS_OF).select("customer_id", F.col("predicted_revenue").alias("again"))
    both = scoring.score_revenue(w.model("revenue"), training_inputs(w), AS_OF).join(again, "customer_id", "full")
    return both.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(~F.col("again").eqNullSafe(F.col("predicted_revenue"))).alias("different"),
    )


def training_inputs(w: Warehouse) -> DataFrame:
    return training.forecasting_inputs(w.infer_part, w.infer_lags)


# ---- projections, filters, predicates ------------------------------------------------

query("p1_clean_customers")(lambda w: w.customers)
query("p2_clean_demographics")(lambda w: w.demographics)
query("p3_clean_transactions")(lambda w: w.transactions)
query("p4_clean_items")(lambda w: w.items)
query("p5_clean_campaigns")(lambda w: w.campaigns)
query("p6_clean_campaign_performance")(lambda w: w.performance)
query("p7_clean_ab_tests")(lambda w: w.ab_tests)
query("p8_clean_ab_results")(lambda w: w.ab_test_results)
query("p9_successful_orders")(lambda w: w.sold)
query("p10_session_not_null")(lambda w: w.view("page_views").filter(F.col("session_id").isNotNull()).drop("timestamp"))
query("p11_ladder")(
    lambda w: w.transactions.select(
        "transaction_id", e.at_least("total_amount", [(300, "large"), (150, "medium")], "small").alias("size")
    )
)
query("p12_select_available")(
    lambda w: features.select_available(w.rfm, ["frequency", "not_there", "recency_days"])[0]
)
query("p13_default_missing")(
    lambda w: features.default_missing(
        w.rfm.select("customer_id", "frequency"),
        ["frequency", "campaign_count", "avg_roas", "engagement_score", "idle_days", "other"],
    )
)
query("p14_with_purchases")(lambda w: features.with_purchases(w.rfm).select("customer_id", "monetary_value"))
query("p15_drop_incomplete")(
    lambda w: features.drop_incomplete(w.view("customer_demographics"), ["age_group"]).select("customer_id", "age_group")
)
query("p16_require_rows")(
    lambda w: w.spark.createDataFrame(
        [(features.require_rows(w.customers, 100), features.require_rows(w.customers.filter("false"), 100))],
        "enough boolean, too_few boolean",
    )
)
query("p17_stamp")(lambda w: features.stamp(w.customers.select("customer_id"), "1.0", AS_OF))


# ---- joins ---------------------------------------------------------------------------

query("j1_inner_join_dimension")(
    lambda w: w.ab_tests.join(w.campaigns.select("campaign_id", "channel", "campaign_type"), "campaign_id").select(
        "test_id", "campaign_id", "channel", "campaign_type"
    )
)
query("j2_keep_with_parent")(
    lambda w: cleanup.keep_with_parent(w.view("transactions"), w.customers, "customer_id").select("transaction_id", "customer_id")
)
query("j3_order_item_chain")(
    lambda w: rfm.rfm_metrics(w.customers, w.valid_transactions, w.valid_items, AS_OF).select(
        "customer_id", "frequency", "total_items_purchased"
    )
)
query("j4_left_join_aggregate")(
    lambda w: campaign.campaign_metrics(w.campaigns, w.valid_performance).select("campaign_id", "total_clicks", "total_revenue")
)
query("j5_star_join")(lambda w: w.journey)
query("j6_merge_suffix")(
    lambda w: unify.merge_suffix(
        w.rfm.select("customer_id", "email", "frequency"),
        w.journey.select("customer_id", "email", "total_sessions"),
        "customer_id",
        "_journey",
    )
)
query("j7_merge_demographics")(
    lambda w: w.rfm.select("customer_id", "rfm_segment").join(
        w.demographics.select("customer_id", "age_group", "household_size"), "customer_id", "left"
    )
)
query("j8_map_values")(
    lambda w: w.rfm.select(
        "customer_id",
        e.map_values("rfm_segment", k.SEGMENT_AUDIENCE).alias("target_audience"),
        e.map_values("rfm_segment", k.SEGMENT_CAMPAIGN_TYPE).alias("campaign_type"),
    )
)
query("j9_merge_audience")(
    lambda w: w.joined.select("customer_id", "target_audience", "campaign_count", "avg_roas", "total_campaign_revenue")
)
query("j10_tests_with_campaign_type")(lambda w: unify.ab_by_campaign_type(w.ab, w.campaign_data))
query("j11_anti_join")(
    lambda w: quality.orphans(w.view("transactions"), w.customers, "customer_id").select("transaction_id", "customer_id")
)


@query("j12_attach_segment_profile")
def _(w):
    placed = w.formula_clusters()
    stats = segmentation.segment_stats(placed, "cluster")
    return segmentation.attach_segment_profile(placed.select("customer_id", "cluster"), stats, "cluster", "demo")


@query("j13_rule_segments")
def _(w):
    customers = w.rfm.join(w.customers.select("customer_id", "is_active"), "customer_id")
    return rules.assign_rule_segments(customers, rules.default_segments(w.spark), AS_OF)


# ---- aggregations --------------------------------------------------------------------

query("a1_rfm_metrics")(lambda w: rfm.rfm_metrics(w.customers, w.valid_transactions, w.valid_items, AS_OF))
query("a1_rfm_metrics_fanout")(
    lambda w: rfm.rfm_metrics(w.customers, w.valid_transactions, w.valid_items, AS_OF, item_fanout=True)
)
query("a2_rfm_summary")(lambda w: rfm.rfm_summary(w.rfm))
query("a3_campaign_metrics")(lambda w: campaign.campaign_metrics(w.campaigns, w.valid_performance))
query("a4_channel_summary")(lambda w: campaign.channel_summary(w.campaign_data))
query("a5_type_summary")(lambda w: campaign.type_summary(w.campaign_data))
query("a6_session_stats")(lambda w: journey.session_stats(w.view("sessions")))
query("a7_page_view_stats")(lambda w: journey.page_view_stats(w.view("page_views")))
query("a8_event_stats")(lambda w: journey.event_stats(w.view("click_events")))
query("a9_interaction_stats")(lambda w: journey.interaction_stats(w.view("product_interactions")))
query("a10_search_stats")(lambda w: journey.search_stats(w.view("search_queries")))
query("a11_journey_summary")(lambda w: journey.journey_summary(w.journey))
query("a12_ab_variant_totals")(lambda w: abtest.ab_variant_totals(w.ab_tests, w.valid_results))
query("a13_ab_summary")(lambda w: abtest.ab_summary(w.ab))


@query("a14_dq_summary")
def _(w):
    return cleanup.dq_summary(
        {
            "customers": (w.customers, w.view("customers")),
            "transactions": (w.transactions, w.view("transactions")),
            "campaigns": (w.campaigns, w.view("campaigns")),
            "ab_tests": (w.ab_tests, w.view("ab_tests")),
        }
    )


query("a15_audience_summary")(lambda w: unify.audience_summary(w.campaign_data))
query("a16_ab_by_campaign")(lambda w: unify.ab_by_campaign(w.ab))
query("a17_ab_by_campaign_type")(lambda w: unify.ab_by_campaign_type(w.ab, w.campaign_data))
query("a18_segment_profile")(lambda w: segmentation.segment_profile(w.stored, "rfm_segment"))
query("a19_segment_summary")(lambda w: segmentation.segment_summary(w.stored, "rfm_segment"))
query("a20_segment_stats")(lambda w: segmentation.segment_stats(w.stored, "frequency_score"))
query("a21_value_counts")(lambda w: profiling.value_counts(w.view("customer_demographics"), "age_group"))
query("a22_describe")(
    lambda w: profiling.describe_exact(w.stored, ["monetary_value", "recency_days", "frequency", "avg_order_value"])
)
query("a23_summary_stats")(lambda w: profiling.summary_stats(w.transactions, "total_amount"))
query("a24_rate")(lambda w: profiling.rate(w.journey, F.col("journey_type") == "Converter", "converter_share"))
query("a24_threshold_counts")(
    lambda w: profiling.threshold_counts(w.journey, "conversion_probability", 0.7, 0.3)
)
query("a25_group_size")(lambda w: profiling.group_size(w.rfm, "frequency"))
query("a26_null_counts")(lambda w: profiling.null_counts(w.view("customers")))
query("a27_duplicate_rows")(
    lambda w: profiling.duplicate_rows(w.view("transactions").select("customer_id", "payment_method", "order_status"))
)


def _formula_tables(w: Warehouse) -> dict[tuple[str, str], DataFrame]:
    return {
        ("forecasting", "revenue"): w.formula_scores("revenue"),
        ("journey_simulation", "journey_stage"): w.formula_scores("journey_stage"),
        ("journey_simulation", "conversion_prediction"): w.formula_scores("conversion_prediction"),
        ("campaign_optimization", "campaign_success"): w.formula_scores("campaign_success"),
    }


query("a28_master_report")(lambda w: reports.master_report(_formula_tables(w)))
query("a29_histogram")(lambda w: profiling.histogram(w.rfm, "rfm_score", 20))
query("a30_label_mode")(lambda w: profiling.label_mode(w.journey, "journey_type"))


# ---- windows -------------------------------------------------------------------------

query("w1_campaign_ranks")(
    lambda w: campaign.campaign_ranks(w.campaign_data).select("campaign_id", "revenue_rank", "conversion_rank", "roas_rank")
)
query("w1_rank_within_channel")(
    lambda w: ranking.rank_within(
        w.campaign_data.select("campaign_id", "channel", "total_revenue"),
        ["channel"],
        [F.desc_nulls_last("total_revenue"), F.asc("campaign_id")],
        "channel_rank",
    )
)
query("w2_latest_per_group")(
    lambda w: w.transactions.groupBy("customer_id")
    .agg(F.max(F.struct("order_date", "transaction_id", "total_amount")).alias("t"))
    .select("customer_id", "t.transaction_id", "t.order_date", "t.total_amount")
)
query("w3_first_per_key")(
    lambda w: ranking.first_per_key(
        w.transactions.select("customer_id", "order_date", "transaction_id", "total_amount"),
        ["customer_id"],
        ["order_date", "transaction_id"],
    )
)
query("w4_rank_curve")(lambda w: ranking.rank_curve(w.formula_scores("revenue"), "predicted_revenue", "customer_id"))
query("w5_order_gaps")(lambda w: features.order_gaps(w.sold))
query("w6_trailing_frames")(
    lambda w: features.revenue_lags(w.sold, AS_OF).select("customer_id", "order_day", "revenue_ma_7", "revenue_ma_30")
)


# ---- sorts, limits, samples ----------------------------------------------------------

query("t1_ordered_summary")(lambda w: rfm.rfm_display(rfm.rfm_summary(w.rfm)))
query("t2_union_sorted")(
    lambda w: campaign.campaign_display(
        campaign.channel_summary(w.campaign_data), campaign.type_summary(w.campaign_data)
    ).select("summary_type", "category", "roas")
)
query("t3_dedupe")(
    lambda w: ranking.first_per_key(
        w.view("ab_test_results").select("test_id", "result_id", "variant", "clicks"), ["test_id"], ["result_id", "variant"]
    )
)
query("t4_preview")(lambda w: profiling.preview(w.rfm.select("customer_id", "rfm_score").orderBy("customer_id"), 10))
query("t5_top_quantile")(lambda w: profiling.top_quantile(w.formula_scores("revenue"), "predicted_revenue", 0.8))
query("t5_top_rows")(
    lambda w: profiling.top_rows(w.formula_scores("revenue"), "predicted_revenue", 0.8)[1].select(
        "customer_id", "predicted_revenue"
    )
)


def _marked(first: DataFrame, second: DataFrame, columns: list[str]) -> DataFrame:
    return first.select(*columns, F.lit("first").alias("part")).unionByName(
        second.select(*columns, F.lit("second").alias("part"))
    )


query("t6_random_split")(lambda w: _marked(*splits.random_split(w.customers, 0.7, 42), ["customer_id"]))
query("t6_exact_split")(
    lambda w: splits.exact_split_flag(w.customers.select("customer_id"), 0.7, 42)
)
query("t7_train_test")(lambda w: _marked(*splits.train_test(w.customers, 0.2, 42), ["customer_id"]))
query("t8_stratified_split")(
    lambda w: _marked(*splits.train_test(w.stored, 0.2, 42, stratify="rfm_segment"), ["customer_id", "rfm_segment"])
)
query("t9_timeline_split")(lambda w: _marked(*splits.timeline_split(w.customers, AS_OF, 3), ["customer_id", "split_ts"]))


@query("t10_best_model")
def _(w):
    scores = w.formula_clusters().groupBy("rfm_segment").agg(F.avg("engagement_score").alias("silhouette_score"))
    return reports.best_model(scores.withColumnRenamed("rfm_segment", "model"))


# ---- set operations ------------------------------------------------------------------

query("u1_union_counts")(
    lambda w: cleanup.row_counts({"customers": w.customers, "campaigns": w.campaigns, "ab_tests": w.ab_tests})
)
query("u2_union_summaries")(
    lambda w: campaign.campaign_display(
        campaign.channel_summary(w.campaign_data), campaign.type_summary(w.campaign_data)
    )
)


# ---- scores, tiers, KPIs -------------------------------------------------------------

query("m1_recency_score")(lambda w: w.rfm.select("customer_id", "recency_days", "recency_score"))
query("m2_frequency_score")(lambda w: w.rfm.select("customer_id", "frequency", "frequency_score"))
query("m3_monetary_score")(lambda w: w.rfm.select("customer_id", "monetary_value", "monetary_score"))
query("m4_rfm_score")(lambda w: w.rfm.select("customer_id", "rfm_score"))
query("m5_rfm_segments")(lambda w: w.rfm)
query("m6_value_tier")(lambda w: w.rfm.select("customer_id", "customer_value_tier"))
query("m7_engagement_level")(lambda w: w.rfm.select("customer_id", "engagement_level"))
query("m8_guarded_ratio")(
    lambda w: w.view("ab_test_results").select(
        "result_id",
        e.ratio0("clicks", "impressions").alias("ctr"),
        e.ratio0("conversions", "clicks").alias("conversion_rate"),
    )
)
query("m9_performance_segment")(lambda w: w.campaign_data.select("campaign_id", "overall_roas", "performance_segment"))
query("m10_efficiency_score")(lambda w: w.campaign_data.select("campaign_id", "efficiency_score"))
query("m11_budget_utilization")(lambda w: w.campaign_data.select("campaign_id", "budget_utilization_percent"))
query("m12_duration")(
    lambda w: w.campaigns.select("campaign_id", e.days_between("start_date", "end_date").alias("campaign_duration"))
)
query("m13_journey_type")(lambda w: w.journey.select("customer_id", "journey_type"))
query("m14_conversion_status")(lambda w: w.journey.select("customer_id", "conversion_status"))
query("m15_journey_complexity")(lambda w: w.journey.select("customer_id", "journey_complexity"))
query("m16_engagement_score")(lambda w: w.journey.select("customer_id", "engagement_score"))
query("m17_conversion_probability")(lambda w: w.journey.select("customer_id", "conversion_probability"))
query("m18_device_preference")(
    lambda w: journey.session_stats(w.view("sessions")).select("customer_id", "device_preference")
)
query("m19_browser_preference")(
    lambda w: journey.session_stats(w.view("sessions")).select("customer_id", "browser_preference")
)
query("m20_unmatched_defaults")(
    lambda w: w.journey.select(
        "customer_id", "total_sessions", "device_preference", "total_page_views", "scroll_engagement",
        "total_search_queries", "search_effectiveness",
    )
)


def _ab_step(w: Warehouse, *columns: str) -> DataFrame:
    return w.ab.select("test_id", *columns)


query("m21_ab_rates")(
    lambda w: _ab_step(
        w,
        *[f"variant_{v}_{r}" for v in "ab" for r in ("ctr", "conversion_rate", "revenue_per_impression")],
        "test_duration_days",
    )
)
query("m22_ab_lift")(
    lambda w: _ab_step(w, "ctr_lift_percentage", "conversion_lift_percentage", "revenue_lift_percentage")
)
query("m23_ab_significance")(lambda w: _ab_step(w, "statistical_significance", "confidence_level", "p_value"))
query("m24_ab_winner")(lambda w: _ab_step(w, "winner"))
query("m25_ab_sample_size")(lambda w: _ab_step(w, "sample_size_required"))
query("m26_ab_recommend")(lambda w: _ab_step(w, "recommendation"))
query("m27_segment_type")(
    lambda w: segmentation.segment_summary(w.stored, "rfm_score").select("segment", "segment_type")
)
query("m28_campaign_kpis")(
    lambda w: campaign.derive_campaign_kpis(w.performance, w.campaigns).select(
        "performance_id", "ctr", "conversion_rate", "roas"
    )
)
query("m29_age_group")(
    lambda w: w.view("customers").select("customer_id", e.age_group("date_of_birth", AS_OF).alias("age_group"))
)
query("m30_line_total")(
    lambda w: w.view("transaction_items").select(
        "item_id", "product_id", e.line_total(F.col("total_price"), "quantity").alias("line_total")
    )
)
query("m31_segment_names")(
    lambda w: segmentation.segment_names(w.formula_clusters(), "cluster").select("customer_id", "cluster", "segment_type")
)


# ---- engineered features -------------------------------------------------------------

def _unified(*columns: str):
    return lambda w: w.unified.select("customer_id", *columns)


query("f1_age_and_recency")(_unified("customer_age_days", "days_since_last_purchase"))
query("f2_purchase_velocity")(_unified("purchase_velocity"))
query("f3_engagement_normalized")(_unified("engagement_score_normalized"))
query("f4_session_intensity")(_unified("session_intensity", "conversion_efficiency"))
query("f5_behaviour")(_unified("search_intensity", "product_exploration", "cart_behavior"))
query("f6_rfm_composite")(_unified("rfm_composite", "value_engagement_ratio"))
query("f7_campaign_response")(_unified("campaign_response_rate", "ab_test_impact"))
query("f8_risk_and_potential")(_unified("churn_risk", "upsell_potential", "lifetime_value_potential"))
query("f9_flags")(_unified("is_high_value", "is_engaged", "is_mobile_user", "is_return_visitor"))
query("f10_fill_typed")(_unified("age_group", "household_size", "interests", "avg_roas", "campaign_count"))
query("unified_customers")(lambda w: w.unified)
query("f11_impute_median")(
    lambda w: features.impute_median(
        w.order_history.select("customer_id", "avg_days_between_orders", "revenue_90d"),
        ["avg_days_between_orders", "revenue_90d"],
    )
)
query("f12_impute_mode")(
    lambda w: features.impute_mode(w.view("customer_demographics").select("customer_id", "age_group"), "age_group")
)
query("f13_clip_iqr")(
    lambda w: features.clip_iqr(
        w.rfm.select("customer_id", "monetary_value", "frequency"), ["monetary_value", "frequency"]
    )
)
query("f14_minmax")(
    lambda w: features.minmax(segmentation.radar_means(w.stored, "rfm_segment"), ["monetary_value", "frequency"]).select(
        "rfm_segment", "monetary_value_normalized", "frequency_normalized"
    )
)
query("f15_standardize")(
    lambda w: features.standardize(w.rfm.select("customer_id", "recency_days", "frequency"), ["recency_days", "frequency"])
)


@query("f16_cut")
def _(w):
    share = w.rfm.select(
        "customer_id",
        "recency_days",
        ((F.col("recency_days") % 111) / F.lit(100.0)).alias("p"),
    )
    return share.select(
        "customer_id",
        e.cut("p", *k.SUCCESS_BINS).alias("success_category"),
        e.cut("recency_days", *k.BUDGET_BINS).alias("budget_category"),
        e.cut("recency_days", *k.ROI_BINS).alias("roi_category"),
        e.cut("p", *k.STAGE_BINS).alias("stage_category"),
        e.cut("p", *k.CONVERSION_BINS).alias("conversion_category"),
        e.cut("p", *k.STAGE_BINS_COARSE).alias("stage_coarse"),
        e.cut("p", *k.PROBABILITY_BINS_COARSE).alias("probability_coarse"),
    )


query("f17_cut_equal")(
    lambda w: features.cut_equal(w.rfm.select("customer_id", "recency_days"), "recency_days", k.FIVE_LEVELS, "level")
)
query("f18_calendar")(
    lambda w: features.calendar_features(w.customers.select("customer_id", "registration_date"), "registration_date")
)
query("f19_journey_stage")(lambda w: features.journey_features(w.stored, AS_OF).select("customer_id", "journey_stage"))
query("f20_conversion_probability")(
    lambda w: features.journey_features(w.stored, AS_OF).select("customer_id", "conversion_probability")
)
query("f21_journey_ratios")(
    lambda w: features.journey_features(w.stored, AS_OF).select(
        "customer_id", "avg_session_duration", "bounce_rate", "engagement_score", "days_since_first_visit",
        "visit_frequency", "avg_product_views", "cart_add_rate", "purchase_rate",
    )
)
query("f22_campaign_labels")(
    lambda w: features.label_optimal_budget(features.label_campaign_success(w.stored)).select(
        "customer_id", "campaign_success", "optimal_budget"
    )
)
query("f22_history_labels")(
    lambda w: features.label_history(w.stored).select(
        "customer_id", "label_success", "label_budget", "label_revenue", "label_ctr", "label_stage", "label_conversion"
    )
)
query("f23_order_counts")(
    lambda w: w.order_history.select("customer_id", "order_count_30d", "order_count_90d", "order_count_365d")
)
query("f24_trailing_revenue")(lambda w: w.order_history.select("customer_id", "revenue_30d", "revenue_90d", "revenue_365d"))
query("f25_days_between_orders")(lambda w: w.order_history.select("customer_id", "avg_days_between_orders"))
query("f26_order_totals")(lambda w: w.order_history.select("customer_id", "total_orders", "days_since_first_order"))
query("f27_simulated_lags")(
    lambda w: features.simulated_lags(w.stored).select(
        "customer_id", "revenue_lag_1", "revenue_lag_7", "revenue_lag_30", "revenue_ma_7", "revenue_ma_30",
        "ctr", "ctr_lag_1", "ctr_ma_7",
    )
)
query("f27_point_in_time_lags")(lambda w: w.forecast_lags(w.stored, True))
query("f27_scoring_lags")(lambda w: w.forecast_lags(w.stored, False))
query("f28_revenue_lags")(lambda w: features.revenue_lags(w.sold, AS_OF))
query("f28_latest_lags")(lambda w: features.latest_lags(features.revenue_lags(w.sold, AS_OF)))
query("f29_roi_and_value")(
    lambda w: w.rfm.select(
        "customer_id",
        features.roi_estimate("recency_days").alias("estimated_roi"),
        features.expected_value("purchase_frequency_rate").alias("expected_value"),
    )
)
query("f30_campaign_plan")(
    lambda w: features.campaign_plan(
        w.campaign_data.select("campaign_id", "budget", F.col("total_impressions").alias("target_audience_size"))
    )
)
query("f31_journey_path")(
    lambda w: features.journey_path(
        w.journey.select(
            "customer_id",
            F.when(F.col("purchase_events") > 0, "purchase")
            .when(F.col("total_search_queries") > 2, "search")
            .when(F.col("total_page_views") > 0, "browse")
            .alias("journey"),
        ),
        3,
    )
)
query("f32_forecast_band")(
    lambda w: features.forecast_band(w.formula_scores("revenue").select("customer_id", "predicted_revenue"), "predicted_revenue", AS_OF, 30)
)


# ---- models --------------------------------------------------------------------------

def _fitted(w: Warehouse, name: str, history: bool) -> dict[str, object]:
    return {name: w.history_model(name) if history else w.model(name)}


def _metrics_of(name: str, history: bool = False):
    """Everything but the flag; of the clipped history matrix also without the cost of one cluster."""
    left_out = ["beats_baseline"] + ["baseline_cost"] * history
    return lambda w: sound(
        model_values(w.spark, _fitted(w, name, history)).filter(F.col("value").isNotNull() & ~F.col("metric").isin(left_out))
    )


def _values_of(name: str, history: bool = False):
    return lambda w: model_values(w.spark, _fitted(w, name, history))


# what the next queries hide from SQL, which cannot fit a model: every value
for _plain, _variant, _model in (
    ("l1_kmeans", "l1_kmeans_history", "kmeans"),
    ("l6_success_classifier", "l6_success_classifier_history", "campaign_success"),
    ("l7_budget_regressor", "l7_budget_regressor_history", "budget"),
    ("l8_revenue_regressor", "l8_revenue_regressor_history", "revenue"),
    ("l9_ctr_regressor", "l9_ctr_regressor_history", "ctr"),
    ("l10_stage_classifier", "l10_stage_classifier_history", "journey_stage"),
    ("l11_conversion_regressor", "l11_conversion_classifier_history", "conversion"),
):
    query(f"{_plain}_values")(_values_of(_model))
    query(f"{_variant}_values")(_values_of(_model, history=True))
query("l1_kmeans")(_metrics_of("kmeans"))
query("l1_kmeans_history")(_metrics_of("kmeans", history=True))
query("l2_density_segments")(lambda w: density.density_segments(w.stored, DENSITY_FEATURES))
query("l2_density_wide_radius")(
    lambda w: density.density_segments(w.stored, DENSITY_FEATURES, eps=2.5, min_cluster_size=10)
)
query("l2_density_recency_frequency")(
    lambda w: density.density_segments(w.stored, ["recency_days", "frequency"], eps=0.1, min_samples=10, min_cluster_size=50)
)
query("l2_core_distances")(
    lambda w: hierarchy.point_core_distances(w.stored, ["recency_days", "frequency"]).withColumn("core", F.round("core", 6))
)
query("l2_tree_components")(
    lambda w: hierarchy.component_counts(w.stored, ["recency_days", "frequency"], [0.05, 0.1, 0.2, 0.4, 0.8])
)
# selection by excess of mass is not SQL: tests/test_hierarchy.py has a plain version
query("l2_hierarchy_segments")(lambda w: hierarchy.hierarchy_segments(w.stored, DENSITY_FEATURES, min_cluster_size=20))
query("l2_hierarchy_recency_frequency")(
    lambda w: hierarchy.hierarchy_segments(w.stored, ["recency_days", "frequency"], min_cluster_size=20)
)
query("l3_silhouette")(
    lambda w: w.spark.createDataFrame(
        [(metrics.silhouette(w.formula_clusters(), ["recency_days", "frequency"], "cluster"),)], "silhouette double"
    )
)
query("l4_calinski_harabasz")(
    lambda w: metrics.calinski_harabasz(w.formula_clusters(), ["recency_days", "frequency"], "cluster")
)
query("l5_cluster_stats")(lambda w: metrics.cluster_stats(w.formula_clusters(), "cluster"))
query("l6_success_classifier")(_metrics_of("campaign_success"))
query("l6_success_classifier_history")(_metrics_of("campaign_success", history=True))
# a constant label has no r2
query("l7_budget_regressor")(lambda w: _metrics_of("budget")(w).filter("metric <> 'r2'"))
query("l7_budget_regressor_history")(_metrics_of("budget", history=True))
query("l8_revenue_regressor")(_metrics_of("revenue"))
query("l8_revenue_regressor_history")(_metrics_of("revenue", history=True))
query("l9_ctr_regressor")(_metrics_of("ctr"))
query("l9_ctr_regressor_history")(_metrics_of("ctr", history=True))
query("l10_stage_classifier")(_metrics_of("journey_stage"))
query("l10_stage_classifier_history")(_metrics_of("journey_stage", history=True))
query("l11_conversion_regressor")(_metrics_of("conversion"))
query("l11_conversion_classifier_history")(_metrics_of("conversion", history=True))
query("l12_regression_metrics")(
    lambda w: metrics.regression_metrics(w.formula_scores("revenue"), "actual_revenue", "predicted_revenue")
)


@query("l13_classification_metrics")
def _(w):
    guess = (
        F.when(F.col("total_sessions") > 7, "Explorer")
        .when(F.col("click_events") > 2, "Converter")
        .otherwise(F.col("journey_type"))
    )
    return metrics.classification_metrics(w.journey.withColumn("guess", guess), "journey_type", "guess")


query("l14_stratified_folds")(
    lambda w: splits.stratified_folds(features.label_history(w.stored).select("customer_id", "label_stage"), "label_stage")
)


def _cross_validated(w: Warehouse, target: str, kind: str) -> DataFrame:
    result = w.once(
        f"folds of {target}", lambda: forests.cross_validate(w.history_train, k.ORDER_HISTORY_FEATURES, target, kind)
    )
    return w.spark.createDataFrame([(name, float(v)) for name, v in result.items()], "metric string, value double")


def _cross_validation(target: str, kind: str):
    values = _cross_validation_values(target, kind)
    return lambda w: sound(values(w).filter(~F.col("metric").isin("beats_baseline", "baseline_cv_r2")))


def _cross_validation_values(target: str, kind: str):
    """With the rows, and the accuracy of the most frequent class; the mean of a fold has R2 0."""

    def build(w: Warehouse) -> DataFrame:
        rows = w.history_train.filter(F.col(target).isNotNull())
        guess = forests.guess_metrics(rows, rows, target, kind)
        name, least = ("cv_r2", 0.0) if kind == forests.REGRESSION else ("cv_accuracy", guess["baseline_accuracy"])
        values = _cross_validated(w, target, kind)
        more = [("n_rows", float(guess["n_train"])), (f"baseline_{name}", least)]
        better = values.filter(F.col("metric") == f"{name}_mean").select(
            F.lit("beats_baseline").alias("metric"), (F.col("value") > least).cast("double").alias("value")
        )
        return values.union(w.spark.createDataFrame(more, values.schema)).union(better)

    return build


for _name, _target, _kind in (
    ("l14_cross_validation", "label_budget", forests.REGRESSION),
    ("l14_cross_validation_accuracy", "label_conversion", forests.CLASSIFICATION),
):
    query(_name)(_cross_validation(_target, _kind))
    query(f"{_name}_values")(_cross_validation_values(_target, _kind))


scored(
    "l15_score_segments", lambda w: scoring.score_segments(w.model("kmeans"), w.infer_part), "customer_id kmeans_confidence",
    "kmeans_segment between 0 and 4", "kmeans_segment_type = concat('Segment_', kmeans_segment)", "kmeans_segment_size > 0",
)
scored(
    "l15_score_segments_named", lambda w: scoring.score_segments_named(w.history_model("kmeans"), w.history_infer),
    "customer_id", "kmeans_segment between 0 and 4", "kmeans_segment_type is not null",
)
query("l15_score_density")(lambda w: scoring.score_density(w.stored, DENSITY_FEATURES, eps=2.5, min_cluster_size=10))
FORECAST = "customer_id forecast_confidence forecast_period forecast_date"

scored(
    "l16_score_revenue", lambda w: scoring.score_revenue(w.model("revenue"), training_inputs(w), AS_OF), FORECAST,
    "predicted_revenue >= 0", within=("predicted_revenue", "revenue"),
)


def _revenue_levels(w: Warehouse) -> DataFrame:
    scores = scoring.score_revenue(w.history_model("revenue"), w.history_infer, AS_OF)
    return scoring.with_levels(scores, "predicted_revenue", "level")


query("l16_score_revenue_levels_values")(_revenue_levels)


@query("l16_score_revenue_levels")
def _(w):
    scores = scoring.score_revenue(w.history_model("revenue"), w.history_infer, AS_OF)
    levels = scoring.with_levels(scores, "predicted_revenue", "level").withColumns(
        {name: scores.agg(edge("predicted_revenue")).scalar() for name, edge in (("low", F.min), ("high", F.max))}
    )
    place = "ceil((predicted_revenue - low) / (high - low) * 5)"
    named = f"level = element_at(array({', '.join(repr(n) for n in k.FIVE_LEVELS)}), cast(greatest({place}, 1) as int))"
    ranged = label_range("predicted_revenue", w.history_model("revenue"))
    return consistent(levels, FORECAST, "predicted_revenue >= 0", ranged, named)


scored(
    "l17_score_ctr", lambda w: scoring.score_ctr(w.model("ctr"), training_inputs(w), AS_OF), FORECAST, "predicted_ctr >= 0",
    within=("predicted_ctr", "ctr"),
)
scored(
    "l18_score_stage",
    lambda w: scoring.score_stage(w.model("journey_stage"), features.journey_features(w.infer_part, AS_OF)), "customer_id",
    "predicted_journey_stage is not null", "stage_confidence between 0 and 1", in_bins("stage_confidence", "stage_category", STAGE),
)
scored(
    "l18_score_stage_history",
    lambda w: scoring.score_stage(w.history_model("journey_stage"), w.history_infer, k.STAGE_BINS_COARSE), "customer_id",
    "predicted_journey_stage is not null", "stage_confidence between 0 and 1",
    in_bins("stage_confidence", "stage_category", STAGE_COARSE),
)
scored(
    "l19_score_conversion",
    lambda w: scoring.score_conversion(w.model("conversion"), features.journey_features(w.infer_part, AS_OF)),
    "customer_id conversion_confidence", "predicted_conversion_probability between 0 and 1",
    "abs(expected_value - 100 * predicted_conversion_probability) < 1e-6",
    in_bins("predicted_conversion_probability", "conversion_category", CONVERSION),
    within=("predicted_conversion_probability", "conversion"),
)
scored(
    "l19_score_conversion_class",
    lambda w: scoring.score_conversion_class(w.history_model("conversion"), w.history_infer), "customer_id",
    "conversion_probability between 0 and 1", "conversion_prediction = cast(conversion_probability > 0.5 as int)",
    in_bins("conversion_probability", "conversion_category", PROBABILITY_COARSE),
)
scored(
    "l20_score_success", lambda w: scoring.score_success(w.model("campaign_success"), w.infer_part), "customer_id",
    "predicted_campaign_success in ('low', 'medium', 'high')", "success_probability between 0 and 1",
    "abs(success_confidence - greatest(success_probability, 1 - success_probability)) < 1e-9",
    in_bins("success_probability", "success_category", SUCCESS),
)
scored(
    "l20_score_success_class",
    lambda w: scoring.score_success_class(w.history_model("campaign_success"), w.history_infer), "customer_id",
    "success_probability between 0 and 1", "success_prediction = cast(success_probability > 0.5 as int)",
    in_bins("success_probability", "success_category", PROBABILITY_COARSE),
)
scored(
    "l21_score_budget", lambda w: scoring.score_budget(w.model("budget"), w.infer_part), "customer_id budget_confidence",
    "predicted_optimal_budget >= 0", in_bins("predicted_optimal_budget", "budget_category", BUDGET),
    in_bins("estimated_roi", "roi_category", ROI), within=("predicted_optimal_budget", "budget"),
)


@query("l22_score_all_values")
def _(w):
    """Every value of every score table: family, model, customer_id, measure, value as text."""
    parts = []
    for (family, model), scores in scoring.score_all(w.models, w.infer_part, AS_OF, DENSITY_FEATURES, w.infer_lags).items():
        values = publish(scores)
        measures = [c for c in values.columns if c != "customer_id"]
        pairs = F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).cast("string").alias("value")) for c in measures))
        parts.append(
            values.select(F.lit(family).alias("family"), F.lit(model).alias("model"), "customer_id", F.inline(pairs))
        )
    return reduce(DataFrame.unionByName, parts)


@query("l22_score_all")
def _(w):
    return reports.master_report(scoring.score_all(w.models, w.infer_part, AS_OF, DENSITY_FEATURES, w.infer_lags))


def _segment_requests(w: Warehouse) -> DataFrame:
    trained = features.with_purchases(w.train_part)
    measures = ["monetary_value", "frequency", "recency_days", "engagement_score"]
    placed = segmentation.assign_segments(w.model("kmeans"), trained, ["customer_id", *measures])
    profile = segmentation.segment_summary(placed, "segment")
    return scoring.score_segment_requests(w.model("kmeans"), profile, w.stored, AS_OF)


scored(
    "l23_segment_requests", _segment_requests, "customer_id confidence_score inference_date",
    "segment between 0 and 4", "segment_type is not null", "customer_count > 0",
)


# ---- reports -------------------------------------------------------------------------

query("d1_profile")(lambda w: profiling.profile(w.customers))
query("d1_profile_counts")(
    lambda w: profiling.profile(w.demographics).filter(F.col("section").isin("missing", "duplicates", "value_count", "feature_category"))
)
query("d2_rfm_display")(lambda w: rfm.rfm_display(rfm.rfm_summary(w.rfm)))
query("d3_dq_summary")(
    lambda w: cleanup.dq_summary(
        {
            "customers": (w.customers, w.view("customers")),
            "transactions": (w.transactions, w.view("transactions")),
            "campaigns": (w.campaigns, w.view("campaigns")),
            "ab_tests": (w.ab_tests, w.view("ab_tests")),
        }
    ).orderBy("table_name")
)
query("d4_campaign_display")(
    lambda w: campaign.campaign_display(campaign.channel_summary(w.campaign_data), campaign.type_summary(w.campaign_data))
)
query("d5_journey_display")(lambda w: journey.journey_display(journey.journey_summary(w.journey)))
query("d6_ab_display")(lambda w: abtest.ab_display(abtest.ab_summary(w.ab)))


@query("d7_segment_report")
def _(w):
    placed = w.formula_clusters().withColumnRenamed("cluster", "demo_segment")
    stats = segmentation.segment_stats(placed, "demo_segment")
    scores = segmentation.attach_segment_profile(placed.select("customer_id", "demo_segment"), stats, "demo_segment", "demo")
    return reports.segment_report(scores, "demo")


query("d8_forecast_report")(lambda w: reports.forecast_report(w.formula_scores("revenue"), "predicted_revenue"))
query("d9_journey_report_stage")(lambda w: reports.journey_report(w.formula_scores("journey_stage"), "journey_stage"))
query("d9_journey_report_conversion")(
    lambda w: reports.journey_report(w.formula_scores("conversion_prediction"), "conversion_prediction")
)
query("d10_campaign_report_success")(
    lambda w: reports.campaign_report(w.formula_scores("campaign_success"), "campaign_success")
)
query("d10_campaign_report_budget")(
    lambda w: reports.campaign_report(w.formula_scores("budget_optimization"), "budget_optimization")
)
@query("d10_probability_report")
def _(w):
    p = F.col("predicted_conversion_probability")
    scores = w.formula_scores("conversion_prediction").select(
        p, (p > 0.5).cast("int").alias("decision"), e.cut(p, *k.PROBABILITY_BINS_COARSE).alias("category")
    )
    return reports.probability_report(scores, "predicted_conversion_probability", "category", "decision")


query("d11_master_report")(lambda w: reports.master_report(_formula_tables(w)))


def _training_report(w: Warehouse) -> DataFrame:
    more = w.once("folds and density", lambda: training.further_metrics(w.train_part, eps=2.5, min_cluster_size=10))
    return reports.training_report(metrics_table(w.spark, w.models, more))


query("d12_training_report")(_training_report)
# names of all rows, and the values that do not depend on a fitted model
query("d12_training_report_rows")(
    lambda w: _training_report(w).select(
        "section", "key", F.when(F.col("key").isin("n_estimators", "max_depth", "n_rows"), F.col("value")).alias("value")
    ).filter("section not in ('density', 'best_model') and key <> 'r2'")
)
query("d13_chart_histogram")(lambda w: reports.chart_histogram(w.formula_scores("revenue"), "predicted_revenue", 50))
query("d13_chart_scatter")(lambda w: reports.chart_scatter(w.stored, "recency_days", "monetary_value", 0.5))
query("d13_chart_radar")(lambda w: reports.chart_radar(w.stored, "rfm_segment"))
query("d14_table_counts")(
    lambda w: reports.table_counts(
        {
            name: w.view(name)
            for name in (
                "customers", "customer_demographics", "transactions", "transaction_items", "campaigns",
                "campaign_performance", "ab_tests", "ab_test_results", "sessions", "page_views",
                "click_events", "product_interactions", "search_queries",
            )
        }
    )
)


# ---- data quality --------------------------------------------------------------------

query("dq1_key_violations")(lambda w: quality.unique_violations(w.view("transaction_items"), PRIMARY_KEYS["transaction_items"]))
query("dq1_composite_key")(
    lambda w: quality.unique_violations(w.view("transactions"), ["customer_id", "order_date"])
)
query("dq2_required")(lambda w: quality.required_violations(w.view("page_views"), REQUIRED["page_views"]))
query("dq3_orphans")(
    lambda w: quality.orphans(w.view("ab_tests"), w.campaigns, "campaign_id").select("test_id", "campaign_id")
)
query("dq4_cascade")(
    lambda w: quality.propagate_deletes(w.view("customer_demographics"), w.customers, "customer_id", "cascade").select(
        "customer_id", "household_size"
    )
)
query("dq4_set_null")(
    lambda w: quality.propagate_deletes(w.view("transactions"), w.customers, "customer_id", "set_null").select(
        "transaction_id", "customer_id"
    )
)
query("dq5_domain")(
    lambda w: quality.domain_violations(w.view("ab_test_results"), "variant", DOMAINS["ab_test_results", "variant"]).select(
        "result_id", "variant"
    )
)
query("dq6_customer_rejects")(
    lambda w: cleanup.rejects(w.view("customers"), cleanup.customer_rules(AS_OF)).select("customer_id", "failed_rules")
)
query("dq6_campaign_rejects")(
    lambda w: cleanup.rejects(w.view("campaigns"), cleanup.campaign_rules()).select("campaign_id", "failed_rules")
)
query("dq7_defaults")(
    lambda w: quality.apply_defaults(
        w.view("campaigns").select("campaign_id", F.nullif("status", F.lit("Paused")).alias("status")), DEFAULTS["campaigns"]
    )
)


@query("dq7_touch")
def _(w):
    before = w.view("campaigns").select("campaign_id", "status", F.lit("2001-01-01").cast("timestamp_ntz").alias("updated_at"))
    after = before.withColumn("status", F.when(F.col("status") == "Paused", "Active").otherwise(F.col("status")))
    return quality.touch(after, AS_OF, before, "campaign_id").withColumn("updated_at", F.to_date("updated_at"))
