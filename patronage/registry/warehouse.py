"""All tables of the sample, built lazily and once per session."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.functions import constants as k
from patronage.functions.expr import cut
from patronage.models import training
from patronage.models.scoring import binned
from patronage.operators import abtest, campaign, cleanup, features, journey, rfm, splits
from patronage.operators.features import expected_value, roi_estimate
from patronage.plans import unify
from patronage.session import prepare_checkpoint_dir, cut_lineage
from patronage.sources.sample_views import sample_view

AS_OF = date(2001, 8, 2)

_memo: dict[tuple[object, ...], object] = {}


def _contents(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """Path, length and time of what a folder holds: other data in it is another sample."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in listed))


class Warehouse:
    """Source, cleaned and derived tables of one sample folder."""

    as_of = AS_OF

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.contents = _contents(spark, sf_dir)
        self._views: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        """The session's warehouse for a folder. It holds logical plans, so sharing it saves
        analysis, not computation."""
        key = (spark.sparkContext.applicationId, sf_dir, _contents(spark, sf_dir), "warehouse")
        if key not in _memo:
            _memo[key] = cls(spark, sf_dir)
        return _memo[key]

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            self._views[name] = sample_view(self.spark, self.sf_dir, name, self.view)
        return self._views[name]

    def once(self, name: str, build: Callable[[], object]) -> object:
        """Build once per application and sample; used for stored tables and models."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.contents, name)
        if key not in _memo:
            _memo[key] = build()
        return _memo[key]

    def scratch(self, name: str) -> str:
        """A fresh folder for a written table, in the folder all executors share."""
        prepare_checkpoint_dir(self.spark)
        return f"{self.spark.sparkContext.getCheckpointDir()}/written-{uuid4().hex[:8]}/{name}"

    # ---- cleaned tables
    @cached_property
    def customers(self) -> DataFrame:
        return cleanup.clean_customers(self.view("customers"), AS_OF)

    @cached_property
    def demographics(self) -> DataFrame:
        return cleanup.clean_demographics(self.view("customer_demographics"), self.customers)

    @cached_property
    def transactions(self) -> DataFrame:
        return cleanup.clean_transactions(self.view("transactions"), self.customers, AS_OF)

    @cached_property
    def items(self) -> DataFrame:
        return cleanup.clean_items(self.view("transaction_items"), self.transactions)

    @cached_property
    def campaigns(self) -> DataFrame:
        return cleanup.clean_campaigns(self.view("campaigns"))

    @cached_property
    def performance(self) -> DataFrame:
        return cleanup.clean_campaign_performance(self.view("campaign_performance"), self.campaigns)

    @cached_property
    def ab_tests(self) -> DataFrame:
        return cleanup.clean_ab_tests(self.view("ab_tests"), self.campaigns)

    @cached_property
    def ab_test_results(self) -> DataFrame:
        return cleanup.clean_ab_results(self.view("ab_test_results"), self.ab_tests)

    @cached_property
    def sold(self) -> DataFrame:
        return cleanup.successful_orders(self.transactions)

    # ---- analyses
    # Each analysis starts from a clean parent table and joins sums of its child rows to it,
    # which drops children of rejected parents by itself. So child rows need only their own
    # rules here: no semi join before the sums, and a parent with a large share of the rows
    # is combined on the map side instead of meeting in one join task.
    @cached_property
    def valid_transactions(self) -> DataFrame:
        return cleanup.passing(self.view("transactions"), cleanup.transaction_rules(AS_OF))

    @cached_property
    def valid_items(self) -> DataFrame:
        return cleanup.passing(self.view("item_lines"), cleanup.item_rules())

    @cached_property
    def valid_performance(self) -> DataFrame:
        return cleanup.passing(self.view("campaign_performance"), cleanup.performance_rules())

    @cached_property
    def valid_results(self) -> DataFrame:
        return cleanup.passing(self.view("ab_test_results"), cleanup.ab_result_rules())

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm.customer_rfm(self.customers, self.valid_transactions, self.valid_items, AS_OF)

    @cached_property
    def campaign_data(self) -> DataFrame:
        return campaign.campaign_segments(campaign.campaign_metrics(self.campaigns, self.valid_performance))

    @cached_property
    def journey(self) -> DataFrame:
        return journey.customer_journey(
            self.customers,
            self.view("sessions"),
            self.view("page_views"),
            self.view("click_events"),
            self.view("product_interactions"),
            self.view("search_queries"),
        )

    @cached_property
    def ab(self) -> DataFrame:
        return abtest.ab_results(self.ab_tests, self.valid_results)

    @cached_property
    def joined(self) -> DataFrame:
        return unify.join_customer_tables(
            unify.load_rfm(self.rfm),
            unify.project_demographics(cleanup.passing(self.view("customer_demographics"), cleanup.demographics_rules())),
            self.journey,
            self.campaign_data,
            self.ab,
        )

    @cached_property
    def unified(self) -> DataFrame:
        # RFM is an inner join on the key, so no row lacks it
        filled = unify.fill_typed(unify.engineer_features(self.joined, AS_OF), keep=["customer_id"])
        return unify.stamp(filled, "1.0", AS_OF)

    @cached_property
    def order_history(self) -> DataFrame:
        return features.order_history_features(self.sold, AS_OF)

    # ---- stored feature table and what is derived from it
    @property
    def stored(self) -> DataFrame:
        """The unified table with order history, written once and read by many jobs."""
        history = features.order_history_features(cleanup.successful_orders(self.valid_transactions), AS_OF)
        return self.once("unified", lambda: cut_lineage(unify.attach_order_history(self.unified, history)))

    @property
    def train_part(self) -> DataFrame:
        return splits.timeline_split(self.stored, AS_OF)[0]

    @property
    def infer_part(self) -> DataFrame:
        return splits.timeline_split(self.stored, AS_OF)[1]

    @property
    def history_infer(self) -> DataFrame:
        """Scoring rows of the order-history variant, imputed and clipped among themselves."""
        return features.prepare_matrix(self.infer_part, k.ORDER_HISTORY_FEATURES)

    @property
    def click_days(self) -> DataFrame:
        """Clicks per audience and day, stored: every lag table looks them up, campaign rows are summed once."""
        return self.once("click days", lambda: cut_lineage(features.daily_clicks(self.valid_performance, self.campaigns)))

    def forecast_lags(self, part: DataFrame, at_last_order: bool) -> DataFrame:
        orders = cleanup.successful_orders(self.valid_transactions)
        labels = features.label_days(part, AS_OF, at_last_order)
        return features.lags_of_days(labels, features.daily_revenue(orders), self.click_days)

    @property
    def train_lags(self) -> DataFrame:
        return self.once("train lags", lambda: cut_lineage(self.forecast_lags(self.train_part, True)))

    @property
    def infer_lags(self) -> DataFrame:
        return self.once("infer lags", lambda: cut_lineage(self.forecast_lags(self.infer_part, False)))

    def model(self, name: str) -> object:
        lags = self.train_lags if name in ("revenue", "ctr") else None
        return self.once(f"model {name}", lambda: training.TRAINERS[name](self.train_part, AS_OF, lags))

    @property
    def history_train(self) -> DataFrame:
        """Training rows of the order-history variant, with labels."""
        return self.once("history inputs", lambda: cut_lineage(training.history_inputs(self.train_part)))

    def history_model(self, name: str) -> object:
        return self.once(f"history model {name}", lambda: training.train_history(name, self.history_train))

    @property
    def models(self) -> dict[str, object]:
        return {name: self.model(name) for name in training.TRAINERS}

    # ---- score tables by formula: stand-ins for model output that SQL can repeat
    def formula_scores(self, model: str) -> DataFrame:
        u = self.stored
        share = (F.col("recency_days") % 101) / F.lit(100.0)
        if model == "revenue":
            return u.select(
                "customer_id",
                (F.col("monetary_value").cast("double") * 0.9 + F.col("recency_days") * 0.1).alias("predicted_revenue"),
                F.col("monetary_value").cast("double").alias("actual_revenue"),
            )
        if model == "journey_stage":
            scores = u.select(
                "customer_id",
                F.col("journey_type").alias("predicted_journey_stage"),
                ((F.col("recency_days") % 61 + 40) / F.lit(100.0)).alias("stage_confidence"),
            )
            return binned(scores, "stage_confidence", k.STAGE_BINS, "stage_category")
        if model == "conversion_prediction":
            scores = u.select(
                "customer_id",
                share.alias("predicted_conversion_probability"),
                F.lit(0.85).alias("conversion_confidence"),
            )
            return binned(
                scores, "predicted_conversion_probability", k.CONVERSION_BINS, "conversion_category"
            ).withColumn("expected_value", expected_value("predicted_conversion_probability"))
        if model == "campaign_success":
            scores = u.select(
                "customer_id",
                F.when(F.col("rfm_score") >= 400, "high").when(F.col("rfm_score") >= 200, "medium").otherwise("low").alias(
                    "predicted_campaign_success"
                ),
                share.alias("success_probability"),
                F.greatest(share, F.lit(1.0) - share).alias("success_confidence"),
            )
            return binned(scores, "success_probability", k.SUCCESS_BINS, "success_category")
        if model == "budget_optimization":
            scores = u.select(
                "customer_id",
                (F.col("recency_days") * F.lit(2.5)).alias("predicted_optimal_budget"),
                F.lit(0.85).alias("budget_confidence"),
            )
            with_roi = scores.withColumns(
                {
                    "budget_category": cut("predicted_optimal_budget", *k.BUDGET_BINS),
                    "estimated_roi": roi_estimate("predicted_optimal_budget"),
                }
            )
            return with_roi.withColumn("roi_category", cut("estimated_roi", *k.ROI_BINS))
        raise KeyError(model)

    def formula_clusters(self) -> DataFrame:
        """Clusters by frequency score, with the long-inactive as noise."""
        cluster = F.when(F.col("recency_days") > 1500, -1).otherwise(F.col("frequency_score"))
        return self.stored.withColumn("cluster", cluster)
