from datetime import datetime

import pytest
from pyspark.sql import functions as F

from patronage.plans import batch, derive
from patronage.sources import tables
from patronage.sources.sample_views import VIEWS

from .conftest import AS_OF


@pytest.fixture(scope="module")
def derived(spark, warehouse, tmp_path_factory):
    sources = {name: warehouse.view(name) for name in VIEWS if name not in ("click_base", "item_lines")}
    sources["events"] = sources.pop("click_events")
    base = str(tmp_path_factory.mktemp("tables"))
    return derive.derive_tables(sources, AS_OF, keep=derive.in_folder(spark, base)), sources, base


def test_all_tables_are_written(derived):
    made, _, _ = derived
    assert len(made) == 21
    sizes = {name: df.count() for name, df in made.items()}
    assert sizes["customer_rfm_data"] == sizes["unified_customer_dataset"] == 1427
    assert sizes["transactions_clean"] == 14353 and sizes["campaign_performance_data"] == 96
    assert sizes["training_customer_dataset"] + sizes["recent_customer_dataset"] == 1427


def test_stored_steps_equal_one_plan(derived, warehouse):
    made, _, _ = derived
    columns = warehouse.rfm.columns
    assert made["customer_rfm_data"].select(columns).exceptAll(warehouse.rfm).isEmpty()
    assert made["customer_journey_data"].exceptAll(warehouse.journey).isEmpty()


def test_existing_tables_can_be_kept(spark, derived):
    _, sources, base = derived
    emptied = {name: df.limit(0) for name, df in sources.items()}
    again = derive.derive_tables(emptied, AS_OF, keep=derive.in_folder(spark, base, "ignore"))
    assert again["customer_rfm_data"].count() == 1427


def test_train_then_score(spark, derived, tmp_path):
    made, _, _ = derived
    run = datetime(2001, 8, 2, 9, 30)
    report = batch.run_training(
        spark, made["training_customer_dataset"], AS_OF, f"{tmp_path}/models", run, made["training_forecast_lags"],
        trees=5, depth=4,
    )
    rows = {(r["section"], r["key"]): r["value"] for r in report.collect()}
    known = made["training_customer_dataset"].count()
    assert rows["campaign_success", "n_rows"] == rows["budget", "n_rows"] == known
    assert 0 <= rows["campaign_success", "cv_accuracy_mean"] <= 1 and ("budget", "cv_r2_std") in rows
    assert rows["density", "n_clusters"] >= 0 and 0 <= rows["density", "n_noise"] <= known
    assert report.filter("section = 'best_model'").first()["key"] == "kmeans"
    master = batch.run_scoring(
        spark, made["recent_customer_dataset"], AS_OF, f"{tmp_path}/models", f"{tmp_path}/out", run,
        lags=made["recent_forecast_lags"],
    )
    total = master.filter(F.col("family").isNull()).first()
    assert total["models_run"] == 8 and total["total_predictions"] == 8 * made["recent_customer_dataset"].count()
    features = tables.read_csv(spark, f"{tmp_path}/models/forecasting/revenue/features", "feature string, position int")
    assert features.count() == 14
    stored = spark.read.json(f"{tmp_path}/out/journey_simulation/journey_stage/report")
    assert {"summary", "high_confidence", "stage_distribution"} <= {r[0] for r in stored.select("section").distinct().collect()}


def test_bucketed_table_needs_no_shuffle_for_its_key(spark, warehouse, tmp_path):
    kept = tables.materialize(
        warehouse.transactions, "bucketed_transactions", path=f"{tmp_path}/b", bucket_by="customer_id", buckets=4
    )
    plan = kept.groupBy("customer_id").agg(F.sum("total_amount"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and kept.count() == 14353
