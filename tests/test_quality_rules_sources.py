import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from patronage.operators import profiling, quality, rules
from patronage.plans import reports
from patronage.sources import manifest, tables
from patronage.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, REQUIRED, SCHEMAS, UNIQUE_KEYS

AS_OF = date(2001, 8, 2)


def test_declared_schemas_parse(spark):
    from pyspark.sql.types import StructType

    assert len(SCHEMAS) == 15
    for name, ddl in SCHEMAS.items():
        fields = set(StructType.fromDDL(ddl).names)
        assert set(PRIMARY_KEYS[name]) <= fields and set(REQUIRED.get(name, [])) <= fields
        assert all(set(keys) <= fields for keys in UNIQUE_KEYS.get(name, []))
    assert all(child in SCHEMAS and parent in SCHEMAS for child, _, parent, _ in FOREIGN_KEYS)


@pytest.fixture(scope="module")
def family(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 2), ("d", 2)], "id string, k int")
    return child, parent


def test_keys_and_orphans(family):
    child, parent = family
    assert [tuple(r) for r in quality.unique_violations(child, ["id"]).collect()] == [("d", 2)]
    assert [r["id"] for r in quality.orphans(child, parent, "k").collect()] == ["b"]
    assert {r[0]: r[1] for r in quality.required_violations(child, ["id", "k"]).collect()} == {"id": 0, "k": 1}


def test_delete_rules(family):
    child, parent = family
    assert sorted(r["id"] for r in quality.propagate_deletes(child, parent, "k", "cascade").collect()) == ["a", "c", "d", "d"]
    kept = sorted((r["id"], r["k"]) for r in quality.propagate_deletes(child, parent, "k", "set_null").fillna(-1).collect())
    assert kept == [("a", 1), ("b", -1), ("c", -1), ("d", 2), ("d", 2)]
    with pytest.raises(ValueError):
        quality.propagate_deletes(child, parent, "k", "other")


def test_touch_only_changed_rows(spark):
    schema = "id int, v string, updated_at timestamp_ntz"
    before = spark.createDataFrame([(1, "a", datetime(2000, 1, 1)), (2, None, datetime(2000, 1, 1))], schema)
    after = spark.createDataFrame([(1, "b", None), (2, None, None), (3, "c", None)], schema)
    got = {r["id"]: r["updated_at"].year for r in quality.touch(after, AS_OF, before, "id").collect()}
    assert got == {1: 2001, 2: 2000, 3: 2001}


def test_rule_segments(spark):
    customers = spark.createDataFrame(
        [("a", 5, 2000.0, 1, 10, date(2001, 7, 20), True), ("b", 111, 10.0, 11, 29, date(1999, 1, 1), True),
         ("c", 111, 10.0, 2, 181, date(1999, 1, 1), False), ("d", 111, 10.0, 3, 91, None, None)],
        "customer_id string, rfm_score int, monetary_value double, frequency int, recency_days int, "
        "registration_date date, is_active boolean")
    got = sorted((r["customer_id"], r["segment_id"]) for r in rules.assign_rule_segments(customers, rules.default_segments(spark), AS_OF).collect())
    assert got == [("a", "SEG_001"), ("a", "SEG_004"), ("b", "SEG_002"), ("c", "SEG_003"), ("c", "SEG_005")]


def test_rule_on_unknown_column_is_refused(spark):
    segments = spark.createDataFrame([("S", '{"nope": ">1"}')], "segment_id string, criteria string")
    with pytest.raises(ValueError):
        rules.assign_rule_segments(spark.createDataFrame([("a",)], "customer_id string"), segments, AS_OF)


def test_csv_and_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, date(2001, 1, 1)), ("b", None, None)], "s string, n int, d date")
    for back in (
        tables.read_csv(spark, tables.write_csv(df, f"{tmp_path}/csv"), df.schema),
        tables.read_parquet(spark, tables.write_parquet(df, f"{tmp_path}/pq", ["s"])).select(df.columns),
    ):
        assert back.exceptAll(df).isEmpty() and back.count() == 2


def test_json_source_uses_declared_schema(spark, tmp_path):
    spark.createDataFrame([('{"event_id": "e1", "event_data": {"quantity": 2}, "extra": 1}',)], "value string").write.text(f"{tmp_path}/ev")
    events = tables.read_table(spark, "events", f"{tmp_path}/ev", "json")
    payload = events.select(F.try_variant_get(F.parse_json("event_data"), "$.quantity", "int")).first()[0]
    assert payload == 2 and "extra" not in events.columns


def test_partitioned_relational_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        tables.read_table(spark, "customers", "jdbc:none:", "jdbc", partition_column="customer_id")


def test_materialize_modes(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex[:8]
    path = f"{tmp_path}/table"
    assert tables.materialize(spark.range(3), name, "overwrite", path).count() == 3
    assert tables.materialize(spark.range(9), name, "ignore", path).count() == 3
    assert tables.materialize(spark.range(5), name, "overwrite", path).count() == 5


def test_snapshots(spark, tmp_path):
    base = f"{tmp_path}/scores"
    tables.write_snapshot(spark.range(3), base, datetime(2001, 1, 1))
    tables.write_snapshot(spark.range(7), base, datetime(2001, 1, 2))
    tables.write_snapshot(spark.range(4), base, datetime(2001, 1, 1))
    assert tables.read_latest_snapshot(spark, base).count() == 7
    assert spark.read.parquet(base).count() == 11


def test_manifest(spark, tmp_path):
    for name in ("model_20010101_000000.bin", "model_20010102_000000.bin", "other_20010101_000000.csv"):
        (tmp_path / name).write_text(name)
    listing = manifest.file_manifest(spark, str(tmp_path))
    assert listing.count() == 3 and "content" not in listing.columns
    newest = {r["family"]: r["path"].split("/")[-1] for r in manifest.latest_by_name(listing).collect()}
    assert newest == {"model": "model_20010102_000000.bin", "other": "other_20010101_000000.csv"}
    cached = listing.filter(~F.col("path").endswith(".csv"))
    assert [r["path"].split(".")[-1] for r in manifest.changed_files(listing, cached).collect()] == ["csv"]
    assert manifest.changed_files(listing, listing).isEmpty()
    assert {r["suffix"] for r in manifest.latest_by_suffix(listing, [".BIN", ".zip"]).collect()} == {".BIN"}


def test_profile_and_describe(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, None), ("a", 1.0)], "s string, v double")
    row = profiling.describe_exact(df, ["v"]).first()
    assert (row["count"], row["q50"], row["min"], row["max"]) == (3.0, 1.0, 1.0, 3.0)
    facts = {(r["section"], r["key"]): r["value"] for r in profiling.profile(df).collect()}
    assert facts["shape", "rows"] == "4" and facts["missing", "v"] == "1" and facts["duplicates", "rows"] == "1"
    assert facts["value_count", "s=a"] == "3" and facts["type", "v"] == "double"


def test_histogram_covers_all_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    bins = profiling.histogram(df, "v", 20).orderBy("bin").collect()
    assert len(bins) == 20 and sum(r["count"] for r in bins) == 101
    assert (bins[0]["bin_start"], bins[-1]["bin_end"], bins[-1]["count"]) == (0.0, 100.0, 6)
    assert profiling.histogram(df.filter("v = 3"), "v", 20).first()["count"] == 1


def test_label_mode_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert tuple(profiling.label_mode(df, "c").first()) == ("a", 2)


def test_master_report_totals(spark):
    rows = {(r[0], r[1]): (r[2], r[3]) for r in reports.master_report({("f", "m1"): spark.range(3), ("f", "m2"): spark.range(4), ("g", "m3"): spark.range(5)}).collect()}
    assert rows[None, None] == (3, 12) and rows["f", None] == (2, 7) and rows["g", "m3"] == (1, 5)
