import re

import pytest
from conftest import SF_DIR, START
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tradewatch.operators.catalog import silver_alerts_sql
from tradewatch.operators.export import balanced_alert_sample
from tradewatch.operators.spoofing import spoofing_alerts
from tradewatch.operators.wash import wash_alerts
from tradewatch.plans import registry
from tradewatch.plans.oracles import ORACLES
from tradewatch.params import ExportParams
from tradewatch.plans.registry import QUERIES

WRITES = {
    "csv_round_trip", "silver_partition_write", "gold_partition_overwrite", "bronze_landing",
    "bronze_incremental_read", "stream_spoofing_alerts", "stream_wash_alerts", "lake_cycle",
    "catalog_rebuild", "catalog_orders_table", "catalog_trades_table", "lake_cycle_orders",
    "stream_malformed_orders", "silver_trades_cycle", "alert_summary_cycle", "alerts_json",
    "stream_order_vs_last_tick", "orders_by_id",
}
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "Python")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"(?<!Broadcast)Exchange ", text))


@pytest.fixture(scope="module")
def stored_orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orders"))
    orders = QUERIES["order_feed"](spark, SF_DIR)
    orders.withColumn("event_time", F.col("event_time").cast("timestamp")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not [word for word in UNWANTED if word in text]


def test_spoofing_shuffles_once_and_reads_what_it_needs(stored_orders):
    text = plan(spoofing_alerts(stored_orders))
    assert exchanges(text) == 1
    assert "In(status, [CANCELLED,FILLED])" in text
    (columns,) = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert {c.split(":")[0] for c in columns.split(",")} == {"trader_id", "symbol", "status", "event_time"}


def test_wash_filters_reach_the_scan_and_pairs_fold_before_their_shuffle(spark, stored_orders):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(wash_alerts(stored_orders, fold_copies=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "EqualTo(side,buy)" in text and "EqualTo(side,sell)" in text
    assert text.count("EqualTo(status,FILLED)") == 2
    assert exchanges(text) == 3 and "SortMergeJoin" in text
    assert "partial_sum(weight" in text
    cells = re.search(r"SortMergeJoin \[(.*?)\]", text).group(1)
    assert all(name in cells for name in ("window", "symbol", "time_cell", "size_cell"))


def test_key_tuple_filter_needs_no_shuffle(spark):
    bronze = spark.range(1).select(
        *[F.lit("x").alias(c) for c in ("alert_type", "trader_id", "symbol", "trader_id_1", "trader_id_2")],
        F.lit(START).alias("window_start"), F.lit(START).alias("window_end"),
        F.lit(1).cast("bigint").alias("match_count"),
    )
    assert exchanges(plan(silver_alerts_sql(bronze))) == 0


def test_samples_take_the_top_rows_of_each_task(spark):
    alerts = QUERIES["all_alerts"](spark, SF_DIR)
    limits = ExportParams(alert_limit=10)
    assert plan(balanced_alert_sample(alerts, limits)).count("TakeOrderedAndProject") == 2
    assert "TakeOrdered" not in plan(balanced_alert_sample(alerts))


def test_last_tick_needs_no_sort_before_its_shuffle(spark):
    text = plan(QUERIES["latest_tick_per_symbol"](spark, SF_DIR))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_gold_overwrite_computes_the_activity_once(spark, monkeypatch):
    plans = []

    def record(rows, root):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(registry.lake_sink, "overwrite_dates", record)
    registry.QUERIES["gold_partition_overwrite"](spark, SF_DIR)
    assert "InMemoryRelation" in plans[0] and "InMemoryRelation" in plans[1]


def test_case_lifecycle_finds_the_alerts_once(spark, monkeypatch):
    plans = []

    def record(reviews, lake, version):
        plans.append(reviews._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(registry.lake_job, "write_reviews", record)
    monkeypatch.setattr(registry.detectors, "run_available", lambda writer: None)
    registry.QUERIES["case_lifecycle"](spark, SF_DIR)
    assert plans and all("Join" not in plan for plan in plans)
