"""Properties of the physical plans that matter on a large cluster."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import maintenance, fx, positions, reconcile, trades
from ledgerloom.sources.scratch import Stage
from ledgerloom.sources.snapshots import SnapshotTables
from tests.conftest import SF, day
from workload.fixtures import view
from workload.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan adaptive execution settled on."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|Pandas|ArrowEval", text)


@pytest.mark.parametrize("name", ["positions", "exchange_rates", "trade_income", "balance_report",
                                  "allocation", "reconciliation", "fx_consolidation"])
def test_windows_are_partitioned(spark, name):
    for window in re.findall(r"\n[^\n]*Window \[.*", plan(QUERIES[name](spark, SF))):
        assert re.search(r"\], \[(ticker|_w)", window), window


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_flows_scan_each_ledger_once_and_combine_before_the_shuffle(spark):
    text = plan(positions.cash_flow(view(spark, SF, "transactions"), view(spark, SF, "exchanges")))
    assert text.count("lineitem.parquet") == 1
    assert "partial_sum" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_reconciliation_is_one_aggregate_over_three_scans(spark):
    legs = (reconcile.cash_legs(view(spark, SF, "transactions"))
            .unionByName(reconcile.trade_legs(view(spark, SF, "exchanges")))
            .unionByName(reconcile.transfer_legs(view(spark, SF, "transfers"))))
    text = plan(reconcile.summed_flows(legs))
    assert text.count("lineitem.parquet") == text.count("events.parquet") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(reconcile.transfer_flows(view(spark, SF, "transfers")))
    assert "EqualTo(event_type,purchase)" in text
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_type:string,value:double>", text) \
        or re.search(r"ReadSchema: struct<user_id:bigint,.*value:double>", text)
    assert "props" not in text


def test_trades_are_not_shuffled_where_rates_are_small(spark):
    rates = fx.exchange_rates(view(spark, SF, "prices"))
    text = plan(trades.trade_income(view(spark, SF, "exchanges"), rates, stage=Stage(spark)))
    above_joins = text.split("BroadcastHashJoin")[0]
    assert "SortMergeJoin" not in text and "Exchange" not in above_joins


def test_trades_shuffle_once_where_only_their_currencies_are_small(spark):
    stage = Stage(spark)
    rates = stage.always(fx.exchange_rates(view(spark, SF, "prices")), "rates")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        df = trades.trade_income(view(spark, SF, "exchanges"), rates, stage=stage)
        text = plan(df)
        assert text.count("SortMergeJoin [ticker") == 1
        assert re.search(r"BroadcastHashJoin \[currency#\d+, calendar_month", text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def small_skew(spark, no_broadcast):
    """Adaptive execution that takes small partitions for skewed ones."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_hot_instrument_is_split_in_the_shuffled_lookup(spark, make, small_skew):
    """A third of all trades in one ticker and month do not become one task."""
    hot = F.col("id") % 3 == 0
    book = spark.range(0, 60000, 1, 8).select(
        "id", F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("T"), F.col("id") % 500))
        .alias("ticker"), F.lit("A").alias("account"),
        F.when(hot, F.lit(day("2023-01-10"))).otherwise(
            F.date_add(F.lit(day("2023-01-01")), (F.col("id") % 28).cast("int")))
        .alias("calendar_date"),
        (F.col("id") % 97 + 1.0).alias("price"), (F.col("id") % 13 + 1.0).alias("units"),
        F.lit(0.0).alias("tax"), F.lit("Purchase").alias("exchange_type"),
        F.lit("EUR").alias("currency"), F.lit("EUR").alias("tax_currency"),
        F.lit(True).alias("count_to_balance"))
    rates = make.rates(*[(t, c, m, 2.0) for t in ("HOT", "EUR", *[f"T{i}" for i in range(500)])
                         for c in ("USD", "BRL") for m in ("2022-12-01", "2023-01-01")])
    df = trades.trade_income(book, rates, stage=Stage(spark))
    text = final_plan(df)
    assert text.count("SortMergeJoin(skew=true)") == 2
    assert df.count() == 120000


def test_a_hot_quote_is_split_in_the_shuffled_route_lookup(spark, make, small_skew):
    """Most prices quoted in one currency on one date are spread over tasks."""
    hot = F.col("id") % 3 == 0
    quoted = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("T"), "id").alias("ticker"),
        F.when(hot, F.lit("EUR")).otherwise(F.concat(F.lit("Q"), F.col("id") % 300))
        .alias("currency"), F.lit(day("2023-01-31")).alias("calendar_date"),
        (F.col("id") % 97 + 1.0).alias("price"))
    cross = make.prices(*[(q, "USD", "2023-01-31", 2) for q in
                          ("EUR", *[f"Q{i}" for i in range(300)])])
    df = fx.exchange_rates(quoted.unionByName(cross), stage=Stage(spark))
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert df.filter("currency = 'USD' and price is not null").count() == 60301


def test_the_ledger_is_summed_once_for_the_fixes_and_their_check(spark):
    text = final_plan(QUERIES["adjusted_validation"](spark, SF))
    executed = re.split(r"\n\+- == Initial Plan ==", text)[0]
    assert executed.count("lineitem.parquet") == 1
    assert "ReusedExchange" in executed


def test_the_latest_balances_prune_the_snapshots(spark, tmp_path):
    tables = SnapshotTables(spark, str(tmp_path))
    rows = spark.range(0, 4000, 1, 16).selectExpr(
        "concat('A', id) account", "date_add(date '2023-01-01', cast(id % 50 as int)) calendar_date",
        "'USD' currency", "cast(id as double) amount").repartition(16, "account")
    tables.publish("balances", rows, ("calendar_date",))
    stored = tables.read("balances")
    assert len(stored.inputFiles()) == 50  # one for each date, not one for each date and task
    latest = reconcile.latest_balances(stored)
    assert re.search(r"PartitionFilters: .isnotnull.*[Ss]ubquery", plan(latest)), plan(latest)
    assert latest.count() == 80


def test_a_small_batch_leaves_the_table_unshuffled(spark):
    table = spark.range(0, 2_000_000, 1, 8).selectExpr("id k", "id * 2 v")
    batch = spark.createDataFrame([(5, 1), (-1, 2)], "k bigint, v bigint")
    stage = Stage(spark)
    stored = stage.always(table, "table")
    changed = maintenance.upsert(stored, batch, ["k"], ["v"], stage=stage)
    assert "Exchange hashpartitioning" not in plan(changed)
    assert changed.count() == 2_000_001 and changed.filter("k = 5").first()["v"] == 1
