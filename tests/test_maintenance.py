from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import maintenance
from ledgerloom.sources.scratch import Stage
from ledgerloom.sources.snapshots import SnapshotTables
from tests.conftest import rows

T = "k int, name string, amount double"


def test_upsert_updates_only_the_listed_columns(make):
    table = make.frame([(1, "a", 1.0), (2, "b", 2.0)], T)
    batch = make.frame([(2, "x", None), (3, "y", 3.0)], T)
    got = maintenance.upsert(table, batch, ["k"], ["amount"])
    assert rows(got) == [(1, "a", 1.0), (2, "b", None), (3, "y", 3.0)]


def test_upsert_of_a_key_given_twice(make):
    table = make.frame([(1, "a", 1.0)], T)
    batch = make.frame([(1, "x", 5.0, 2), (1, "y", 9.0, 1), (2, "late", 1.0, 7),
                        (2, "early", 8.0, 3)], T + ", line int")
    got = maintenance.upsert(table, batch, ["k"], ["amount"], sequence=["line"])
    # A new key is inserted with its first row, then updated by its last.
    assert rows(got) == [(1, "a", 5.0), (2, "early", 1.0)]


def test_upsert_is_idempotent(make):
    table = make.frame([(1, "a", 1.0), (2, "b", 2.0)], T)
    batch = make.frame([(2, "x", 7.0), (3, "y", 3.0)], T)
    once = maintenance.upsert(table, batch, ["k"], ["amount"])
    assert rows(maintenance.upsert(once, batch, ["k"], ["amount"])) == rows(once)


def test_delete_and_update_ignore_unknown_predicates(make):
    df = make.frame([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0)], T)
    assert [r["k"] for r in maintenance.delete_where(df, F.col("name") == "a")
            .orderBy("k").collect()] == [2, 3]
    got = maintenance.update_where(df, F.col("name") == "a", {"k": F.lit(5)})
    assert rows(got) == sorted([(5, "a", 1.0), (2, None, 2.0), (3, "c", 3.0)], key=repr)


def test_integrity_reports(make):
    df = make.frame([(1, "a", 1.0), (1, None, None), (2, None, 2.0), (None, "d", 1.0)], T)
    assert rows(maintenance.not_null_violations(df, ["k", "name", "amount"])) == [
        ("amount", 1), ("k", 1), ("name", 2)]
    assert rows(maintenance.not_null_violations(df.limit(1), ["name"])) == []
    assert rows(maintenance.primary_key_violations(df, ["k"])) == [(1, 2)]
    parent = make.frame([(1,)], "id int")
    assert rows(maintenance.foreign_key_violations(df, "k", parent, "id")) == [(2, 1)]


def test_ids_are_dense_and_unique_over_files(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("v", F.col("id") * 2).drop("id")
    stored = Stage(spark).always(df, "many_files")
    assert len(stored.inputFiles()) == 7
    got = maintenance.assign_ids(stored, start=11)
    assert got.columns == ["id", "v"]
    assert sorted(r["id"] for r in got.collect()) == list(range(11, 1011))
    assert sorted(r["v"] for r in got.collect()) == list(range(0, 2000, 2))


def test_ids_over_hundreds_of_files_are_the_same_on_retry(spark):
    stored = Stage(spark).always(spark.range(0, 5000, 1, 500).toDF("v"), "hundreds_of_files")
    assert len(stored.inputFiles()) == 500
    got = maintenance.assign_ids(stored)
    first = sorted(map(tuple, got.collect()))
    assert [r[0] for r in first] == list(range(1, 5001))
    assert sorted(map(tuple, got.collect())) == first


def test_snapshots_replace_append_and_roll_back(make, spark, tmp_path):
    tables = SnapshotTables(spark, str(tmp_path / "ledger"))
    with pytest.raises(LookupError):
        tables.read("t")
    df = make.frame([(1, "a", 1.0)], T)
    assert tables.publish("t", df) == 1
    # The next snapshot may be computed from the one it replaces.
    assert tables.publish("t", tables.read("t").withColumn("amount", F.col("amount") + 1)) == 2
    assert rows(tables.read("t")) == [(1, "a", 2.0)]
    tables.append("t", df)
    assert rows(tables.read("t")) == [(1, "a", 1.0), (1, "a", 2.0)]

    # A write that never committed is not seen, and its number is not reused.
    (tmp_path / "ledger" / "t" / "snapshot=3" / "part=0").mkdir(parents=True)
    (tmp_path / "ledger" / "t" / "snapshot=2" / "part=2").mkdir()
    assert tables.current("t") == 2
    tables.append("t", df)
    assert tables.read("t").count() == 3
    assert tables.publish("t", df) == 4
    assert rows(tables.read("t", df.schema)) == [(1, "a", 1.0)]


def test_partitioned_snapshot_keeps_its_columns(make, spark, tmp_path):
    tables = SnapshotTables(spark, str(tmp_path / "ledger"))
    df = make.balances(("A", "2023-01-31", "USD", 1.0), ("A", "2023-02-28", "USD", None))
    tables.publish("balances", df, ["calendar_date"])
    assert rows(tables.read("balances", df.schema)) == rows(df)
    tables.append("balances", df, ["calendar_date"])
    assert rows(tables.read("balances", df.schema)) == rows(df.unionByName(df))


def test_stage_is_discarded(spark, tmp_path):
    stage = Stage(spark, str(tmp_path / "stage"))
    stage.always(spark.range(3), "three")
    assert (tmp_path / "stage").exists()
    stage.discard()
    assert not (tmp_path / "stage").exists()
