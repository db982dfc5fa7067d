from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.references import (
    CASCADE, RESTRICT, Reference, BrokenReference, delete_rows, parents_first, update_keys,
)
from ledgerloom.sources.scratch import Stage
from tests.conftest import rows

CITY = Reference("users", "city", "cities", "id")
# An account has the id of its user; movements refer to accounts.
ACCOUNT = Reference("accounts", "id", "users", "id", on_delete=CASCADE)
MOVEMENT = Reference("movements", "account", "accounts", "id", on_delete=CASCADE)
ALL = (MOVEMENT, ACCOUNT, CITY)


@pytest.fixture
def tables(make):
    return {
        "cities": make.frame([(1, "x"), (2, "y"), (3, "z")], "id int, name string"),
        "users": make.frame([(10, 1), (11, 1), (12, 2), (13, None)], "id int, city int"),
        "accounts": make.frame([(10, "a"), (11, "b")], "id int, name string"),
        "movements": make.frame([(1, 10), (2, 10), (3, 11), (4, None)], "id int, account int"),
    }


def new(tables, changed, name):
    return rows(changed.get(name, tables[name]))


@pytest.mark.parametrize("staged", [False, True])
def test_a_key_is_followed_along_all_references(tables, spark, staged):
    stage = {"stage": Stage(spark)} if staged else {}
    changed = update_keys(tables, ALL, "users", F.col("id") == 10, {"id": F.col("id") + 90}, **stage)
    assert list(changed) == ["users", "accounts", "movements"]
    assert new(tables, changed, "users") == sorted([(100, 1), (11, 1), (12, 2), (13, None)], key=repr)
    assert new(tables, changed, "accounts") == [(100, "a"), (11, "b")]
    assert new(tables, changed, "movements") == sorted([(1, 100), (2, 100), (3, 11), (4, None)], key=repr)


def test_tables_without_the_key_are_not_touched(tables):
    changed = update_keys(tables, ALL, "users", F.col("id") == 12, {"id": F.lit(99)})
    assert list(changed) == ["users"]
    assert list(update_keys(tables, ALL, "cities", F.col("id") == 3, {"id": F.lit(9)})) == ["cities"]
    assert list(update_keys(tables, ALL, "cities", F.col("id") == 1, {"name": F.lit("w")})) == ["cities"]
    assert list(update_keys(tables, ALL, "cities", F.lit(None).cast("boolean"), {"id": F.lit(9)})) == ["cities"]


def test_keys_may_trade_places(tables):
    swap = {"id": F.lit(3) - F.col("id")}
    changed = update_keys(tables, ALL, "cities", F.col("id") < 3, swap)
    assert rows(changed["cities"]) == [(1, "y"), (2, "x"), (3, "z")]
    assert rows(changed["users"]) == sorted([(10, 2), (11, 2), (12, 1), (13, None)], key=repr)


@pytest.mark.parametrize("predicate, value, problem", [
    ("id = 1", "2", "repeat"), ("id < 3", "7", "repeat"), ("id = 1", "null", "lose")])
def test_new_keys_must_be_keys(tables, predicate, value, problem):
    with pytest.raises(BrokenReference, match=problem):
        update_keys(tables, ALL, "cities", F.expr(predicate), {"id": F.expr(value).cast("int")})


def test_a_key_held_by_several_rows_moves_whole(tables, make):
    tables["cities"] = make.frame([(1, "x"), (1, "y"), (2, "z")], "id int, name string")
    with pytest.raises(BrokenReference, match="split"):
        update_keys(tables, ALL, "cities", F.col("name") == "x", {"id": F.lit(5)})
    changed = update_keys(tables, ALL, "cities", F.col("id") == 1, {"id": F.lit(5)})
    assert rows(changed["users"]) == sorted([(10, 5), (11, 5), (12, 2), (13, None)], key=repr)


def test_a_restricted_change_raises(tables):
    fixed = (Reference("users", "city", "cities", "id", on_update=RESTRICT),)
    with pytest.raises(BrokenReference, match="users.city"):
        update_keys(tables, fixed, "cities", F.col("id") == 1, {"id": F.lit(9)})
    assert list(update_keys(tables, fixed, "cities", F.col("id") == 3, {"id": F.lit(9)})) == ["cities"]
    with pytest.raises(BrokenReference, match="users.city"):
        delete_rows(tables, ALL, "cities", F.col("id") == 1)


def test_deletes_cascade_or_stop(tables):
    changed = delete_rows(tables, ALL, "users", F.col("id") == 10)
    assert new(tables, changed, "users") == sorted([(11, 1), (12, 2), (13, None)], key=repr)
    assert new(tables, changed, "accounts") == [(11, "b")]
    assert new(tables, changed, "movements") == sorted([(3, 11), (4, None)], key=repr)
    held = (*ALL[1:], Reference("movements", "account", "accounts", "id"))
    with pytest.raises(BrokenReference, match="movements.account"):
        delete_rows(tables, held, "users", F.col("id") == 10)
    assert rows(delete_rows(tables, held, "users", F.col("id") == 12)["users"]) == sorted(
        [(10, 1), (11, 1), (13, None)], key=repr)
    assert list(delete_rows(tables, ALL, "movements", F.col("id") == 1)) == ["movements"]


def test_a_key_with_a_row_left_is_not_gone(tables, make):
    tables["cities"] = make.frame([(1, "x"), (1, "y"), (2, "z")], "id int, name string")
    assert list(delete_rows(tables, ALL, "cities", F.col("name") == "x")) == ["cities"]


def test_rows_that_go_themselves_do_not_hold_a_key(tables):
    # Movements name the user too, but go with the account.
    both = (*ALL, Reference("movements", "account", "users", "id"))
    assert rows(delete_rows(tables, both, "users", F.col("id") == 10)["movements"]) == sorted(
        [(3, 11), (4, None)], key=repr)


def test_empty_tables_and_circles(tables, make):
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert rows(update_keys(empty, ALL, "users", F.lit(True), {"id": F.lit(1)})["users"]) == []
    assert rows(delete_rows(empty, ALL, "users", F.lit(True))["users"]) == []
    with pytest.raises(BrokenReference, match="circle"):
        parents_first([CITY, Reference("cities", "mayor", "users", "id")])
    with pytest.raises(ValueError, match="action"):
        Reference("a", "b", "c", "d", on_update="set null")


def test_moved_keys_leave_a_large_child_unshuffled(tables, spark):
    wide = {"cities": spark.range(50).withColumn("name", F.lit("x")),
            "users": spark.range(10_000).withColumn("city", F.col("id") % 50)}
    stage = Stage(spark)
    wide = {name: stage.always(df, name) for name, df in wide.items()}
    changed = update_keys(wide, (CITY,), "cities", F.col("id") < 3, {"id": F.col("id") + 100}, stage)
    plan = changed["users"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert changed["users"].filter("city >= 100").count() == 600
