"""Derived tables advanced in steps against those worked out at once."""

from __future__ import annotations

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import fx, positions, reconcile
from ledgerloom.plans.advance import AdvancedTables
from ledgerloom.sources.scratch import Stage
from ledgerloom.sources.snapshots import SnapshotTables
from tests.conftest import day, rows

TICKERS = ("X", "Y", "USD", "BRL", "EUR")


@pytest.fixture
def advancing(spark, tmp_path):
    tables = SnapshotTables(spark, str(tmp_path / "tables"))
    return tables, AdvancedTables(tables, Stage(spark, str(tmp_path / "stage")))


def near(got: DataFrame, want: DataFrame, digits: int = 6) -> None:
    """Equal rows, whatever the order of columns and of summation."""
    def shown(df):
        df = df.select(*[F.round(c, digits).alias(c) if t == "double" else c for c, t in sorted(df.dtypes)])
        return [tuple(0.0 if x == 0 else x for x in r) for r in rows(df)]
    assert shown(got) == shown(want)


def some_day(rng, months=8):
    return f"2023-{rng.randint(1, months):02d}-{rng.randint(1, 28):02d}"


def some_prices(make, rng, n, seen):
    out = []
    while len(out) < n:
        row = (rng.choice(TICKERS), rng.choice(("USD", "BRL", "EUR", "JPY")), some_day(rng))
        if row not in seen:
            seen.add(row)
            out.append((*row, rng.randint(1, 9) / 2))
    return make.prices(*out)


def some_movements(make, rng, n):
    transactions = make.transactions(*[(rng.randint(-9, 9), rng.choice("AB"), some_day(rng), "c", "s", rng.choice(TICKERS),
                                        rng.random() < 0.8, "Income") for _ in range(n)])
    exchanges = make.exchanges(*[(rng.choice(TICKERS), rng.choice("AB"), some_day(rng), rng.randint(1, 5), rng.randint(1, 9),
                                  rng.choice(("Purchase", "Sale", "Gift")), rng.choice(TICKERS), rng.random() < 0.8)
                                 for _ in range(n)])
    transfers = make.transfers(*[(rng.choice("AB"), rng.choice("ABC"), some_day(rng), rng.randint(1, 9), rng.choice(TICKERS))
                                 for _ in range(n)])
    return {"transactions": transactions, "exchanges": exchanges, "transfers": transfers}


@pytest.mark.parametrize("seed", [1, 2])
def test_steps_equal_the_whole(spark, make, advancing, seed):
    """Back-dated movements, prices that serve others, a step without anything new, a replaced table."""
    tables, state = advancing
    rng, seen = random.Random(seed), set()
    tables.publish("balances", make.balances(*[(a, "2023-08-31", t, 5.0) for a in "ABC" for t in TICKERS]))
    for step in range(5):
        if step != 2:
            added = some_movements(make, rng, 25 if step == 0 else 3)
            if step == 4:
                del added["exchanges"]
            for name, df in added.items():
                tables.append(name, df)
            tables.append("prices", some_prices(make, rng, 40 if step == 0 else 2, seen))
        if step == 3:
            tables.publish("transactions", tables.read("transactions").filter("amount <> 3"))
        now = {n: tables.read(n) for n in ("transactions", "exchanges", "transfers", "prices", "balances")}
        rates = fx.exchange_rates(now["prices"])
        near(state.reconciliation(), reconcile.reconciliation(
            now["balances"], now["transactions"], now["exchanges"], now["transfers"]))
        if step % 2 == 0:  # rates may also be ahead of the positions
            near(state.rates()[0], rates)
        near(state.positions(), positions.positions(now["transactions"], now["exchanges"], rates))
        near(state.rates()[0], rates)


def test_only_new_parts_are_read(make, advancing):
    tables, state = advancing
    for name, df in some_movements(make, random.Random(3), 9).items():
        tables.publish(name, df)
    state.flows()
    tables.append("transfers", make.transfers(("A", "B", "2023-01-05", 3, "USD")))
    _, covered = state._state("flow_sums")
    extents, pending, fresh = state.pending(covered, ("transactions", "exchanges", "transfers"))
    assert set(pending) == {"transfers"} and not fresh and extents["transfers"] == (1, 1)
    assert all("/transfers/snapshot=1/part=1/" in f for f in pending["transfers"].inputFiles())
    state.flows()
    assert state.pending(state._state("flow_sums")[1], tuple(extents))[1] == {}
    number = tables.current("flow_sums")
    state.flows()
    assert tables.current("flow_sums") == number  # nothing new, nothing written


def test_touched_cells_are_those_that_change(spark, make):
    """Every rate that an added price changes lies in a touched cell."""
    rng, seen = random.Random(5), set()
    for _ in range(6):
        old = some_prices(make, rng, 30, seen)
        added = some_prices(make, rng, 2, seen)
        both = old.unionByName(added)
        before = {tuple(r) for r in fx.exchange_rates(old).collect()}
        after = {tuple(r) for r in fx.exchange_rates(both).collect()}
        cells = {tuple(r) for r in fx.touched_cells(both, added).collect()}
        assert {(t, m) for t, _, m, _ in before ^ after} <= cells
        now = fx.rates_of_cells(both, fx.touched_cells(both, added))
        assert {tuple(r) for r in now.collect()} == {r for r in after if (r[0], r[2]) in cells}


def test_a_later_month_goes_on_from_the_last_one(spark, make):
    """Only the reopened month is summed; the one before keeps its row."""
    rates = make.rates(("X", "USD", "2023-01-01", 2.0), ("X", "USD", "2023-02-01", 3.0), ("Y", "USD", "2023-01-01", 1.0))
    flow = lambda *r: spark.createDataFrame(
        [(day(m), t, u, u) for m, t, u in r], "calendar_month date, ticker string, units double, avg_units double")
    totals = positions.running_totals(rates, flow(("2023-01-01", "X", 0.1), ("2023-02-01", "X", 0.2)))
    held = positions.valued_positions(totals, "total").withColumn(
        "prev_price", F.when(F.col("calendar_month") == day("2023-01-01"), 99.0).otherwise(F.col("prev_price")))
    changes = spark.createDataFrame([("X", day("2023-02-01"))], "ticker string, from_month date")
    got = positions.carried_forward(held, changes, rates, flow(("2023-01-01", "X", 7.0), ("2023-02-01", "X", 1.2)))
    found = {(r.ticker, r.calendar_month): (r.position, r.prev_position, r.prev_price) for r in got.collect()}
    assert found == {("X", day("2023-01-01")): (0.1, 0.0, 99.0), ("X", day("2023-02-01")): (1.3, 0.1, 2.0),
                     ("Y", day("2023-01-01")): (0.0, 0.0, 99.0)}
    assert reduce(lambda a, b: a and b, [c in got.columns for c in ("total", "c_value")])
