from __future__ import annotations

import datetime as dt

import pytest

from ledgerloom.operators import trades
from ledgerloom.settings import LedgerSettings
from ledgerloom.sources.scratch import LAZY, Stage

APRIL = [("X", "USD", "2023-03-01", 10.0), ("X", "USD", "2023-04-01", 20.0),
         ("EUR", "USD", "2023-03-01", 1.0), ("EUR", "USD", "2023-04-01", 2.0)]


def single(make, trade, rates=APRIL, **settings):
    df = trades.trade_income(make.exchanges(trade), make.rates(*rates), LedgerSettings(**settings))
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def buy(ticker="X", date="2023-04-15", price=5, units=2, kind="Purchase", currency="EUR",
        counts=True):
    return (ticker, "A", date, price, units, kind, currency, counts)


def test_rates_of_both_legs(make):
    row = single(make, buy())
    assert (row["som_price"], row["eom_price"]) == (10.0, 20.0)
    assert (row["c_som_price"], row["c_eom_price"]) == (1.0, 2.0)
    assert row["days_passed"] == 15


def test_estimates(make):
    row = single(make, buy())
    assert row["linear_estimate"] == 15.0
    assert row["c_price"] == 1.5
    assert row["c_linear_estimate"] == 7.5
    assert row["proportional_estimate"] == 10.0
    # Day 15 of 30 weighs the linear estimate 0.1.
    assert row["final_estimate"] == pytest.approx(0.1 * 15 + 0.9 * 7.5)


def test_weight_turns_negative_within_the_month(make):
    row = single(make, buy(date="2023-04-30"))
    assert row["final_estimate"] == pytest.approx(-0.8 * 20 + 1.8 * 10)


def test_trade_in_the_reporting_currency_keeps_its_price(make):
    rates = [("X", "USD", "2023-04-01", 20.0), ("USD", "USD", "2023-04-01", 1.0)]
    assert single(make, buy(currency="USD"), rates)["final_estimate"] == 5.0


def test_before_cutoff_fixed_value_side_decides(make):
    late = dt.date(2024, 1, 1)
    assert single(make, buy(), estimate_cutoff=late)["final_estimate"] == 7.5
    rates = [("EUR", "USD", "2023-03-01", 1.0), ("EUR", "USD", "2023-04-01", 2.0),
             ("Y", "USD", "2023-03-01", 1.0), ("Y", "USD", "2023-04-01", 4.0)]
    row = single(make, buy("EUR", currency="Y"), rates, estimate_cutoff=late)
    assert row["final_estimate"] == row["linear_estimate"] == 1.5


def test_first_month_falls_back_to_the_proportional_estimate(make):
    rates = [r for r in APRIL if r[2] == "2023-04-01"]
    row = single(make, buy(), rates)
    assert row["linear_estimate"] is None
    assert row["final_estimate"] == pytest.approx(10.0)


def test_zero_rates_give_null_not_errors(make):
    rates = [("X", "USD", "2023-04-01", 0.0), ("EUR", "USD", "2023-04-01", 2.0)]
    assert single(make, buy(), rates)["proportional_estimate"] is None


def test_gains_add_up(make):
    row = single(make, buy(kind="Sale"))
    assert row["units"] == -2.0
    assert row["trade_income"] + row["c_trade_income"] == pytest.approx(row["total_trade_income"])
    assert row["total_trade_income"] == pytest.approx(row["direct_trade_income"])


def test_trade_without_rate_keeps_one_row(make):
    row = single(make, buy("Q"))
    assert row["ex_currency"] is None and row["trade_income"] is None
    # A start-of-month rate alone does not list the ticker either.
    row = single(make, buy(date="2023-05-02"))
    assert row["ex_currency"] is None and row["som_price"] is None


def test_counter_keeps_its_start_rate_without_an_end_rate(make):
    rates = [r for r in APRIL if r[:3] != ("EUR", "USD", "2023-04-01")]
    row = single(make, buy(), rates)
    assert (row["c_som_price"], row["c_eom_price"]) == (1.0, None)


def test_one_row_per_listed_target(make):
    rates = [*APRIL, ("X", "BRL", "2023-04-01", 100.0)]
    df = trades.trade_income(make.exchanges(buy(), buy(counts=False)), make.rates(*rates))
    assert sorted(r["ex_currency"] for r in df.collect()) == ["BRL", "USD"]
    only = [r for r in rates if r[1] == "BRL"]
    df = trades.trade_income(make.exchanges(buy()), make.rates(*only))
    assert [r["ex_currency"] for r in df.collect()] == ["BRL"]


def test_single_target(make):
    settings = LedgerSettings(targets=("USD",))
    df = trades.trade_income(make.exchanges(buy(), buy("Q")), make.rates(*APRIL), settings)
    assert sorted(str(r["ex_currency"]) for r in df.collect()) == ["None", "USD"]


def test_shuffled_lookups_give_the_same_rows(make, spark):
    book = make.exchanges(buy(), buy("Q"), buy("EUR", currency="X"), buy(kind="Sale"))
    rates = make.rates(*APRIL)
    want = sorted(map(repr, trades.trade_income(book, rates, stage=LAZY).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = trades.trade_income(book, rates, stage=Stage(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(repr, got)) == want
