from __future__ import annotations

import random
from collections import defaultdict

import pytest

from ledgerloom.operators import fx
from ledgerloom.sources.scratch import LAZY, Stage
from tests.conftest import day, rows

D = "2023-01-31"
M = day("2023-01-01")


def rate(df, ticker, currency):
    found = df.filter(f"ticker = '{ticker}' and currency = '{currency}'").collect()
    assert len(found) == 1
    return found[0]["price"]


@pytest.mark.parametrize("prices, target, expected", [
    ([("X", "USD", D, 10)], "USD", 10.0),
    ([("X", "EUR", D, 10), ("EUR", "USD", D, 1.2)], "USD", 12.0),
    ([("X", "BRL", D, 10), ("USD", "BRL", D, 5)], "USD", 2.0),
    ([("X", "JPY", D, 10)], "USD", None),
    ([("Z", "USD", D, 0), ("X", "USD", D, 3), ("USD", "BRL", D, 5)], "BRL", 15.0),
    ([("X", "BRL", D, 3), ("USD", "BRL", D, 0)], "USD", None),
    ([("X", "EUR", D, 10), ("EUR", "USD", "2023-01-30", 1.2)], "USD", None),
])
def test_routes(make, prices, target, expected):
    assert rate(fx.exchange_rates(make.prices(*prices)), "X", target) == expected


def test_currency_is_worth_one_of_itself(make):
    df = fx.exchange_rates(make.prices(("USD", "BRL", D, 5), ("BRL", "BRL", D, 1)))
    assert rate(df, "USD", "USD") == 1.0
    assert rate(df, "BRL", "BRL") == 1.0
    assert rate(df, "BRL", "USD") == 0.2


def test_direct_beats_onward_beats_reverse(make):
    df = make.prices(("X", "EUR", D, 10), ("X", "USD", D, 7), ("EUR", "USD", D, 1.2),
                     ("USD", "EUR", D, 0.5))
    assert rate(fx.exchange_rates(df), "X", "USD") == 7.0
    without_direct = df.filter("not (ticker = 'X' and currency = 'USD')")
    assert rate(fx.exchange_rates(without_direct), "X", "USD") == 12.0


def test_ties_go_to_latest_date_then_quote_then_price(make):
    df = make.prices(("X", "USD", "2023-01-15", 1), ("X", "USD", "2023-01-31", 2))
    assert rate(fx.exchange_rates(df), "X", "USD") == 2.0
    df = make.prices(("X", "EUR", D, 10), ("X", "GBP", D, 9), ("EUR", "USD", D, 1),
                     ("GBP", "USD", D, 1))
    assert rate(fx.exchange_rates(df), "X", "USD") == 10.0


def test_date_without_route_leaves_month_without_rate(make):
    df = make.prices(("X", "USD", "2023-01-15", 1), ("X", "JPY", "2023-01-31", 2))
    assert rate(fx.exchange_rates(df), "X", "USD") is None


def test_quote_without_route_is_ignored_where_another_has_one(make):
    df = make.prices(("X", "USD", D, 4), ("X", "JPY", D, 2))
    assert rate(fx.exchange_rates(df), "X", "USD") == 4.0


def test_targets_are_configurable(make):
    df = make.prices(("X", "USD", D, 3), ("EUR", "USD", D, 1.5))
    assert rows(fx.exchange_rates(df, ("EUR",)).filter("ticker = 'X'")) == [("X", "EUR", M, 2.0)]


def test_consolidation_keeps_distinct_prices_and_unserved_dates(make):
    df = make.prices(("X", "USD", "2023-01-15", 1), ("X", "USD", "2023-01-20", 1),
                     ("X", "USD", "2023-01-31", 2), ("X", "JPY", "2023-01-31", 9),
                     ("X", "JPY", "2023-01-10", 9))
    found = fx.consolidation(df).filter("ticker = 'X' and currency = 'USD'")
    assert rows(found) == sorted([("X", "USD", M, 1.0, 1), ("X", "USD", M, 2.0, 1),
                                  ("X", "USD", M, None, None)], key=repr)


def random_prices(seed):
    """Prices with several dates a month, several quotes and unserved quotes."""
    pick = random.Random(seed)
    names = ["USD", "BRL", "EUR", "JPY"] + [f"I{i}" for i in range(12)]
    keys = {(pick.choice(names), pick.choice(names[:4]),
             f"2023-0{pick.randint(1, 2)}-{pick.choice(['10', '20', '28'])}") for _ in range(160)}
    return [(t, c, d, pick.choice([0, 1, 2, 2.5, 3, 7])) for t, c, d in sorted(keys)]


def brute_force_rates(prices, targets=("USD", "BRL")):
    """All pairs of price rows, row-level choice of route, then the best of the month."""
    cells = defaultdict(list)
    for ticker, quote, date, price in prices:
        onward = [p for p in prices if p[0] == quote and p[2] == date] or [None]
        peers = [p for p in prices if p[1] == quote and p[2] == date] or [None]
        for target in targets:
            cell = cells[ticker, target, date]
            for a in onward:
                for b in peers:
                    if quote == target:
                        cell.append((1, quote, price))
                    elif a and a[1] == target:
                        cell.append((2, quote, price * a[3]))
                    elif b and b[0] == target:
                        cell.append((3, quote, price / b[3] if b[3] else None))
    months = defaultdict(list)
    for (ticker, target, date), cell in cells.items():
        months[ticker, target, date[:7]] += [
            (priority, -int(date[8:]), quote, value is not None, value or 0, value)
            for priority, quote, value in cell] or [(0, 0, "", False, 0, None)]
    return {key: min(found)[-1] for key, found in months.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rates_equal_brute_force(make, spark, seed):
    prices = random_prices(seed)
    want = brute_force_rates(prices)
    for stage in (LAZY, Stage(spark)):
        df = fx.exchange_rates(make.prices(*prices), stage=stage)
        got = {(r["ticker"], r["currency"], str(r["calendar_month"])[:7]): r["price"]
               for r in df.collect()}
        assert got == want


def test_staged_lookups_give_the_same_rates(make, spark):
    df = make.prices(*random_prices(4))
    want = rows(fx.exchange_rates(df, stage=LAZY))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(fx.exchange_rates(df, stage=Stage(spark))) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
