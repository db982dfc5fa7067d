from __future__ import annotations

import pytest

from ledgerloom.operators import fx, positions
from ledgerloom.settings import LedgerSettings
from tests.conftest import day, rows


def flows(make, transactions=(), exchanges=(), **settings):
    df = positions.cash_flow(make.transactions(*transactions), make.exchanges(*exchanges),
                             LedgerSettings(**settings))
    return {(str(r["calendar_month"]), r["ticker"]): (r["units"], r["avg_units"])
            for r in df.collect()}


def test_day_weight(make):
    got = flows(make, [(31, "A", "2023-01-31", "c", "s", "USD", True, "Income")])
    assert got == {("2023-01-01", "USD"): (31.0, 1.0)}


def test_uncounted_rows_do_not_flow(make):
    got = flows(make, [(31, "A", "2023-01-31", "c", "s", "USD", False, "Income")],
                [("X", "A", "2023-01-31", 2, 3, "Purchase", "USD", False)])
    assert got == {}


@pytest.mark.parametrize("kind, sign", [("Purchase", 1), ("Sale", -1), ("Gift", -1)])
def test_quote_leg_weight_has_the_opposite_sign(make, kind, sign):
    trade = ("X", "A", "2023-01-31", 31, 1, kind, "USD", True)
    got = flows(make, exchanges=[trade])
    assert got["2023-01-01", "X"] == (sign * 1.0, pytest.approx(sign / 31))
    assert got["2023-01-01", "USD"] == (-sign * 31.0, sign * 1.0)
    fixed = flows(make, exchanges=[trade], fix_quote_weight=True)
    assert fixed["2023-01-01", "USD"] == (-sign * 31.0, -sign * 1.0)


def test_running_position_and_valuation(make):
    prices = make.prices(("X", "USD", "2023-01-31", 10), ("X", "USD", "2023-02-28", 12),
                         ("X", "USD", "2023-03-31", 9))
    trades = make.exchanges(("X", "A", "2023-01-01", 10, 2, "Purchase", "EUR", True),
                            ("X", "A", "2023-03-01", 10, 1, "Sale", "EUR", True),
                            ("X", "A", "2023-04-01", 10, 5, "Purchase", "EUR", True))
    df = positions.positions(make.transactions(), trades, fx.exchange_rates(prices))
    got = [(str(r["calendar_month"]), r["prev_position"], r["position"], r["avg_position"],
            r["prev_price"], r["c_position"], r["c_value"])
           for r in df.filter("currency = 'USD'").orderBy("calendar_month").collect()]
    assert got == [("2023-01-01", 0.0, 2.0, 2.0, 0.0, 20.0, 0.0),
                   ("2023-02-01", 2.0, 2.0, 2.0, 10.0, 24.0, 4.0),
                   ("2023-03-01", 2.0, 1.0, 1.0, 12.0, 9.0, -6.0)]


def test_missing_price_counts_as_zero_next_month(make):
    rates = make.rates(("X", "USD", "2023-01-01", 10.0), ("X", "USD", "2023-02-01", None),
                       ("X", "USD", "2023-03-01", 12.0))
    held = make.transactions((2, "A", "2023-01-01", "c", "s", "X", True, "Income"))
    df = positions.positions(held, make.exchanges(), rates).orderBy("calendar_month")
    assert [r["c_value"] for r in df.collect()] == [0.0, None, 24.0]


def test_last_running_position_is_the_sum_of_flows(make):
    months = [f"2022-{m:02d}" for m in range(1, 13)]
    prices = make.prices(*[("X", "USD", f"{m}-28", i + 1) for i, m in enumerate(months)])
    moves = [((-1) ** i * (i + 0.1), "A", f"{m}-11", "c", "s", "X", True, "Income")
             for i, m in enumerate(months)]
    df = positions.positions(make.transactions(*moves), make.exchanges(),
                             fx.exchange_rates(prices))
    last = df.filter(f"calendar_month = date '{day('2022-12-01')}' and currency = 'USD'").first()
    assert last["position"] == pytest.approx(sum(m[0] for m in moves))


def test_one_row_per_month_and_target(make):
    prices = make.prices(("X", "JPY", "2023-01-31", 10))
    df = positions.positions(make.transactions(), make.exchanges(), fx.exchange_rates(prices))
    assert rows(df.select("ticker", "currency", "position", "price")) == [
        ("X", "BRL", 0.0, None), ("X", "USD", 0.0, None)]
