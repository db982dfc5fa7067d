from __future__ import annotations

import pytest

from ledgerloom.operators import reports
from tests.conftest import day, rows

M = "2023-01-01"
RATES = [("EUR", "USD", M, 2.0), ("EUR", "BRL", M, 10.0)]


def income(amount, subcategory, currency="EUR", category="Own", kind="Income", counts=True):
    return (amount, "A", "2023-01-15", category, subcategory, currency, counts, kind)


def positions(make, *values):
    """(ticker, currency, c_value, c_position)"""
    return make.frame(
        [(day(M), t, c, v, p, p) for t, c, v, p in values],
        "calendar_month date, ticker string, currency string, c_value double, "
        "c_position double, c_avg_position double")


def gains(make, *values):
    """(ticker, currency, ex_currency, trade_income, c_trade_income)"""
    return make.frame(
        [(day(M), *v) for v in values],
        "calendar_month date, ticker string, currency string, ex_currency string, "
        "trade_income double, c_trade_income double")


def test_expenses_are_converted_to_each_target(make):
    df = reports.converted_expenses(
        make.transactions(income(-3, "Food", kind="Expenses"), income(-1, "Food", kind="Expenses"),
                          income(-9, "Food", kind="Expenses", counts=False), income(5, "Food")),
        make.rates(*RATES))
    assert rows(df) == [(day(M), "Own", "Food", "BRL", -40.0), (day(M), "Own", "Food", "USD", -8.0)]


def test_expenses_without_rate_keep_a_row_but_not_in_the_balance(make):
    spent = make.transactions(income(-3, "Food", "JPY", kind="Expenses"))
    assert rows(reports.converted_expenses(spent, make.rates(*RATES))) == [
        (day(M), "Own", "Food", None, None)]
    df = reports.balance(spent, make.rates(*RATES), positions(make), gains(make), make.mapping())
    assert df.count() == 0


@pytest.mark.parametrize("subcategory, mapped, expected", [
    ("Div", [("Stocks", "Growth", "Div")], ("Stocks", "Growth")),
    ("Div", [], ("Own", "Div")),
    ("Rivalry", [("Sponsor", "Team", "Rivalry")], ("Own", "Team")),
])
def test_income_categories(make, subcategory, mapped, expected):
    df = reports.converted_income(make.transactions(income(1, subcategory)),
                                  make.rates(RATES[0]), make.mapping(*mapped))
    assert rows(df) == [(day(M), *expected, "USD", 2.0)]


def test_duplicate_mapping_rows_multiply_amounts(make):
    listed = make.mapping(("Stocks", "Growth", "Div"), ("Stocks", "Growth", "Div"))
    df = reports.converted_income(make.transactions(income(1, "Div")), make.rates(RATES[0]), listed)
    assert rows(df) == [(day(M), "Stocks", "Growth", "USD", 4.0)]
    held = positions(make, ("Div", "USD", 0.0, 3.0))
    assert rows(reports.allocation(held, listed)) == [(day(M), "Stocks", "Growth", "USD", 6.0, 6.0)]


def test_expenses_are_never_mapped(make):
    listed = make.mapping(("Stocks", "Growth", "Food"), ("Stocks", "Growth", "Food"))
    df = reports.balance(make.transactions(income(-3, "Food", kind="Expenses")),
                         make.rates(RATES[0]), positions(make), gains(make), listed)
    assert rows(df) == [(day(M), "Own", "Food", "USD", None, 6.0)]


def test_trade_income_sides_stay_apart(make):
    df = reports.trade_income_by_category(
        gains(make, ("X", "EUR", "USD", 1.0, 5.0), ("X", "X", "USD", 2.0, 0.0),
              ("X", "EUR", "USD", None, None)),
        make.mapping(("Stocks", "G", "X"), ("Stocks", "G", "EUR")))
    assert rows(df) == [(day(M), "Stocks", "G", "USD", 3.0), (day(M), "Stocks", "G", "USD", 5.0)]


def test_balance_stacks_all_sources(make):
    df = reports.balance(
        make.transactions(income(1, "Div"), income(-3, "Food", kind="Expenses"),
                          income(7, "Odd", kind="Other")),
        make.rates(RATES[0]),
        positions(make, ("X", "USD", 4.0, 1.0), ("X", "BRL", 0.0, 1.0), ("X", "BRL", None, 1.0)),
        gains(make, ("X", "EUR", "USD", 1.0, 5.0)), make.mapping(("Stocks", "G", "X")))
    m = day(M)
    assert rows(df) == sorted([
        (m, "Own", "Div", "USD", 2.0, None), (m, "Own", "Food", "USD", None, 6.0),
        (m, "Stocks", "G", "USD", 4.0, None), (m, "Stocks", "G", "USD", 1.0, None),
        (m, None, None, "USD", 5.0, None)], key=repr)


def test_allocation_skips_what_is_not_held(make):
    held = positions(make, ("X", "USD", 0.0, 3.0), ("Y", "USD", 0.0, 4.0), ("Z", "USD", 0.0, 0.0),
                     ("W", "USD", 0.0, None))
    df = reports.allocation(held, make.mapping(("Stocks", "G", "X"), ("Stocks", "G", "Y")))
    assert rows(df) == [(day(M), "Stocks", "G", "USD", 7.0, 7.0)]
