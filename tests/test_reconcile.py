from __future__ import annotations

import pytest

from ledgerloom.operators import reconcile
from ledgerloom.settings import LedgerSettings
from tests.conftest import day, rows

D = "2023-01-31"


def cash(amount, account="A", currency="USD", counts=True):
    return (amount, account, "2023-01-15", "c", "s", currency, counts, "Income")


def trade(kind, price=5, units=2, currency="USD"):
    return ("X", "A", "2023-01-15", price, units, kind, currency, False)


def check(make, balances, transactions=(), exchanges=(), transfers=(), **settings):
    return reconcile.reconciliation(
        make.balances(*balances), make.transactions(*transactions), make.exchanges(*exchanges),
        make.transfers(*transfers), LedgerSettings(**settings))


def flag(df, **settings):
    return reconcile.adjustment_flag(df, LedgerSettings(**settings)).first()["adjust_allowed"]


def test_every_flow_counts_once(make):
    df = check(make, [("A", D, "USD", 100.0)],
               [cash(50), cash(-20), cash(0), cash(3, counts=False)],
               [trade("Sale"), trade("Purchase", 1, 4), trade("Gift")],
               [("B", "A", "2024-01-01", 7, "USD"), ("A", "B", "2024-01-01", 2, "USD")])
    row = df.first().asDict()
    assert {k: row[k] for k in reconcile.FLOWS} == {
        "income": 53.0, "expenses": -20.0, "aport": 10.0, "deport": -4.0,
        "transf_in": 7.0, "transf_out": -2.0}
    assert (row["calculated_balance"], row["difference"]) == (44.0, 56.0)


def test_asset_legs_move_the_ticker(make):
    df = check(make, [("A", D, "X", 2.0)], exchanges=[trade("Purchase"), trade("Sale", 5, 1)])
    row = df.first()
    assert (row["aport"], row["deport"], row["difference"]) == (2.0, -1.0, 1.0)


def test_only_the_latest_snapshot_is_checked(make):
    df = check(make, [("A", "2022-12-31", "USD", 9.0), ("B", D, "EUR", 0.0), ("C", D, "EUR", None)],
               [cash(5)])
    assert rows(df.select("account", "balance", "difference")) == [("B", 0.0, 0.0),
                                                                   ("C", None, None)]


def test_report_holds_positive_differences_largest_first(make):
    df = check(make, [("A", D, "USD", 1.0), ("B", D, "USD", 5.0), ("C", D, "USD", -3.0),
                      ("D", D, "USD", 0.0), ("E", D, "USD", None)])
    assert [r["account"] for r in reconcile.validation_report(df).collect()] == ["B", "A"]
    both = reconcile.validation_report(df, LedgerSettings(two_sided=True))
    assert [r["account"] for r in both.collect()] == ["B", "C", "A"]


def test_entries_carry_the_negated_difference(make):
    df = check(make, [("A", D, "USD", 2.0), ("B", D, "USD", -100.0), ("C", D, "USD", 0.0)])
    assert rows(reconcile.adjustment_entries(df)) == [
        ("Fix", -2.0, day(D), "A", "Taxes", "Buy tax", True, "USD"),
        ("Fix", 100.0, day(D), "B", "Taxes", "Buy tax", True, "USD")]


@pytest.mark.parametrize("currency, small, large", [
    ("USD", 4.99, 5.0), ("Rivalry", 4.99, 5.0), ("BTC", 0.00009, 0.0001),
    ("SHIB", 0.99, 1.0), ("OTHER", 0.0009, 0.001)])
def test_tolerances(make, currency, small, large):
    assert flag(check(make, [("A", D, currency, small)])) is True
    assert flag(check(make, [("A", D, currency, large)])) is False
    assert flag(check(make, [("A", D, currency, small), ("B", D, "USD", 6.0)])) is False


def test_flag_is_null_without_discrepancy_and_true_below_zero(make):
    assert flag(check(make, [("A", D, "USD", 5.0)], [cash(5)])) is None
    low = check(make, [("A", D, "USD", -100.0)])
    assert flag(low) is True
    assert flag(low, two_sided=True) is False


def test_noise_below_the_scale_is_no_discrepancy(make):
    df = check(make, [("A", D, "USD", 0.3)], [cash(0.1), cash(0.2)])
    assert df.first()["difference"] == 0.0


def test_added_movements_equal_a_longer_ledger(make):
    first, more = [cash(5), cash(-2), cash(1, "B")], [cash(-7), cash(4, "C"), cash(3)]
    flows = reconcile.ledger_flows(make.transactions(*first), make.exchanges(trade("Sale")),
                                   make.transfers())
    added = reconcile.add_movements(flows, make.transactions(*more))
    whole = reconcile.ledger_flows(make.transactions(*first, *more), make.exchanges(trade("Sale")),
                                   make.transfers())
    assert rows(added) == rows(whole)
