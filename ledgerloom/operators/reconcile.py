"""Stated balances against the ledger, and the adjustments that follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.values import case, is_one_of
from ledgerloom.settings import (
    FIX_CATEGORY, FIX_SUBCATEGORY, FIX_TAG, PURCHASE, SALE, LedgerSettings,
)

FLOWS = ("income", "expenses", "aport", "deport", "transf_in", "transf_out")


def latest_balances(balances: DataFrame) -> DataFrame:
    """account, currency, calendar_date, balance of the newest snapshot.

    The date is a scalar subquery, which a table partitioned by date is pruned with.
    """
    newest = balances.agg(F.max("calendar_date")).scalar()
    return (balances.filter(F.col("calendar_date") == newest)
            .select("account", "currency", "calendar_date", F.col("amount").alias("balance")))


def cash_legs(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "account", "currency",
        F.when(F.col("amount") >= 0, F.lit("income")).otherwise(F.lit("expenses")).alias("flow"),
        F.col("amount").alias("delta"))


def trade_legs(exchanges: DataFrame) -> DataFrame:
    """Both legs of purchases and sales; other trade types move nothing here."""
    purchase = F.col("exchange_type") == PURCHASE
    cost = F.col("price") * F.col("units")
    legs = F.array(
        F.struct(F.col("ticker").alias("currency"),
                 F.when(purchase, F.lit("aport")).otherwise(F.lit("deport")).alias("flow"),
                 F.when(purchase, F.col("units")).otherwise(-F.col("units")).alias("delta")),
        F.struct(F.col("currency").alias("currency"),
                 F.when(purchase, F.lit("deport")).otherwise(F.lit("aport")).alias("flow"),
                 F.when(purchase, -cost).otherwise(cost).alias("delta")))
    return (exchanges.filter(is_one_of(F.col("exchange_type"), (PURCHASE, SALE)))
            .select("account", F.inline(legs)))


def transfer_legs(transfers: DataFrame) -> DataFrame:
    amount = F.col("amount")
    legs = F.array(
        F.struct(F.col("destination_acc").alias("account"), F.lit("transf_in").alias("flow"),
                 amount.alias("delta")),
        F.struct(F.col("source_acc").alias("account"), F.lit("transf_out").alias("flow"),
                 (-amount).alias("delta")))
    return transfers.select("currency", F.inline(legs))


def summed_flows(legs: DataFrame, names: tuple[str, ...] = FLOWS) -> DataFrame:
    """One column per flow and (account, currency); NULL where it has no rows."""
    return legs.groupBy("account", "currency").agg(*[
        F.sum(F.when(F.col("flow") == name, F.col("delta"))).alias(name) for name in names
    ])


def cash_in_out(transactions: DataFrame) -> DataFrame:
    return summed_flows(cash_legs(transactions), FLOWS[0:2])


def trade_flows(exchanges: DataFrame) -> DataFrame:
    return summed_flows(trade_legs(exchanges), FLOWS[2:4])


def transfer_flows(transfers: DataFrame) -> DataFrame:
    return summed_flows(transfer_legs(transfers), FLOWS[4:6])


def ledger_flows(transactions: DataFrame, exchanges: DataFrame,
                 transfers: DataFrame) -> DataFrame:
    """All six flows per (account, currency) from one pass over each ledger.

    The legs are stacked and summed in one aggregate, so only partial sums are
    shuffled. Every row counts, whatever its date or count_to_balance flag.
    """
    return summed_flows(cash_legs(transactions)
                        .unionByName(trade_legs(exchanges))
                        .unionByName(transfer_legs(transfers)))


def merged_flows(flows: DataFrame, further: DataFrame) -> DataFrame:
    """Two sets of sums as one; a flow that neither has stays NULL."""
    return (flows.unionByName(further).groupBy("account", "currency")
            .agg(*[F.sum(name).alias(name) for name in FLOWS]))


def add_movements(flows: DataFrame, transactions: DataFrame) -> DataFrame:
    """Flows after further transactions, without reading the ledger again."""
    return merged_flows(flows, summed_flows(cash_legs(transactions)))


def against_flows(balances: DataFrame, flows: DataFrame,
                  settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """Each latest stated balance beside the balance the flows add up to."""
    checked = (latest_balances(balances)
               .join(flows, ["account", "currency"], "left")
               .fillna(0.0, list(FLOWS)))
    total = F.col(FLOWS[0])
    for name in FLOWS[1:]:
        total = total + F.col(name)
    return checked.select(
        "account", "currency", "calendar_date", "balance",
        F.round(total, settings.scale).alias("calculated_balance"),
        F.round(F.col("balance") - total, settings.scale).alias("difference"),
        *FLOWS)


def reconciliation(balances: DataFrame, transactions: DataFrame, exchanges: DataFrame,
                   transfers: DataFrame, settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    return against_flows(balances, ledger_flows(transactions, exchanges, transfers), settings)


def validation_report(checked: DataFrame,
                      settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """Reconciled rows that fail, largest gap first; empty when the ledger is valid."""
    failing = F.col("difference") != 0 if settings.two_sided else F.col("difference") > 0
    return checked.filter(failing).orderBy(F.abs("difference").desc())


def adjustment_entries(checked: DataFrame) -> DataFrame:
    """One ledger entry per discrepancy, in the sign convention of expense files."""
    return checked.filter(F.col("difference") != 0).select(
        F.lit(FIX_TAG).alias("tag"), (-F.col("difference")).alias("amount"),
        "calendar_date", "account",
        F.lit(FIX_CATEGORY).alias("category"), F.lit(FIX_SUBCATEGORY).alias("subcategory"),
        F.lit(True).alias("count_to_balance"), "currency")


def adjustment_flag(checked: DataFrame, settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """Whether every discrepancy is small enough to adjust; NULL when there is none."""
    tolerance = case(((is_one_of(F.col("currency"), currencies), F.lit(limit))
                      for limit, currencies in settings.tolerances),
                     F.lit(settings.default_tolerance))
    gap = F.abs("difference") if settings.two_sided else F.col("difference")
    return (checked.filter(F.col("difference") != 0)
            .agg(F.min(gap < tolerance).alias("adjust_allowed")))
