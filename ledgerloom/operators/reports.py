"""Income and expense balance sheet, and asset allocation.

Every source of the balance sheet is first summed per month and instrument (or
own category), all sources are stacked, and the category mapping is joined and
summed once for the whole stack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.values import is_one_of
from ledgerloom.settings import EXPENSES, INCOME, LedgerSettings

VALUATION, ASSET_LEG, COUNTER_LEG = "valuation", "asset", "counter"


def converted_ledger(transactions: DataFrame, rates: DataFrame,
                     kinds: tuple[str, ...] = (INCOME, EXPENSES)) -> DataFrame:
    """Counted income and expenses per month and own category, in each target."""
    monthly = (transactions
               .filter(F.col("count_to_balance") & is_one_of(F.col("transaction_type"), kinds))
               .groupBy(F.col("transaction_type").alias("source"),
                        dates.month_start(F.col("calendar_date")).alias("calendar_month"),
                        "category", "subcategory", F.col("currency").alias("ticker"))
               .agg(F.sum("amount").alias("amount")))
    return (monthly.join(rates, ["ticker", "calendar_month"], "left")
            .groupBy("source", "calendar_month", "category", "subcategory", "currency")
            .agg(F.sum(F.col("amount") * F.col("price")).alias("amount"))
            .withColumn("map_key", F.col("subcategory")))


def instrument_valuation(positions: DataFrame) -> DataFrame:
    """Non-zero valuation changes; one per ticker, month and currency already."""
    return (positions.filter(F.col("c_value") != 0)
            .select(F.lit(VALUATION).alias("source"), "calendar_month",
                    F.col("ticker").alias("map_key"), "currency",
                    F.col("c_value").alias("amount")))


def instrument_trade_income(trade_income: DataFrame) -> DataFrame:
    """Non-zero gains summed per leg, month and instrument, from one pass of trades."""
    legs = F.array(
        F.struct(F.lit(ASSET_LEG).alias("source"), F.col("ticker").alias("map_key"),
                 F.col("trade_income").alias("amount")),
        F.struct(F.lit(COUNTER_LEG).alias("source"), F.col("currency").alias("map_key"),
                 F.col("c_trade_income").alias("amount")))
    return (trade_income
            .select("calendar_month", F.col("ex_currency"), F.inline(legs))
            .filter(F.col("amount") != 0)
            .groupBy("source", "calendar_month", "map_key",
                     F.col("ex_currency").alias("currency"))
            .agg(F.sum("amount").alias("amount")))


def categorised(amounts: DataFrame, mapping: DataFrame,
                settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """Amounts summed per source, month, mapped category and currency.

    Rows with a category of their own keep it when the mapping has none or the
    subcategory is exempt; expenses are never mapped.
    """
    labels = mapping.select(F.col("currency").alias("mapped"),
                            F.col("category").alias("map_category"),
                            F.col("subcategory").alias("map_subcategory"))
    matches = (F.col("map_key") == F.col("mapped")) & (F.col("source") != EXPENSES)
    own = is_one_of(F.col("subcategory"), settings.own_category) | F.col("map_category").isNull()
    return (amounts.join(labels, matches, "left")
            .groupBy("source", "calendar_month",
                     F.when(own, F.col("category")).otherwise(F.col("map_category"))
                     .alias("category"),
                     F.coalesce("map_subcategory", "subcategory").alias("subcategory"),
                     "currency")
            .agg(F.sum("amount").alias("amount")))


def _plain(amounts: DataFrame, name: str) -> DataFrame:
    return amounts.select("calendar_month", "category", "subcategory", "currency",
                          F.col("amount").alias(name))


def _own_labels(amounts: DataFrame) -> DataFrame:
    """Instrument amounts carry no category of their own."""
    text = F.lit(None).cast("string")
    return amounts.withColumns({"category": text, "subcategory": text})


def converted_expenses(transactions: DataFrame, rates: DataFrame) -> DataFrame:
    return _plain(converted_ledger(transactions, rates, (EXPENSES,)), "expenses")


def converted_income(transactions: DataFrame, rates: DataFrame, mapping: DataFrame,
                     settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    ledger = converted_ledger(transactions, rates, (INCOME,))
    return _plain(categorised(ledger, mapping, settings), "income")


def valuation_income(positions: DataFrame, mapping: DataFrame) -> DataFrame:
    amounts = _own_labels(instrument_valuation(positions))
    return _plain(categorised(amounts, mapping), "income")


def trade_income_by_category(trade_income: DataFrame, mapping: DataFrame) -> DataFrame:
    """Asset-leg rows and counter-leg rows, kept apart where categories coincide."""
    amounts = _own_labels(instrument_trade_income(trade_income))
    return _plain(categorised(amounts, mapping), "income")


def balance(transactions: DataFrame, rates: DataFrame, positions: DataFrame,
            trade_income: DataFrame, mapping: DataFrame,
            settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """calendar_month, category, subcategory, currency, income, expenses.

    Rows of different sources stay separate. Expenses, kept negative in the
    ledger, are shown positive; rows with neither amount are left out.
    """
    instruments = _own_labels(
        instrument_valuation(positions).unionByName(instrument_trade_income(trade_income)))
    stack = converted_ledger(transactions, rates).unionByName(instruments)
    is_expense = F.col("source") == EXPENSES
    return (categorised(stack, mapping, settings)
            .filter(F.col("amount").isNotNull())
            .select("calendar_month", "category", "subcategory", "currency",
                    F.when(~is_expense, F.col("amount")).alias("income"),
                    F.when(is_expense, -F.col("amount")).alias("expenses")))


def allocation(positions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Converted positions per month and category, for instruments still held."""
    labels = mapping.select(F.col("currency").alias("ticker"), "category", "subcategory")
    return (positions.filter(F.col("c_position") != 0)
            .select("calendar_month", "ticker", "currency", "c_position", "c_avg_position")
            .join(labels, "ticker", "left")
            .groupBy("calendar_month", "category", "subcategory", "currency")
            .agg(F.sum("c_position").alias("position"),
                 F.sum("c_avg_position").alias("avg_position")))
