"""Shaping of raw extracts into ledger rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.settings import EXPENSES, INCOME


def unpivot_prices(wide: DataFrame, ids: tuple[str, ...] = ("ticker", "currency")) -> DataFrame:
    """Price matrix, one column per day-first date, into one row per known price."""
    days = [name for name in wide.columns if name not in ids]
    prices = wide.select(*ids, *[F.col(f"`{d}`").cast("double").alias(d) for d in days])
    return (prices.unpivot(list(ids), [f"`{d}`" for d in days], "calendar_date", "price")
            .dropna()
            .withColumn("calendar_date", dates.parse_day_first(F.col("calendar_date"))))


def tag_income(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_type", F.lit(INCOME))


def tag_expenses(df: DataFrame) -> DataFrame:
    """Expenses are kept as negative amounts."""
    return (df.withColumn("amount", -F.col("amount"))
            .withColumn("transaction_type", F.lit(EXPENSES)))


def dedupe_mapping(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def append_rows(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows added by column name; a column one side lacks is NULL there."""
    return ledger.unionByName(rows, allowMissingColumns=True)


def read_filtered(df: DataFrame, currency: str | None = None,
                  drop_removed: bool = False) -> DataFrame:
    """Optionally one currency, optionally without removed rows; never the flag."""
    if currency is not None:
        df = df.filter(F.col("currency") == currency)
    if drop_removed:
        df = df.filter(F.col("remove") == F.lit(False))
    return df.drop("remove")


def active_currencies(df: DataFrame) -> DataFrame:
    return df.select("currency").distinct().orderBy("currency")
