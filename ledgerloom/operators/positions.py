"""Monthly positions, their day-weighted averages and valuation changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.settings import PURCHASE, LedgerSettings

ROUNDING = 7


def cash_flow(transactions: DataFrame, exchanges: DataFrame,
              settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """calendar_month, ticker, units, avg_units from counted movements.

    Each source is scanned once: a trade row yields its two legs in place, and
    the partial sums leave one row per month and ticker of a task to shuffle.
    """
    moved = F.col("amount")
    cash = transactions.filter("count_to_balance").select(
        "calendar_date", F.col("currency").alias("ticker"),
        moved.alias("units"), moved.alias("weighted"))

    purchase = F.col("exchange_type") == PURCHASE
    cost = F.col("price") * F.col("units")
    received = F.when(purchase, F.col("units")).otherwise(-F.col("units"))
    paid = F.when(purchase, -cost).otherwise(cost)
    legs = F.array(
        F.struct(F.col("ticker").alias("ticker"), received.alias("units"),
                 received.alias("weighted")),
        F.struct(F.col("currency").alias("ticker"), paid.alias("units"),
                 (paid if settings.fix_quote_weight else -paid).alias("weighted")))
    trades = exchanges.filter("count_to_balance").select("calendar_date", F.inline(legs))

    date = F.col("calendar_date")
    return (cash.unionByName(trades)
            .groupBy(dates.month_start(date).alias("calendar_month"), "ticker")
            .agg(F.sum("units").alias("units"),
                 F.sum(dates.day_weighted(F.col("weighted"), date)).alias("avg_units")))


def running_totals(rates: DataFrame, flows: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Flows laid on the months that have a rate row, with their running sum.

    Rates hold every priced (ticker, month) once per reporting currency, so
    they are the grid; flows in a month without a price row do not appear.
    ``opening`` rows (ticker, currency, calendar_month, total, price) precede the months
    of ``rates`` and take the place of all before them: the sum goes on from their
    ``total``, which is not rounded. They are in the result, marked ``opens``.
    """
    rows = rates.join(flows, ["ticker", "calendar_month"], "left").select(
        "calendar_month", "ticker", "currency", F.coalesce(F.col("units"), F.lit(0.0)).alias("units"),
        F.coalesce(F.col("avg_units"), F.lit(0.0)).alias("avg_units"), "price", F.lit(False).alias("opens"))
    if opening is not None:
        rows = rows.unionByName(opening.select(
            "calendar_month", "ticker", "currency", F.col("total").alias("units"),
            F.lit(0.0).alias("avg_units"), "price", F.lit(True).alias("opens")))
    months = Window.partitionBy("ticker", "currency").orderBy("calendar_month")
    so_far = months.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("total", F.sum("units").over(so_far)).select(
        "calendar_month", "ticker", "currency",
        F.round("units", ROUNDING).alias("units"), F.round("avg_units", ROUNDING).alias("avg_units"),
        F.round("total", ROUNDING).alias("position"), F.round("price", ROUNDING).alias("price"),
        "total", "opens")


def running_position(rates: DataFrame, flows: DataFrame) -> DataFrame:
    return running_totals(rates, flows).drop("total", "opens")


def valued_positions(running: DataFrame, *further: str) -> DataFrame:
    """Previous month's position and price, converted values, valuation change.

    ``further`` columns of ``running`` are passed through.
    """
    months = Window.partitionBy("ticker", "currency").orderBy("calendar_month")
    previous = F.coalesce(F.lag("position").over(months), F.lit(0.0))
    return (running
            .select("calendar_month", "ticker", "currency", "units", "avg_units",
                    previous.alias("prev_position"), "position",
                    (previous + F.col("avg_units")).alias("avg_position"),
                    F.coalesce(F.lag("price").over(months), F.lit(0.0)).alias("prev_price"),
                    "price", *further)
            .withColumns({
                "c_position": F.col("position") * F.col("price"),
                "c_avg_position": F.col("avg_position") * F.col("price"),
                "c_value": (F.col("price") - F.col("prev_price")) * F.col("prev_position")}))


def positions(transactions: DataFrame, exchanges: DataFrame, rates: DataFrame,
              settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    return valued_positions(running_position(rates, cash_flow(transactions, exchanges, settings)))


def carried_forward(held: DataFrame, changes: DataFrame, rates: DataFrame, flows: DataFrame) -> DataFrame:
    """Positions after changes: months before a ticker's first changed one stay as they are.

    ``held``: earlier positions with their ``total``; ``changes``: ticker, from_month;
    ``rates`` and ``flows``: those of now. Later months of changed tickers are summed
    from the last one kept.
    """
    held = held.join(changes, "ticker", "left")
    stays = F.col("from_month").isNull() | (F.col("calendar_month") < F.col("from_month"))
    kept = held.filter(stays).drop("from_month")
    last = (held.filter(F.col("calendar_month") < F.col("from_month"))
            .groupBy("ticker", "currency")
            .agg(F.max(F.struct("calendar_month", "total", "price")).alias("last"))
            .select("ticker", "currency", "last.*"))
    later = (rates.join(changes, "ticker").filter(F.col("calendar_month") >= F.col("from_month"))
             .drop("from_month"))
    fresh = valued_positions(running_totals(later, flows, last), "total", "opens")
    return kept.unionByName(fresh.filter(~F.col("opens")).drop("opens"))
