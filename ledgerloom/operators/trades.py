"""Gains of trades against month-end prices, per reporting currency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.values import is_one_of, ratio
from ledgerloom.settings import PURCHASE, LedgerSettings
from ledgerloom.sources.scratch import LAZY


def rate_book(rates: DataFrame, settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """Per (ticker, month): for target i its end-of-month and start-of-month rate.

    The start of a month is the end of the one before, so each rate serves two
    months and one aggregate folds the uses into a row per key. Whether target i
    has a row this month is kept apart from its rate, which may be NULL.
    """
    rate, listed = F.col("price"), F.lit(True)
    number, flag = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    month = F.col("calendar_month")
    uses = F.array(*[
        F.struct(m.alias("calendar_month"), eom.alias("eom"), som.alias("som"), own.alias("listed"))
        for m, eom, som, own in ((month, rate, number, listed),
                                 (F.add_months(month, 1), number, rate, flag))])
    cells = []
    for i, target in enumerate(settings.targets):
        hit = F.col("currency") == target
        for name in ("eom", "som", "listed"):
            cells.append(F.max(F.when(hit, F.col(name))).alias(f"{name}_{i}"))
    return (rates.select("ticker", "currency", F.inline(uses))
            .groupBy("ticker", "calendar_month").agg(*cells))


def rate_lookups(exchanges: DataFrame, rates: DataFrame,
                 settings: LedgerSettings = LedgerSettings(), stage=LAZY) -> DataFrame:
    """Counted trades with the rates of both legs at the month's start and end.

    One row per trade and reporting currency in which its ticker has a rate row
    that month; a trade whose ticker has none keeps one row without rates. The
    rows multiply only after both lookups, so no copy is ever shuffled.

    Trades are paid in far fewer instruments than are traded, so the book of the
    other leg is cut to those. A stage given writes both books.
    """
    date = F.col("calendar_date")
    trades = exchanges.filter("count_to_balance").select(
        "calendar_date", dates.month_start(date).alias("calendar_month"),
        "ticker", "currency",
        F.when(F.col("exchange_type") == PURCHASE, F.col("units"))
        .otherwise(-F.col("units")).alias("units"),
        F.col("price").alias("original_trade_price"))

    book = stage.always(rate_book(rates, settings), "rate_book")
    paid_in = trades.select("currency").distinct()
    counter = stage.always(book.withColumnRenamed("ticker", "currency")
                           .join(paid_in, "currency", "left_semi"), "counter_book")
    rename = {f"{n}_{i}": f"c_{n}_{i}"
              for i in range(len(settings.targets)) for n in ("eom", "som", "listed")}
    counter = counter.withColumnsRenamed(rename)

    listed = [F.coalesce(F.col(f"listed_{i}"), F.lit(False))
              for i in range(len(settings.targets))]
    per_target = []
    for i, target in enumerate(settings.targets):
        rates_of = {"som_price": f"som_{i}", "eom_price": f"eom_{i}",
                    "c_som_price": f"c_som_{i}", "c_eom_price": f"c_eom_{i}"}
        keep = listed[i]
        if i == 0:
            # The row that stays when no target lists the ticker.
            keep = keep | ~F.greatest(*listed) if len(listed) > 1 else F.lit(True)
        per_target.append(F.struct(
            keep.alias("keep"), F.when(listed[i], F.lit(target)).alias("ex_currency"),
            *[F.when(listed[i], F.col(c)).alias(name) for name, c in rates_of.items()]))
    return (trades
            .join(book, ["ticker", "calendar_month"], "left")
            .join(counter, ["currency", "calendar_month"], "left")
            .select("calendar_month", "calendar_date", "ticker", "currency", "units",
                    "original_trade_price", F.dayofmonth("calendar_date").alias("days_passed"),
                    F.inline(F.array(*per_target)))
            .filter("keep").drop("keep"))


def _interpolated(start: Column, end: Column, elapsed: Column) -> Column:
    return elapsed * (end - start) + start


def price_estimates(lookups: DataFrame, settings: LedgerSettings = LedgerSettings()) -> DataFrame:
    """The trade-day price in each reporting currency, estimated three ways and settled."""
    days = dates.days_in_month(F.col("calendar_date"))
    passed = F.col("days_passed")
    elapsed = passed / days
    paid = F.col("original_trade_price")
    eom = F.col("eom_price")
    estimated = lookups.withColumns({
        "c_price": _interpolated(F.col("c_som_price"), F.col("c_eom_price"), elapsed),
        "linear_estimate": _interpolated(F.col("som_price"), eom, elapsed),
        "proportional_estimate": ratio(paid, ratio(eom, F.col("c_eom_price"))) * eom,
        "linear_alfa": F.lit(0.1) + F.lit(1.8) * (F.lit(0.5) * days - passed) / days,
    }).withColumn("c_linear_estimate", F.col("c_price") * paid)

    by_asset = F.coalesce("linear_estimate", "proportional_estimate", "c_linear_estimate")
    by_counter = F.coalesce("c_linear_estimate", "proportional_estimate", "linear_estimate")
    alfa = F.col("linear_alfa")
    early = F.col("calendar_month") < F.lit(settings.estimate_cutoff)
    final = (F.when(F.col("currency") == F.col("ex_currency"), paid)
             .when(early & is_one_of(F.col("currency"), settings.fixed_value), by_counter)
             .when(early & is_one_of(F.col("ticker"), settings.fixed_value), by_asset)
             .otherwise(alfa * by_asset + (F.lit(1.0) - alfa) * by_counter))
    return estimated.withColumn("final_estimate", final).drop("linear_alfa")


def gains(estimates: DataFrame) -> DataFrame:
    """What each leg gained between the trade and the month's end."""
    units, final = F.col("units"), F.col("final_estimate")
    eom = F.col("eom_price")
    given_up = F.col("c_eom_price") * F.col("original_trade_price")
    asset = (eom - final) * units
    counter = (final - given_up) * units
    return estimates.select(
        "calendar_month", "calendar_date", "ticker", "currency", "units",
        "original_trade_price", "ex_currency",
        asset.alias("trade_income"), counter.alias("c_trade_income"),
        (asset + counter).alias("total_trade_income"),
        ((eom - given_up) * units).alias("direct_trade_income"),
        "final_estimate", "days_passed", "som_price", "eom_price", "c_som_price",
        "c_eom_price", "c_price", "linear_estimate", "c_linear_estimate",
        "proportional_estimate")


def trade_income(exchanges: DataFrame, rates: DataFrame,
                 settings: LedgerSettings = LedgerSettings(), stage=LAZY) -> DataFrame:
    return gains(price_estimates(rate_lookups(exchanges, rates, settings, stage), settings))
