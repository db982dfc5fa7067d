"""Monthly exchange rates of every quoted instrument in the reporting currencies.

A price reaches a reporting currency by one of three routes: it is quoted in it
(1), its quote currency is itself priced in it on that date (2), or the
reporting currency is priced in its quote currency on that date (3). Both
lookups are rows about quote currencies, so they are gathered into one small
``conversion_book`` and each price row looks its routes up once, instead of
pairing prices that merely share a quote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.values import case, is_one_of, ratio
from ledgerloom.settings import REPORTING_CURRENCIES
from ledgerloom.sources.scratch import LAZY

DIRECT, ONWARD, REVERSE = 1, 2, 3


def rate_grid(prices: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES) -> DataFrame:
    """Each priced (ticker, date) once per reporting currency."""
    wanted = F.explode(F.array(*[F.lit(t) for t in targets]))
    return (prices.select("ticker", "calendar_date").distinct()
            .select("ticker", wanted.alias("currency"), "calendar_date"))


def conversion_book(prices: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES,
                    stage=LAZY) -> DataFrame:
    """Per (quote, date): for target i its onward price and its reverse divisor.

    A stage given writes the book, and before it the distinct quote currencies,
    whatever their size. A price row yields its two uses, as a price in a target
    and as the price of a target, in one pass; uses no other price can make of are
    left out before the shuffle.
    """
    quotes = stage.always(
        prices.select(F.col("currency").alias("used")).distinct(), "quotes")
    none = F.lit(None).cast("double")
    ticker, currency, price = F.col("ticker"), F.col("currency"), F.col("price")
    entries = F.array(
        F.struct(is_one_of(currency, targets).alias("open"), ticker.alias("quote"),
                 currency.alias("target"), price.alias("onward"), none.alias("reverse")),
        F.struct(is_one_of(ticker, targets).alias("open"), currency.alias("quote"),
                 ticker.alias("target"), none.alias("onward"), price.alias("reverse")))
    routes = (prices.filter(is_one_of(currency, targets) | is_one_of(ticker, targets))
              .select("calendar_date", F.inline(entries)).filter("open")
              .join(quotes, F.col("quote") == F.col("used"), "left_semi"))
    cells = []
    for i, target in enumerate(targets):
        hit = F.col("target") == target
        cells.append(F.min(F.when(hit, F.col("onward"))).alias(f"onward_{i}"))
        cells.append(F.min(F.when(hit, F.col("reverse"))).alias(f"reverse_{i}"))
    return stage.always(routes.groupBy("quote", "calendar_date").agg(*cells), "conversion_book")


def _with_book(prices: DataFrame, book: DataFrame) -> DataFrame:
    return (prices.select("ticker", F.col("currency").alias("quote"), "calendar_date",
                          F.col("price").alias("quoted"))
            .join(book, ["quote", "calendar_date"], "left"))


def _routes(i: int, target: str) -> list[tuple[int, Column, Column]]:
    """(priority, is it open, price) of the three routes to target i, best first."""
    onward, reverse = F.col(f"onward_{i}"), F.col(f"reverse_{i}")
    return [
        (DIRECT, F.col("quote") == target, F.col("quoted")),
        (ONWARD, onward.isNotNull(), F.col("quoted") * onward),
        (REVERSE, reverse.isNotNull(), ratio(F.col("quoted"), reverse)),
    ]


def conversions(prices: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES,
                stage=LAZY) -> DataFrame:
    """Every open route of every price row, several per row where several exist."""
    entries = []
    for i, target in enumerate(targets):
        for priority, is_open, price in _routes(i, target):
            entries.append(F.struct(
                is_open.alias("open"), F.lit(target).alias("currency"),
                F.lit(priority).alias("priority"), price.alias("price")))
    return (_with_book(prices, conversion_book(prices, targets, stage))
            .select("ticker", "quote", "calendar_date", F.inline(F.array(*entries)))
            .filter("open").drop("open"))


def best_routes(prices: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES,
                stage=LAZY, book: DataFrame | None = None) -> DataFrame:
    """One row per price row and target: its best route, NULL where it has none.

    The ``book`` is that of these prices unless one of more prices is given.
    """
    entries = []
    for i, target in enumerate(targets):
        routes = _routes(i, target)
        entries.append(F.struct(
            F.lit(target).alias("currency"),
            case((is_open, F.lit(number)) for number, is_open, _ in routes).alias("priority"),
            case((is_open, price) for _, is_open, price in routes).alias("price")))
    book = conversion_book(prices, targets, stage) if book is None else book
    return (_with_book(prices, book)
            .select("ticker", "quote", "calendar_date", F.inline(F.array(*entries))))


# Bit of the date's day in a month-wide mask: which days have been seen.
_DAY_BIT = "shiftleft(1, day(calendar_date) - 1)"


def consolidation(prices: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES,
                  stage=LAZY) -> DataFrame:
    """Distinct best-route prices of each (ticker, currency, month).

    A date without any route contributes a row with NULL price and priority; a
    date on which at least one quote of the ticker has a route does not.
    """
    cell = ["ticker", "currency", "calendar_month"]
    marked = (best_routes(prices, targets, stage)
              .withColumn("calendar_month", dates.month_start(F.col("calendar_date")))
              .groupBy(*cell, "price", "priority")
              .agg(F.bit_or(F.expr(_DAY_BIT)).alias("days")))
    routed = F.when(F.col("priority").isNotNull(), F.col("days")).otherwise(F.lit(0))
    served = F.bit_or(routed).over(Window.partitionBy(*cell))
    return (marked.withColumn("served", served)
            .filter(F.col("priority").isNotNull()
                    | (F.col("days").bitwiseAND(F.bitwise_not(F.col("served"))) != 0))
            .select(*cell, "price", "priority"))


def exchange_rates(prices: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES,
                   stage=LAZY, book: DataFrame | None = None) -> DataFrame:
    """ticker, currency, calendar_month, price: one rate per month and target.

    The best route of the month wins; equal ones are settled by the latest
    date, then the quote currency, then the price. A month with a date that no
    route serves has no rate (NULL). Both follow from one aggregate with
    map-side combining: a minimum over routed rows, and the days seen compared
    with the days served.
    """
    routed = F.col("priority").isNotNull()
    day_bit = F.expr(_DAY_BIT)
    preference = F.struct(
        F.col("priority"), (-F.dayofmonth("calendar_date")).alias("recency"),
        F.col("quote"), F.col("price"))
    return (best_routes(prices, targets, stage, book)
            .withColumn("calendar_month", dates.month_start(F.col("calendar_date")))
            .groupBy("ticker", "currency", "calendar_month")
            .agg(F.min(F.when(routed, preference)).alias("best"),
                 F.bit_or(day_bit).alias("seen"),
                 F.bit_or(F.when(routed, day_bit).otherwise(F.lit(0))).alias("served"))
            .select("ticker", "currency", "calendar_month",
                    F.when(F.col("seen") == F.col("served"), F.col("best.price")).alias("price")))


CELL = ["ticker", "calendar_month"]


def touched_cells(prices: DataFrame, added: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES,
                  stage=LAZY) -> DataFrame:
    """(ticker, calendar_month) of every rate that ``added`` prices can have changed.

    A price touches its own ticker. Priced in a target it also serves, as onward route,
    all prices quoted in its ticker on that date; as the price of a target it serves, as
    reverse route, all prices quoted in its currency. ``prices`` holds the added ones too.
    """
    month = dates.month_start(F.col("calendar_date"))
    ticker, currency = F.col("ticker"), F.col("currency")
    served = F.filter(F.array(F.when(is_one_of(currency, targets), ticker),
                              F.when(is_one_of(ticker, targets), currency)), lambda q: q.isNotNull())
    quotes = stage.always(added.select(F.explode(served).alias("currency"), "calendar_date").distinct(),
                          "touched_quotes")
    through = prices.join(quotes, ["currency", "calendar_date"], "left_semi").select(
        "ticker", month.alias("calendar_month"))
    own = added.select("ticker", month.alias("calendar_month"))
    return stage.always(own.unionByName(through).distinct(), "touched_cells")


def rates_of_cells(prices: DataFrame, cells: DataFrame, targets: Sequence[str] = REPORTING_CURRENCIES,
                   stage=LAZY) -> DataFrame:
    """The exchange rates of some (ticker, calendar_month) cells.

    Only prices of these months are grouped, and only those of the cells looked up.
    """
    months = cells.select("calendar_month").distinct()
    dated = prices.withColumn("calendar_month", dates.month_start(F.col("calendar_date")))
    book = conversion_book(dated.join(months, "calendar_month", "left_semi"), targets, stage)
    return exchange_rates(dated.join(cells, CELL, "left_semi").drop("calendar_month"),
                          targets, stage, book)
