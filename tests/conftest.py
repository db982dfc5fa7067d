from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import DataFrame, SparkSession

from ledgerloom import schemas

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    builder = (SparkSession.builder.master("local[8]").appName("ledgerloom-tests")
               .config("spark.sql.shuffle.partitions", "2")
               .config("spark.default.parallelism", "1")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.driver.memory", "8g"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


class Make:
    """Small ledger tables from tuples, with defaults for what a case ignores."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def frame(self, rows, schema) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def prices(self, *rows) -> DataFrame:
        """(ticker, currency, date, price)"""
        return self.frame([(t, c, day(d), float(p)) for t, c, d, p in rows], schemas.PRICES)

    def rates(self, *rows) -> DataFrame:
        """(ticker, currency, month, price)"""
        return self.frame([(t, c, day(m), p) for t, c, m, p in rows],
                          "ticker string, currency string, calendar_month date, price double")

    def transactions(self, *rows) -> DataFrame:
        """(amount, account, date, category, subcategory, currency, counts, type)"""
        return self.frame([(i, "t", float(a), acc, day(d), cat, sub, cur, cnt, kind)
                           for i, (a, acc, d, cat, sub, cur, cnt, kind) in enumerate(rows)],
                          schemas.TRANSACTIONS)

    def exchanges(self, *rows) -> DataFrame:
        """(ticker, account, date, price, units, type, currency, counts)"""
        return self.frame([(i, t, acc, day(d), float(p), float(u), 0.0, kind, cur, cur, cnt)
                           for i, (t, acc, d, p, u, kind, cur, cnt) in enumerate(rows)],
                          schemas.EXCHANGES)

    def transfers(self, *rows) -> DataFrame:
        """(source, destination, date, amount, currency)"""
        return self.frame([(i, s, d, day(on), float(a), cur, True)
                           for i, (s, d, on, a, cur) in enumerate(rows)], schemas.TRANSFERS)

    def balances(self, *rows) -> DataFrame:
        """(account, date, currency, amount)"""
        return self.frame([(a, day(d), c, x) for a, d, c, x in rows], schemas.BALANCES)

    def mapping(self, *rows) -> DataFrame:
        """(category, subcategory, currency)"""
        return self.frame([(*r, "Income") for r in rows], schemas.CATEGORY_MAPPING)


@pytest.fixture(scope="session")
def make(spark) -> Make:
    return Make(spark)


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
