from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, values
from ledgerloom.operators import ingest
from ledgerloom.sources import csv_files
from tests.conftest import day, rows


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_extract_columns_go_by_name(spark, tmp_path):
    path = write(tmp_path, "balances.csv",
                 "Currency,amount,Account,calendar_date\nUSD,1.5,O'Neil,1/3/2023\nBRL,,B,01/03/2023\n")
    assert rows(csv_files.read_extract(spark, "balances", path)) == [
        ("B", day("2023-03-01"), "BRL", None), ("ONeil", day("2023-03-01"), "USD", 1.5)]


def test_types_of_every_kind(spark, tmp_path):
    path = write(tmp_path, "exchange.csv",
                 "ticker,account,calendar_date,price,units,tax,exchange_type,currency,"
                 "tax_currency,count_to_balance\n"
                 "X,A,31/12/2022,1.5,2,0,Purchase,USD,USD,True\nX,A,1/1/2023,1,2,0,Sale,USD,USD,0\n")
    got = csv_files.read_extract(spark, "exchange", path).orderBy("calendar_date").collect()
    assert [(r["calendar_date"], r["price"], r["count_to_balance"]) for r in got] == [
        (day("2022-12-31"), 1.5, True), (day("2023-01-01"), 1.0, False)]


def test_iso_dates_where_an_extract_has_them(spark, tmp_path):
    path = write(tmp_path, "transfers.csv",
                 "source_acc,destination_acc,calendar_date,amount,currency,count_to_balance\n"
                 "A,B,2023-03-01,5,USD,1\n")
    assert csv_files.read_extract(spark, "transfers", path).first()["calendar_date"] == day(
        "2023-03-01")


@pytest.mark.parametrize("line", ["A,32/1/2023,USD,1", "A,1/1/2023,USD,abc"])
def test_values_that_do_not_fit_are_errors(spark, tmp_path, line):
    path = write(tmp_path, "bad.csv", "account,calendar_date,currency,amount\n" + line + "\n")
    with pytest.raises(Exception, match="CAST|PARSE|DATE|DateTime"):
        csv_files.read_extract(spark, "balances", path).collect()


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path, "short.csv", "account,calendar_date,amount\nA,1/1/2023,1\n")
    with pytest.raises(Exception, match="currency"):
        csv_files.read_extract(spark, "balances", path)


def test_price_matrix_becomes_rows(spark, tmp_path):
    path = write(tmp_path, "prices.csv",
                 "Ticker,Currency,31/1/2023,28/02/2023\nX,USD,1.5,\nY,BRL,,\nZ,,3,4\n")
    assert rows(ingest.unpivot_prices(csv_files.read_text(spark, path))) == [
        ("X", "USD", day("2023-01-31"), 1.5)]


def test_signs_and_types(make):
    df = make.frame([(3.0,), (-1.0,)], "amount double")
    assert rows(ingest.tag_income(df)) == [(-1.0, "Income"), (3.0, "Income")]
    assert rows(ingest.tag_expenses(df)) == [(-3.0, "Expenses"), (1.0, "Expenses")]


def test_sanitize(make):
    df = make.frame([("nan", math.nan, 1), ("a'b''", 2.0, 2), (None, None, 3), ("NaN", 0.0, 4)],
                    "t string, x double, n int")
    assert rows(values.sanitize(df).orderBy("n")) == sorted(
        [(None, None, 1), ("ab", 2.0, 2), (None, None, 3), ("NaN", 0.0, 4)], key=repr)


def test_filtered_read(make):
    df = make.frame([("USD", True, 1), ("USD", False, 2), ("BRL", False, 3), ("USD", None, 4)],
                    "currency string, remove boolean, n int")
    assert [r["n"] for r in ingest.read_filtered(df).orderBy("n").collect()] == [1, 2, 3, 4]
    got = ingest.read_filtered(df, "USD", drop_removed=True)
    assert got.columns == ["currency", "n"] and [r["n"] for r in got.collect()] == [2]


def test_append_aligns_by_name(make):
    left = make.frame([(1, "a")], "id int, tag string")
    right = make.frame([("b",)], "tag string")
    assert rows(ingest.append_rows(left, right)) == [(1, "a"), (None, "b")]


@pytest.mark.parametrize("date, following, month_after, month_before", [
    ("2024-02-28", "2024-02-29", "2024-03-01", "2024-01-01"),
    ("2024-02-29", "2024-03-01", "2024-03-01", "2024-01-01"),
    ("2023-12-31", "2024-01-01", "2024-01-01", "2023-11-01"),
    ("2023-01-31", "2023-02-01", "2023-02-01", "2022-12-01"),
])
def test_calendar_steps(make, date, following, month_after, month_before):
    d = F.col("d")
    df = make.frame([(day(date),)], "d date").select(
        dates.next_day(d), dates.next_month(d), dates.previous_month(d),
        dates.truncate(d, "year"), dates.truncate(d, "month"), dates.truncate(d))
    first = date[:8] + "01"
    assert tuple(df.first()) == tuple(map(day, (
        following, month_after, month_before, date[:5] + "01-01", first, first)))


def test_day_first_export(make):
    df = make.frame([(day("2023-03-01"),)], "d date")
    assert df.select(dates.format_day_first(F.col("d"))).first()[0] == "01/03/2023"


def test_each_file_goes_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "balances"
    folder.mkdir()
    (folder / "a.csv").write_text("account,calendar_date,currency,amount\nA,31/1/2023,USD,1\n")
    (folder / "b.csv").write_text("Currency,Calendar_Date,Account,Amount\nBRL,28/2/2023,B,2\n")
    got = csv_files.read_extract(spark, "balances", str(folder))
    assert sorted((r["account"], r["currency"], r["amount"]) for r in got.collect()) == [
        ("A", "USD", 1.0), ("B", "BRL", 2.0)]
    (folder / "c.csv").write_text("account,currency,amount\nC,EUR,3\n")
    with pytest.raises(ValueError, match="c.csv lacks calendar_date"):
        csv_files.read_extract(spark, "balances", str(folder))


def test_price_files_of_different_months(spark, tmp_path):
    folder = tmp_path / "prices"
    folder.mkdir()
    (folder / "1.csv").write_text("Ticker,Currency,31/01/2023\nX,USD,1\n")
    (folder / "2.csv").write_text("Ticker,Currency,28/02/2023\nX,USD,2\n")
    got = ingest.unpivot_prices(csv_files.read_text(spark, str(folder)))
    assert sorted((str(r["calendar_date"]), r["price"]) for r in got.collect()) == [
        ("2023-01-31", 1.0), ("2023-02-28", 2.0)]


@pytest.mark.parametrize("text", ["31/02/2023", "01/13/2023", "00/01/2023", "01/01/2023 ", "01/01/2023\n"])
def test_padded_dates_are_read_as_strictly_as_others(spark, text):
    good = spark.createDataFrame([("01/02/2023",), ("1/2/2023",), ("29/02/2024",), (None,)], "t string")
    assert [r.d for r in good.select(dates.parse_day_first(F.col("t")).alias("d")).collect()] == [
        day("2023-02-01"), day("2023-02-01"), day("2024-02-29"), None]
    with pytest.raises(Exception, match="CANNOT_PARSE"):
        spark.createDataFrame([(text,)], "t string").select(dates.parse_day_first(F.col("t"))).collect()
