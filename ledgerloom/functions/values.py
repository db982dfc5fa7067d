"""Null-safe arithmetic and value cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def is_one_of(column: Column, values: Sequence[str]) -> Column:
    return column.isin(*values)


def case(branches: Iterable[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """The value of the first true branch."""
    chain = None
    for test, value in branches:
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain if otherwise is None else chain.otherwise(otherwise)


def sanitize(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN and the text ``nan`` into NULL and drop single quotes from text."""
    chosen = set(df.columns if columns is None else columns)
    cleaned = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in chosen and isinstance(field.dataType, T.StringType):
            column = F.when(column != "nan", F.replace(column, F.lit("'"), F.lit("")))
        elif field.name in chosen and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        cleaned.append(column.alias(field.name))
    return df.select(*cleaned)
