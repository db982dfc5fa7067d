"""Schemas of the six ledger tables and of the files they are loaded from."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()
_DATE, _B = T.DateType(), T.BooleanType()

TRANSACTIONS = _schema(
    ("id", _L), ("tag", _S), ("amount", _D), ("account", _S),
    ("calendar_date", _DATE), ("category", _S), ("subcategory", _S),
    ("currency", _S), ("count_to_balance", _B), ("transaction_type", _S),
)
EXCHANGES = _schema(
    ("id", _L), ("ticker", _S), ("account", _S), ("calendar_date", _DATE),
    ("price", _D), ("units", _D), ("tax", _D), ("exchange_type", _S),
    ("currency", _S), ("tax_currency", _S), ("count_to_balance", _B),
)
TRANSFERS = _schema(
    ("id", _L), ("source_acc", _S), ("destination_acc", _S),
    ("calendar_date", _DATE), ("amount", _D), ("currency", _S),
    ("count_to_balance", _B),
)
PRICES = _schema(
    ("ticker", _S), ("currency", _S), ("calendar_date", _DATE), ("price", _D),
)
BALANCES = _schema(
    ("account", _S), ("calendar_date", _DATE), ("currency", _S), ("amount", _D),
)
CATEGORY_MAPPING = _schema(
    ("category", _S), ("subcategory", _S), ("currency", _S), ("category_type", _S),
)

TABLES = {
    "transactions": TRANSACTIONS,
    "exchanges": EXCHANGES,
    "transfers": TRANSFERS,
    "prices": PRICES,
    "balances": BALANCES,
    "category_mapping": CATEGORY_MAPPING,
}

PRIMARY_KEYS = {
    "transactions": ("id",),
    "exchanges": ("id",),
    "transfers": ("id",),
    "prices": ("ticker", "currency", "calendar_date"),
    "balances": ("account", "calendar_date", "currency"),
}

# A stated balance may be missing; every other column is mandatory.
NULLABLE = {"balances": ("amount",)}


def required_columns(table: str) -> list[str]:
    optional = NULLABLE.get(table, ())
    return [name for name in TABLES[table].names if name not in optional]


def without(schema: T.StructType, *names: str) -> T.StructType:
    """The schema minus some columns, e.g. the id a file does not carry."""
    return T.StructType([f for f in schema.fields if f.name not in names])
