"""CSV extracts in, CSV reports out."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions import dates
from ledgerloom.functions.values import sanitize

# Texts the usual CSV reader takes for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
LONGEST_MISSING = max(map(len, MISSING))

_MOVEMENT = schemas.without(schemas.TRANSACTIONS, "id", "transaction_type")

# Columns each extract carries, and whether its dates are written day first.
EXTRACTS = {
    "income": (_MOVEMENT, True),
    "expenses": (_MOVEMENT, True),
    "adjustments": (_MOVEMENT, True),
    "exchange": (schemas.without(schemas.EXCHANGES, "id"), True),
    "transf": (schemas.without(schemas.TRANSFERS, "id"), True),
    "balances": (schemas.BALANCES, True),
    "income_mapping": (schemas.CATEGORY_MAPPING, True),
    "transfers": (schemas.without(schemas.TRANSFERS, "id"), False),
    "transactions": (schemas.without(schemas.TRANSACTIONS, "id"), False),
}


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of ``path`` (a file or a folder of part files) by their header.

    Only each file's first line is read.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found: dict[tuple[str, ...], list[str]] = {}
    for status in fs.listStatus(root):
        file = status.getPath()
        if not status.isFile() or file.getName().startswith(("_", ".")):
            continue
        stream = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(file), "UTF-8"))
        try:
            line = stream.readLine()
        finally:
            stream.close()
        names = next(csv.reader([line.removeprefix("\ufeff")])) if line else []
        found.setdefault(tuple(names), []).append(file.toString())
    return {names: sorted(files) for names, files in found.items() if names}


def _given(value: Column) -> Column:
    """Whether a text is none of the ``MISSING`` ones; longer texts are not compared with them."""
    return (F.octet_length(value) > LONGEST_MISSING) | ~value.isin(*MISSING)


def read_text(spark: SparkSession, path: str, position: str | None = None,
              required: tuple[str, ...] = ()) -> DataFrame:
    """Every column as text under its lower-cased header name, missing as NULL.

    Columns go by name in every file: files with one header are read together,
    and a column that a file lacks is NULL there unless it is ``required``, which
    is an error that names the file. Nothing is inferred from the data. Quoted
    line breaks are not supported. ``position`` names a further column that
    orders the rows as the files do.
    """
    frames = []
    for names, files in sorted(headers(spark, path).items()):
        lowered = [name.strip().lower() for name in names]
        lacking = [c for c in required if c not in lowered]
        if lacking:
            raise ValueError(f"{files[0]} lacks {', '.join(lacking)}")
        raw = (spark.read.option("header", True).option("mode", "FAILFAST")
               .option("enforceSchema", False).option("escape", '"').option("multiLine", False)
               .schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
               .csv(files))
        columns = [F.when(_given(F.col(f"`{name}`")), F.col(f"`{name}`")).alias(low)
                   for name, low in zip(names, lowered)]
        if position:
            # Lines of one block of a file are read in order by one task.
            columns.append(F.struct(
                F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                F.monotonically_increasing_id().alias("line")).alias(position))
        frames.append(raw.select(*columns))
    if not frames:
        raise ValueError(f"no CSV file with a header under {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def typed(text: DataFrame, schema: T.StructType, day_first: bool,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast text columns to the schema; a value that does not fit is an error."""
    columns = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType) and day_first:
            column = dates.parse_day_first(column)
        elif isinstance(field.dataType, T.DateType):
            column = F.to_date(column)
        elif not isinstance(field.dataType, T.StringType):
            column = column.cast(field.dataType)
        columns.append(column.alias(field.name))
    return sanitize(text.select(*columns, *keep))


def read_extract(spark: SparkSession, dataset: str, path: str,
                 position: str | None = None) -> DataFrame:
    """One of the ``EXTRACTS`` as a typed frame."""
    schema, day_first = EXTRACTS[dataset]
    text = read_text(spark, path, position, tuple(n.lower() for n in schema.names))
    return typed(text, schema, day_first, (position,) if position else ())


def write_csv(df: DataFrame, path: str) -> None:
    """One header-carrying part file per task under ``path``."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def state(spark: SparkSession, path: str) -> str:
    """Path, number of files, bytes and latest change of an extract, without reading it."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .agg(F.count("path").alias("n"), F.sum("length").alias("length"),
                  F.max("modificationTime").cast("double").alias("changed"))).first()
    return f"{path} {files['n']} {files['length']} {files['changed']!r}"
