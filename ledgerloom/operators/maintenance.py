"""Row-level changes and integrity reports on ledger tables.

Each change returns the new content of the table; publishing it as a snapshot
is left to the caller (``sources.snapshots``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.scratch import LAZY

# Files are numbered inside this many groups, which are few enough for one task.
FILE_GROUPS = 1024


def collapse_batch(batch: DataFrame, keys: Sequence[str], update: Sequence[str],
                   sequence: Sequence[str] = ()) -> DataFrame:
    """One row per key: updated columns from the last row, others from the first.

    ``sequence`` orders the rows of a key; rows it leaves tied are ordered by
    their values. Partial aggregation keeps repeated keys off the shuffle.
    """
    rest = [c for c in batch.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in [*sequence, *rest]])
    kept = [c for c in rest if c not in sequence]
    rows = batch.groupBy(*keys).agg(
        F.min_by(F.struct(*kept), order).alias("first_row"),
        F.max_by(F.struct(*kept), order).alias("last_row"),
    )
    return rows.select(*keys, *[
        F.col("last_row" if c in update else "first_row")[c].alias(c) for c in kept
    ])


def upsert(table: DataFrame, batch: DataFrame, keys: Sequence[str],
           update: Sequence[str], sequence: Sequence[str] = (), stage=LAZY) -> DataFrame:
    """Insert rows with new keys; on known keys overwrite only ``update`` columns.

    A stage given writes the collapsed batch and those of its keys that the table
    has, so their true sizes are known: a batch small enough to broadcast leaves
    the table unshuffled, a large one shuffles it by key. Beside its rows, the
    table's keys alone are read.
    """
    source = stage.always(collapse_batch(batch, keys, update, sequence), "batch")
    changes = source.select(
        *keys,
        F.struct(*[F.col(c) for c in update]).alias("change"),
    )
    changed = table.join(changes, list(keys), "left").select(*[
        F.when(F.col("change").isNotNull(), F.col("change")[c]).otherwise(F.col(c)).alias(c)
        if c in update else F.col(c)
        for c in table.columns
    ])
    known = stage.always(
        table.select(*keys).join(source.select(*keys), list(keys), "left_semi"), "known")
    fresh = source.join(known, list(keys), "left_anti")
    return changed.unionByName(fresh, allowMissingColumns=True).select(*table.columns)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows for which the predicate is true."""
    return df.select(*[
        F.when(predicate, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns
    ])


def assign_ids(stored: DataFrame, start: int = 1, name: str = "id", stage=LAZY) -> DataFrame:
    """Number the rows of a stored Parquet table ``start``, ``start + 1``, ...

    Rows are numbered file by file from their position in the file, which every
    retry sees alike. A file's offset is a prefix sum of the counts in two steps:
    inside each of ``FILE_GROUPS`` groups of files, and over the groups. Nothing
    reaches the driver and rows are not sorted; a stage given writes the offsets,
    one row for each file, so that the join knows their size.
    """
    located = stored.select("*", F.col("_metadata.file_path").alias("_file"),
                            F.col("_metadata.row_index").alias("_position"))
    sizes = (located.groupBy("_file").agg(F.count("*").alias("n"))
             .withColumn("_group", F.pmod(F.xxhash64("_file"), F.lit(FILE_GROUPS))))
    before = lambda w: F.coalesce(F.sum("n").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = sizes.withColumn("_inside", before(Window.partitionBy("_group").orderBy("_file")))
    # One row for each group, whatever the number of files.
    groups = (sizes.groupBy("_group").agg(F.sum("n").alias("n"))
              .select("_group", before(Window.orderBy("_group")).alias("_before")))
    offsets = stage.always(
        inside.join(groups, "_group")
        .select("_file", (F.col("_before") + F.col("_inside") + start).alias("_offset")), "offsets")
    return located.join(offsets, "_file").select(
        (F.col("_offset") + F.col("_position")).alias(name),
        *[c for c in stored.columns if c != name])


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, violations) for each mandatory column that holds NULLs."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return (counts.unpivot([], [f"`{c}`" for c in columns], "column_name", "violations")
            .filter(F.col("violations") > 0))


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by several rows, with their number."""
    return (df.groupBy(*keys).agg(F.count("*").alias("copies"))
            .filter(F.col("copies") > 1))


def foreign_key_violations(child: DataFrame, key: str, parent: DataFrame,
                           parent_key: str) -> DataFrame:
    """Referring values without a parent row, with the number of rows using them.

    Values are counted before the join, so a frequent one is a single row there.
    """
    used = (child.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.count("*").alias("orphans")))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
