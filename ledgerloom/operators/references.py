"""Changes of keys and rows that other tables refer to.

A ``Reference`` says that a column of one table holds keys of another, and what a
change of those keys does: ``cascade`` passes it on, ``restrict`` forbids it. Keys that
change travel along the references as small tables of their own, cut at each table to
those that it really uses, so a table nobody's keys changed for is handed back as it was.
Tables are only read; what comes back is their new content.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.scratch import LAZY

CASCADE, RESTRICT = "cascade", "restrict"


class BrokenReference(ValueError):
    """A change that the references between tables do not allow."""


@dataclass(frozen=True)
class Reference:
    """``child.column`` holds values of ``parent.key``; NULL refers to nothing."""

    child: str
    column: str
    parent: str
    key: str
    on_update: str = CASCADE
    on_delete: str = RESTRICT

    def __post_init__(self):
        if {self.on_update, self.on_delete} - {CASCADE, RESTRICT}:
            raise ValueError(f"an action is {CASCADE} or {RESTRICT}: {self}")


def parents_first(references: Sequence[Reference]) -> list[str]:
    """Tables in an order in which parents precede their children."""
    graph: dict[str, set[str]] = {}
    for reference in references:
        graph.setdefault(reference.child, set()).add(reference.parent)
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as error:
        raise BrokenReference("tables refer to each other in a circle: "
                             + " -> ".join(error.args[1])) from error


def _first(df: DataFrame, problem: str) -> None:
    """Raise with one row of ``df`` if it has any."""
    row = df.first()
    if row is not None:
        raise BrokenReference(f"{problem}: {row.asDict()}")


def _used(child: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``keys`` (with a column ``old``) that the child's column holds."""
    held = child.select(F.col(f"`{column}`").alias("old")).filter("old is not null").distinct()
    return keys.join(held, "old", "left_semi")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def update_keys(tables: Mapping[str, DataFrame], references: Sequence[Reference], table: str,
                predicate: Column, values: Mapping[str, Column], stage=LAZY) -> dict[str, DataFrame]:
    """The tables that change, parents first, when columns are set where the predicate is true.

    Values are computed from the old row. Where another table refers to a column that is
    set, its rows follow (cascade) or, if any holds a key that changes, the change is
    refused (restrict). Refused as well are a new key that is NULL, an old key with two
    new ones, one that changes in some of its rows only, and a new key that another row
    keeps. The keys may trade places.
    """
    order = parents_first(references)
    hit = F.coalesce(predicate, F.lit(False))
    result: dict[str, DataFrame] = {table: tables[table].select(*[
        F.when(hit, values[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in values else F.col(f"`{c}`")
        for c in tables[table].columns])}
    moves: dict[tuple[str, str], DataFrame] = {}
    for column in {r.key for r in references if r.parent == table and r.key in values}:
        every = tables[table].select(F.col(f"`{column}`").alias("old"),
                                     F.when(hit, values[column]).otherwise(F.col(f"`{column}`")).alias("new"))
        moved = stage.always(every.filter(~F.col("old").eqNullSafe(F.col("new")) & F.col("old").isNotNull())
                             .distinct(), "moved")
        _first(moved.filter("new is null"), f"{table}.{column} would lose a key")
        _first(moved.groupBy("old").agg(F.count("*").alias("n")).filter("n > 1"),
               f"{table}.{column} would split a key")
        kept = every.filter("old = new")
        _first(kept.join(moved.select("old"), "old", "left_semi"), f"{table}.{column} would split a key")
        _first(kept.join(moved.select("new"), "new", "left_semi"), f"{table}.{column} would repeat a key")
        _first(moved.groupBy("new").agg(F.count("*").alias("n")).filter("n > 1"),
               f"{table}.{column} would repeat a key")
        moves[table, column] = moved
    for child in order:
        arriving: dict[str, list[DataFrame]] = {}
        for r in references:
            moved = moves.get((r.parent, r.key)) if r.child == child else None
            if moved is None:
                continue
            if r.on_update == RESTRICT:
                _first(_used(tables[child], r.column, moved), f"{child}.{r.column} still refers to it")
            else:
                arriving.setdefault(r.column, []).append(moved)
        for column, parts in arriving.items():
            # A column that refers to two tables follows either; they may not disagree.
            here = stage.always(_used(tables[child], column, _union(parts).distinct()), "moved")
            _first(here.groupBy("old").agg(F.count("*").alias("n")).filter("n > 1"),
                   f"{child}.{column} would follow two keys")
            if here.isEmpty():
                continue
            if child == table and column in values:
                raise BrokenReference(f"{child}.{column} is set and follows a key as well")
            moves[child, column] = here
            frame = result.get(child, tables[child])
            following = here.select(F.col("old").alias(column), F.struct("new").alias("__follows"))
            result[child] = frame.join(following, column, "left").select(*[
                F.when(F.col("__follows").isNotNull(), F.col("__follows")["new"])
                .otherwise(F.col(f"`{c}`")).alias(c) if c == column else F.col(f"`{c}`")
                for c in frame.columns])
    return {name: result[name] for name in [*order, table] if name in result}


def delete_rows(tables: Mapping[str, DataFrame], references: Sequence[Reference], table: str,
                predicate: Column, stage=LAZY) -> dict[str, DataFrame]:
    """The tables that change, parents first, when the rows with a true predicate go.

    A key is gone if no row of its table holds it any more. Rows that refer to a gone key
    go too (cascade) or, if there are any, nothing may go (restrict). Whether rows remain
    that refer to a key is asked after all cascades, as they may have gone themselves.
    """
    order = parents_first(references)
    result = {table: tables[table].filter(~F.coalesce(predicate, F.lit(False)))}
    checks: list[tuple[Reference, DataFrame]] = []
    for parent in [*order, *([] if table in order else [table])]:
        for r in references:
            # All references to a table are followed before those that start from it.
            if r.child != parent or r.parent not in result:
                continue
            keys = lambda df: (df.select(F.col(f"`{r.key}`").alias("old"))
                               .filter("old is not null").distinct())
            lost = keys(tables[r.parent]).join(keys(result[r.parent]), "old", "left_anti")
            gone = stage.always(_used(tables[parent], r.column, lost), "gone")
            if gone.isEmpty():
                continue
            if r.on_delete == RESTRICT:
                checks.append((r, gone))
            else:
                frame = result.get(parent, tables[parent])
                result[parent] = frame.join(
                    gone.select(F.col("old").alias(r.column)), r.column, "left_anti").select(*frame.columns)
    for r, gone in checks:
        _first(_used(result.get(r.child, tables[r.child]), r.column, gone),
               f"{r.child}.{r.column} still refers to it")
    return {name: result[name] for name in [*order, table] if name in result}
