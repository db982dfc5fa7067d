"""A whole run: load extracts, validate, adjust if needed, publish the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from enum import Enum
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions import dates
from ledgerloom.operators import ingest, maintenance, reconcile, references
from ledgerloom.operators.references import Reference
from ledgerloom.plans.advance import AdvancedTables
from ledgerloom.plans.ledger import Ledger, LedgerTables
from ledgerloom.settings import EXPENSES, FIX_CATEGORY, FIX_TAG, LedgerSettings
from ledgerloom.sources import csv_files
from ledgerloom.sources.snapshots import SnapshotTables

LOAD_ORDER = ("income", "expenses", "exchange", "transf", "balances", "prices")

TARGET = {
    "income": "transactions", "expenses": "transactions", "adjustments": "transactions",
    "exchange": "exchanges", "transf": "transfers", "balances": "balances", "prices": "prices",
    "income_mapping": "category_mapping", "transfers": "transfers",
    "transactions": "transactions",
}
# Loaded on top of what the table holds; every other extract starts it afresh.
ADDITIVE = {"expenses", "adjustments", "transfers", "transactions"}
WITH_IDS = {"transactions", "exchanges", "transfers"}
# Fixes booked by settlements, kept so that the next run loads them with the expenses.
FIXES = "booked_fixes"
FIX_SCHEMA = schemas.without(schemas.TRANSACTIONS, "id")
# What a load that has not come to its end has loaded so far.
PROGRESS = "load_progress"
PROGRESS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("dataset", "state")])
# The latest snapshot of balances is then found by partition, not by scan.
PARTITIONS = {"balances": ("calendar_date",)}
# Extracts read at once: the last tasks of one leave cores to the next.
AHEAD = 3


class Outcome(Enum):
    VALID = "valid"
    ADJUSTED = "adjusted"
    ROLLED_BACK = "rolled back"
    MAJOR_DISCREPANCIES = "major discrepancies"


class LoadError(RuntimeError):
    """An extract could not be loaded; the ones after it were not tried."""


@dataclass(frozen=True)
class LedgerFiles:
    """Where the extracts are and where the reports go."""

    extracts: Mapping[str, str]
    reports: str


def _last_balances(spark: SparkSession, path: str) -> DataFrame:
    """Balances by key; of a key given twice the later line counts."""
    rows = csv_files.read_extract(spark, "balances", path, position="line")
    return maintenance.collapse_batch(rows, schemas.PRIMARY_KEYS["balances"], ("amount",),
                                      sequence=("line",))


def prepare(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """An extract as rows of its ledger table, without the surrogate id."""
    if dataset == "prices":
        return ingest.unpivot_prices(csv_files.read_text(spark, path))
    if dataset == "balances":
        return _last_balances(spark, path)
    rows = csv_files.read_extract(spark, dataset, path)
    if dataset == "income":
        return ingest.tag_income(rows)
    if dataset in ("expenses", "adjustments"):
        return ingest.tag_expenses(rows)
    if dataset == "income_mapping":
        return ingest.dedupe_mapping(rows)
    return rows


def _next_id(table: DataFrame) -> int:
    return (table.agg(F.max("id").alias("id")).first()["id"] or 0) + 1


def reject_violations(table: str, rows: DataFrame) -> None:
    """Raise if rows break the table's mandatory columns or its primary key.

    At most one row per column and one offending key reach the driver.
    """
    mandatory = [c for c in schemas.required_columns(table) if c in rows.columns]
    missing = maintenance.not_null_violations(rows, mandatory).collect()
    if missing:
        raise ValueError("missing values: " + ", ".join(
            f"{r['column_name']} ({r['violations']} rows)" for r in missing))
    keys = schemas.PRIMARY_KEYS.get(table)
    if keys and set(keys) <= set(rows.columns):
        repeated = maintenance.primary_key_violations(rows, keys).first()
        if repeated:
            raise ValueError(f"repeated key: {repeated.asDict()}")


def checked_rows(tables: SnapshotTables, dataset: str, path: str, stage) -> DataFrame:
    """An extract's rows, written to the stage and free of violations."""
    rows = stage.always(prepare(tables.spark, dataset, path), f"load_{dataset}")
    reject_violations(TARGET[dataset], rows)
    return rows


def kept_fixes(tables: SnapshotTables, loaded: DataFrame) -> DataFrame | None:
    """Fixes that earlier settlements booked and that the ``loaded`` rows do not hold already."""
    if tables.current(FIXES) is None:
        return None
    fixes = tables.read(FIXES, FIX_SCHEMA)
    same = [fixes[c].eqNullSafe(loaded[c]) for c in FIX_SCHEMA.names]
    return fixes.join(loaded, same, "left_anti")


def load(tables: SnapshotTables, datasets: str | Sequence[str], paths: Mapping[str, str] | str,
         stage, ahead: Mapping[str, Future[DataFrame]] | None = None) -> None:
    """Load extracts of one table as one change: all of them or none.

    The table is replaced, or added to where the first extract is an additive one.
    Rows are checked before anything is published. Ids are assigned from 1, or
    on from the table's highest, so they need no check. Fixes that were booked
    on the expenses stay booked when the transactions are loaded afresh; those that
    the extract or the table holds are not loaded once more. Extracts whose checked
    rows are ``ahead`` are not read again.
    """
    if isinstance(datasets, str):
        datasets, paths = [datasets], {datasets: paths}
    table = TARGET[datasets[0]]
    adds = datasets[0] in ADDITIVE and tables.current(table) is not None
    parts = []
    for dataset in datasets:
        try:
            parts.append(ahead[dataset].result() if ahead and dataset in ahead
                         else checked_rows(tables, dataset, paths[dataset], stage))
        except Exception as error:
            raise LoadError(f"loading {dataset} failed: {error}") from error
    if "expenses" in datasets:
        held = parts[-1]
        if adds:
            held = held.unionByName(tables.read(table, schemas.TABLES[table]), allowMissingColumns=True)
        fixes = kept_fixes(tables, held)
        if fixes is not None:
            parts.append(stage.always(fixes, "fixes"))
    if table in WITH_IDS:
        start = _next_id(tables.read(table, schemas.TABLES[table])) if adds else 1
        for k, rows in enumerate(parts):
            parts[k] = maintenance.assign_ids(rows, start, stage=stage)
            start += rows.count() if k + 1 < len(parts) else 0
    names = schemas.TABLES[table].names
    rows = reduce(DataFrame.unionByName, [part.select(*names) for part in parts])
    if adds:
        tables.append(table, rows)
    else:
        tables.publish(table, rows, PARTITIONS.get(table, ()))


def load_all(tables: SnapshotTables, files: LedgerFiles, stage,
             order: Sequence[str] = LOAD_ORDER, resume: bool = False) -> None:
    """Load extracts in order and stop at the first that fails.

    Neighbours that share a table are one change, so no half of it is ever seen. What was
    loaded is recorded with the extracts' state until the whole order is done. With
    ``resume`` a load that stopped goes on after the tables whose extracts have not changed
    since; from the first that has, all are loaded. Extracts are read and checked
    ``AHEAD`` at a time; tables change in order, and none after a failure.
    """
    done = _progress(tables) if resume else {}
    record: dict[str, str] = {}
    groups = [(table, list(group)) for table, group in groupby(order, key=TARGET.get)]
    while groups:
        datasets = groups[0][1]
        state = {d: _state(tables.spark, d, files.extracts[d]) for d in datasets}
        if not all(done.get(d) == state[d] for d in datasets):
            break
        record |= state
        groups.pop(0)
    pool = ThreadPoolExecutor(AHEAD)
    try:
        # A state is taken before its extract is read.
        states = [{d: pool.submit(_state, tables.spark, d, files.extracts[d]) for d in datasets}
                  for _, datasets in groups]
        ahead = [{d: pool.submit(checked_rows, tables, d, files.extracts[d], stage) for d in datasets}
                 for _, datasets in groups]
        for (table, datasets), state, rows in zip(groups, states, ahead):
            state = {d: found.result() for d, found in state.items()}
            try:
                load(tables, datasets, files.extracts, stage, rows)
            except LoadError:
                raise
            except Exception as error:
                raise LoadError(f"loading {table} failed: {error}") from error
            record |= state
            _record_progress(tables, record)
    finally:
        pool.shutdown(cancel_futures=True)
    _record_progress(tables, {})


def _state(spark: SparkSession, dataset: str, path: str) -> str:
    try:
        return csv_files.state(spark, path)
    except Exception as error:
        raise LoadError(f"loading {dataset} failed: {error}") from error


def _progress(tables: SnapshotTables) -> dict[str, str]:
    """Extracts that a load which stopped has loaded, one row each."""
    if tables.current(PROGRESS) is None:
        return {}
    return {r["dataset"]: r["state"] for r in tables.read(PROGRESS, PROGRESS_SCHEMA).collect()}


def _record_progress(tables: SnapshotTables, record: Mapping[str, str]) -> None:
    rows = tables.spark.createDataFrame(sorted(record.items()), PROGRESS_SCHEMA)
    tables.publish(PROGRESS, rows.coalesce(1))


def _touched(rows: DataFrame, table: str) -> list:
    """Dates of the table's partitions that rows lie in: at most one value for each partition."""
    (day,) = PARTITIONS[table]
    return [r[day] for r in rows.select(day).distinct().collect()]


def _partitions(tables: SnapshotTables, table: str, days: Sequence) -> DataFrame:
    """The rows of some dates; the files of other dates are not opened."""
    (day,) = PARTITIONS[table]
    return tables.read(table, schemas.TABLES[table]).filter(F.col(day).isin(*days))


def _by_date(tables: SnapshotTables, table: str) -> bool:
    """Whether dates of the table can be rewritten alone."""
    return table in PARTITIONS and tables.extent(table)[1] == 0


def upsert_into(tables: SnapshotTables, table: str, batch: DataFrame, update: Sequence[str],
                stage, sequence: Sequence[str] = ()) -> None:
    """Upsert ``batch`` into a table by its primary key.

    Of a table kept by date only the dates of the batch are read and written.
    """
    keys = schemas.PRIMARY_KEYS[table]
    if not _by_date(tables, table):
        current = tables.read(table, schemas.TABLES[table])
        tables.publish(table, maintenance.upsert(current, batch, keys, update, sequence, stage),
                       PARTITIONS.get(table, ()))
        return
    (day,) = PARTITIONS[table]
    batch = stage.always(batch, "batch")
    days = _touched(batch, table)
    if None in days:
        raise ValueError(f"missing values: {day}")
    rows = maintenance.upsert(_partitions(tables, table, days), batch, keys, update, sequence, stage)
    if days:
        tables.replace(table, stage.always(rows, "dates"), day)


def delete_from(tables: SnapshotTables, table: str, predicate: Column, stage=None) -> None:
    """Remove the rows for which the predicate is true.

    With a stage, only those dates of a table kept by date are read and written that hold such rows.
    """
    current = tables.read(table, schemas.TABLES[table])
    if stage is None or not _by_date(tables, table):
        tables.publish(table, maintenance.delete_where(current, predicate), PARTITIONS.get(table, ()))
        return
    (day,) = PARTITIONS[table]
    days = _touched(current.filter(predicate), table)
    if days:
        rows = stage.always(
            maintenance.delete_where(_partitions(tables, table, days), predicate), "dates")
        left = set(_touched(rows, table))
        tables.replace(table, rows, day, [d for d in days if d not in left])


def update_table(tables: SnapshotTables, table: str, predicate: Column,
                 values: Mapping[str, Column], stage=None) -> None:
    """Set columns where the predicate is true; with a stage, by date as in ``delete_from``.

    Rows that change their date make the whole table be written.
    """
    current = tables.read(table, schemas.TABLES[table])
    if stage is None or not _by_date(tables, table) or set(values) & set(PARTITIONS[table]):
        tables.publish(table, maintenance.update_where(current, predicate, values),
                       PARTITIONS.get(table, ()))
        return
    days = _touched(current.filter(predicate), table)
    if days:
        rows = maintenance.update_where(_partitions(tables, table, days), predicate, values)
        tables.replace(table, stage.always(rows, "dates"), *PARTITIONS[table])


def _referring(tables: SnapshotTables, links: Sequence[Reference], table: str) -> dict[str, DataFrame]:
    names = {table, *(r.child for r in links), *(r.parent for r in links)}
    return {name: tables.read(name, schemas.TABLES.get(name)) for name in names}


def _publish_changed(tables: SnapshotTables, changed: Mapping[str, DataFrame]) -> None:
    # Children first: the same change, if it is repeated, finds its rows in the parent again.
    for name in reversed(list(changed)):
        tables.publish(name, changed[name], PARTITIONS.get(name, ()))


def change_keys(tables: SnapshotTables, links: Sequence[Reference], table: str, predicate: Column,
                values: Mapping[str, Column], stage) -> None:
    """``update_table`` for columns that other tables refer to: their rows follow, or none change.

    Everything is checked before the first table is published. A run that died in between
    is repeated, except for keys that trade places.
    """
    _publish_changed(tables, references.update_keys(
        _referring(tables, links, table), links, table, predicate, values, stage))


def delete_referred(tables: SnapshotTables, links: Sequence[Reference], table: str,
                    predicate: Column, stage) -> None:
    """``delete_from`` for rows that other tables may refer to."""
    _publish_changed(tables, references.delete_rows(
        _referring(tables, links, table), links, table, predicate, stage))


def open_tables(tables: SnapshotTables) -> LedgerTables:
    return LedgerTables(**{name: tables.read(name, schema)
                           for name, schema in schemas.TABLES.items()})


def settle(tables: SnapshotTables, settings: LedgerSettings, stage,
           adjusted_csv: str | None = None) -> Outcome:
    """Validate the ledger and adjust small discrepancies, or leave it as it was.

    The ledger is summed once, or only what was added to the sums kept from the last
    time; the verdict, the fixes and the check of the fixes all read those sums. The fixes are checked before they are published, so a
    failed adjustment has nothing to undo. Only verdicts reach the driver.
    """
    ledger = Ledger(open_tables(tables), settings, stage)
    # Only what was added since the last settlement is summed.
    ledger.flows = AdvancedTables(tables, stage, settings).flows()
    if ledger.validation_report.isEmpty():
        return Outcome.VALID
    if ledger.adjustment_flag.first()["adjust_allowed"] is not True:
        return Outcome.MAJOR_DISCREPANCIES
    booked = stage.always(ingest.tag_expenses(ledger.adjustment_entries), "booked")
    checked = ledger.reconciliation_after(booked)
    if not reconcile.validation_report(checked, settings).isEmpty():
        return Outcome.ROLLED_BACK
    numbered = maintenance.assign_ids(booked, _next_id(ledger.tables.transactions), stage=stage)
    # In this order: fixes that are booked but not recorded are worked out again after the next load.
    tables.append("transactions", numbered.select(*schemas.TRANSACTIONS.names))
    tables.append(FIXES, booked.select(*FIX_SCHEMA.names))
    if adjusted_csv:
        export_expenses(tables, adjusted_csv)
    return Outcome.ADJUSTED


def take_back_fixes(tables: SnapshotTables, predicate: Column) -> None:
    """Remove booked fixes for which the predicate (over transaction columns) is true.

    They leave the record first, so that no later load books them again.
    """
    fix = (F.col("tag") == FIX_TAG) & (F.col("category") == FIX_CATEGORY) & predicate
    if tables.current(FIXES) is not None:
        tables.publish(FIXES, maintenance.delete_where(tables.read(FIXES, FIX_SCHEMA), fix))
    delete_from(tables, "transactions", fix)


def export_expenses(tables: SnapshotTables, path: str) -> None:
    """The expense side of the ledger as an extract: positive amounts, day-first dates."""
    names = csv_files.EXTRACTS["expenses"][0].names
    ledger = tables.read("transactions", schemas.TRANSACTIONS)
    rows = (ledger.filter(F.col("transaction_type") == EXPENSES)
            .withColumn("amount", -F.col("amount"))
            .withColumn("calendar_date", dates.format_day_first(F.col("calendar_date"))))
    csv_files.write_csv(rows.select(*names), path)


def publish_reports(tables: SnapshotTables, folder: str, settings: LedgerSettings,
                    stage=None) -> None:
    ledger = Ledger(open_tables(tables), settings, stage, ("exchange_rates", "positions"))
    try:
        csv_files.write_csv(ledger.balance, f"{folder}/balance.csv")
        csv_files.write_csv(ledger.allocation, f"{folder}/positions.csv")
    finally:
        ledger.close()


def run(tables: SnapshotTables, files: LedgerFiles, stage,
        settings: LedgerSettings = LedgerSettings()) -> Outcome:
    """Load, settle and report; reports are published whatever the verdict."""
    load_all(tables, files, stage)
    outcome = settle(tables, settings, stage, f"{files.reports}/expenses_adjusted.csv")
    publish_reports(tables, files.reports, settings, stage)
    return outcome
