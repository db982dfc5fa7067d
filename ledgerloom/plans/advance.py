"""Derived tables brought up to date from what was added to the ledger since.

Each is kept as a snapshot table of its own. Every row also says up to where the
ledger tables are in it (``covered``: snapshot and part of each), so rows and coverage
are committed together; a run that dies in between does its work again. Parts added to
a covered snapshot are the only rows of a ledger that are read. A table that was
replaced since (an update, a deletion, a fresh load) has another snapshot: what came
from it is worked out again from the whole of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import fx, positions, reconcile
from ledgerloom.settings import LedgerSettings
from ledgerloom.sources.snapshots import SnapshotTables

COVERED = "covered"
FLOW_SUMS, MONTHLY_FLOWS, RATES, POSITIONS = "flow_sums", "monthly_flows", "rates", "held_positions"

Extents = dict[str, tuple[int, int]]

# The flows that each ledger's rows make up.
LEGS = {
    "transactions": (reconcile.cash_legs, reconcile.FLOWS[0:2]),
    "exchanges": (reconcile.trade_legs, reconcile.FLOWS[2:4]),
    "transfers": (reconcile.transfer_legs, reconcile.FLOWS[4:6]),
}


class AdvancedTables:
    """The derived tables over the ledger in ``tables``, which they are kept beside."""

    def __init__(self, tables: SnapshotTables, stage, settings: LedgerSettings = LedgerSettings()):
        self.tables = tables
        self.stage = stage
        self.settings = settings

    def _state(self, name: str) -> tuple[DataFrame | None, Extents]:
        """A derived table and what it covers; none if it has no rows."""
        if self.tables.current(name) is None:
            return None, {}
        state = self.tables.read(name)
        first = state.select(COVERED).first()
        if first is None:
            return None, {}
        return state.drop(COVERED), {k: (v["snapshot"], v["part"]) for k, v in first[COVERED].items()}

    def _publish(self, name: str, rows: DataFrame, extents: Extents) -> DataFrame:
        entries = [part for table, (snapshot, last) in extents.items() for part in (
            F.lit(table), F.struct(F.lit(snapshot).alias("snapshot"), F.lit(last).alias("part")))]
        self.tables.publish(name, rows.withColumn(COVERED, F.create_map(*entries)))
        return self.tables.read(name).drop(COVERED)

    def pending(self, covered: Extents, names: Sequence[str]) -> tuple[Extents, dict[str, DataFrame], set[str]]:
        """How far the ledger tables go now, the rows not covered yet, and the tables begun anew."""
        extents = {name: self.tables.extent(name) for name in names}
        fresh = {n for n in names if covered.get(n, (None,))[0] != extents[n][0]}
        rows = {}
        for name, extent in extents.items():
            if name in fresh:
                rows[name] = self.tables.read(name, schemas.TABLES[name], extent)
            elif covered[name][1] < extent[1]:
                rows[name] = self.tables.read(name, schemas.TABLES[name], extent, after=covered[name][1])
        return extents, rows, fresh

    def flows(self) -> DataFrame:
        """The six flows per (account, currency); only added parts of the ledgers are summed."""
        state, covered = self._state(FLOW_SUMS)
        extents, rows, fresh = self.pending(covered, tuple(LEGS))
        if state is not None and not rows:
            return state
        legs = [LEGS[name][0](df) for name, df in rows.items()]
        sums = reconcile.summed_flows(reduce(DataFrame.unionByName, legs))
        if state is not None:
            gone = {flow for name in fresh for flow in LEGS[name][1]}
            old = state.withColumns({flow: F.lit(None).cast("double") for flow in gone})
            sums = reconcile.merged_flows(old, sums)
        return self._publish(FLOW_SUMS, sums, extents)

    def reconciliation(self) -> DataFrame:
        balances = self.tables.read("balances", schemas.BALANCES)
        return reconcile.against_flows(balances, self.flows(), self.settings)

    def rates(self) -> tuple[DataFrame, DataFrame]:
        """Exchange rates, and the (ticker, calendar_month) cells that may be new since the last time."""
        state, covered = self._state(RATES)
        extents, rows, fresh = self.pending(covered, ("prices",))
        prices = self.tables.read("prices", schemas.PRICES, extents["prices"])
        if state is None or fresh:
            now = fx.exchange_rates(prices, self.settings.targets, self.stage)
            cells = now.select(*fx.CELL)
            if state is not None:
                cells = cells.unionByName(state.select(*fx.CELL))
            cells = self.stage.always(cells.distinct(), "cells")
            return self._publish(RATES, now, extents), cells
        if not rows:
            return state, state.select(*fx.CELL).limit(0)
        cells = fx.touched_cells(prices, rows["prices"], self.settings.targets, self.stage)
        now = fx.rates_of_cells(prices, cells, self.settings.targets, self.stage)
        return self._publish(RATES, state.join(cells, fx.CELL, "left_anti").unionByName(now), extents), cells

    def monthly_flows(self) -> tuple[DataFrame, DataFrame]:
        """Flows per month and ticker, and the (ticker, calendar_month) cells that may be new."""
        state, covered = self._state(MONTHLY_FLOWS)
        extents, rows, fresh = self.pending(covered, ("transactions", "exchanges"))
        if state is not None and not rows:
            return state, state.select(*fx.CELL).limit(0)
        again = state is None or bool(fresh)
        if again:  # sums of both ledgers are kept as one
            rows = {n: self.tables.read(n, schemas.TABLES[n], extents[n]) for n in extents}
        none = {n: self.tables.read(n, schemas.TABLES[n]).limit(0) for n in extents if n not in rows}
        ledgers = {**none, **rows}
        added = positions.cash_flow(ledgers["transactions"], ledgers["exchanges"], self.settings)
        cells = added.select(*fx.CELL)
        if state is not None and again:
            cells = cells.unionByName(state.select(*fx.CELL)).distinct()
        cells = self.stage.always(cells, "flow_cells")
        if state is not None and not again:
            added = (state.unionByName(added).groupBy("calendar_month", "ticker")
                     .agg(F.sum("units").alias("units"), F.sum("avg_units").alias("avg_units")))
        return self._publish(MONTHLY_FLOWS, added, extents), cells

    def positions(self) -> DataFrame:
        """Positions, summed anew from each ticker's first changed month only.

        Rates and flows are advanced first; the cells that they changed are noted with
        the positions' own coverage, so a run that dies between them starts from all.
        """
        state, covered = self._state(POSITIONS)
        names = ("prices", "transactions", "exchanges")
        before = {n: self._state(s)[1].get(n) for n, s in (
            ("prices", RATES), ("transactions", MONTHLY_FLOWS), ("exchanges", MONTHLY_FLOWS))}
        rates, priced = self.rates()
        flows, moved = self.monthly_flows()
        extents = {n: self._state(s)[1].get(n) for n, s in (
            ("prices", RATES), ("transactions", MONTHLY_FLOWS), ("exchanges", MONTHLY_FLOWS))}
        extents = {n: e if e else self.tables.extent(n) for n, e in extents.items()}
        if state is None or any(covered.get(n) != before[n] for n in names):
            totals = positions.running_totals(rates, flows)
            held = positions.valued_positions(totals, "total")
        elif covered == extents:
            return state.drop("total")
        else:
            changes = self.stage.always(
                priced.unionByName(moved).groupBy("ticker").agg(F.min("calendar_month").alias("from_month")), "changes")
            held = positions.carried_forward(state, changes, rates, flows)
        return self._publish(POSITIONS, held, extents).drop("total")

