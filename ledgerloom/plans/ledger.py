"""The six ledger tables and everything derived from them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ledgerloom.operators import fx, mapping, positions, reconcile, reports, trades
from ledgerloom.settings import LedgerSettings
from ledgerloom.sources.scratch import Stage

VIEWS = ("exchange_rates", "full_category_mapping", "positions", "trade_income")


@dataclass(frozen=True)
class LedgerTables:
    transactions: DataFrame
    exchanges: DataFrame
    transfers: DataFrame
    prices: DataFrame
    balances: DataFrame
    category_mapping: DataFrame


class Ledger:
    """Derived frames of a ledger, each built once per instance.

    Lookups (conversion book, rates, rate books) and the frames named in
    ``shared``, those that several actions read, are written once to the stage,
    whatever their size; the rest stays lazy (all of it with the stage ``LAZY``).
    A ledger without a stage makes its own, which ``close`` discards. Within one
    action Spark computes a frame's exchange once however often the plan reads it.
    """

    def __init__(self, tables: LedgerTables, settings: LedgerSettings = LedgerSettings(),
                 stage=None, shared: tuple[str, ...] = ()):
        self.tables = tables
        self.settings = settings
        self.owned = stage is None
        self.stage = Stage(tables.prices.sparkSession) if self.owned else stage
        self.shared = shared

    def close(self) -> None:
        """Delete what an own stage wrote; nothing may read the ledger's frames after."""
        if self.owned:
            self.stage.discard()

    @cached_property
    def exchange_rates(self) -> DataFrame:
        rates = fx.exchange_rates(self.tables.prices, self.settings.targets, self.stage)
        return self.stage.always(rates, "exchange_rates")

    @cached_property
    def full_category_mapping(self) -> DataFrame:
        # Rates hold every priced ticker; once written they are the shorter table.
        priced = (self.exchange_rates if "exchange_rates" in self.shared
                  else self.tables.prices)
        return mapping.full_category_mapping(priced, self.tables.category_mapping)

    @cached_property
    def positions(self) -> DataFrame:
        held = positions.positions(self.tables.transactions, self.tables.exchanges,
                                   self.exchange_rates, self.settings)
        return self.stage.always(held, "positions") if "positions" in self.shared else held

    @cached_property
    def trade_income(self) -> DataFrame:
        return trades.trade_income(self.tables.exchanges, self.exchange_rates,
                                   self.settings, self.stage)

    @cached_property
    def balance(self) -> DataFrame:
        return reports.balance(self.tables.transactions, self.exchange_rates, self.positions,
                               self.trade_income, self.full_category_mapping, self.settings)

    @cached_property
    def allocation(self) -> DataFrame:
        return reports.allocation(self.positions, self.full_category_mapping)

    @cached_property
    def flows(self) -> DataFrame:
        flows = reconcile.ledger_flows(self.tables.transactions, self.tables.exchanges,
                                       self.tables.transfers)
        return self.stage.always(flows, "flows") if "flows" in self.shared else flows

    @cached_property
    def reconciliation(self) -> DataFrame:
        return reconcile.against_flows(self.tables.balances, self.flows, self.settings)

    def reconciliation_after(self, transactions: DataFrame) -> DataFrame:
        """The reconciliation as it would be with further transactions booked."""
        return reconcile.against_flows(
            self.tables.balances, reconcile.add_movements(self.flows, transactions), self.settings)

    @cached_property
    def validation_report(self) -> DataFrame:
        return reconcile.validation_report(self.reconciliation, self.settings)

    @cached_property
    def adjustment_entries(self) -> DataFrame:
        return reconcile.adjustment_entries(self.reconciliation)

    @cached_property
    def adjustment_flag(self) -> DataFrame:
        return reconcile.adjustment_flag(self.reconciliation, self.settings)

    def register_views(self, prefix: str = "") -> None:
        """Make the four derived views available to SQL in this session."""
        for name in VIEWS:
            getattr(self, name).createOrReplaceTempView(prefix + name)
