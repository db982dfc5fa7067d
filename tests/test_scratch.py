from __future__ import annotations

from types import SimpleNamespace

import os

import pytest

from ledgerloom.operators import fx, maintenance, trades
from ledgerloom.plans.ledger import Ledger, LedgerTables
from ledgerloom.sources import scratch


class Unset:
    def get(self, key):
        raise KeyError(key)


def session(master):
    return SimpleNamespace(conf=Unset(), sparkContext=SimpleNamespace(
        master=master, applicationId="app-" + master))


def test_the_clusters_folder_is_used(spark):
    assert scratch.shared_folder(spark) == spark.conf.get(scratch.CHECKPOINT_CONF)
    assert scratch.Stage(spark).folder.startswith(scratch.shared_folder(spark))


def test_only_a_local_session_gets_a_temporary_folder():
    local = session("local[2]")
    assert scratch.shared_folder(local) == scratch.shared_folder(local)
    with pytest.raises(ValueError, match=scratch.CHECKPOINT_CONF):
        scratch.shared_folder(session("spark://cluster"))


def test_building_operators_starts_no_job(spark, make):
    """Without a stage an operator is a plan and nothing else."""
    status = spark.sparkContext.statusTracker()
    before = len(status.getJobIdsForGroup(None))
    prices = make.prices(("X", "USD", "2023-01-31", 1), ("USD", "BRL", "2023-01-31", 5))
    rates = fx.exchange_rates(prices)
    trades.trade_income(make.exchanges(), rates)
    maintenance.upsert(prices, prices, ["ticker", "currency", "calendar_date"], ["price"])
    assert len(status.getJobIdsForGroup(None)) == before


def test_a_ledger_discards_its_own_stage(spark, make, tmp_path):
    prices = make.prices(("X", "USD", "2023-01-31", 1))
    tables = LedgerTables(make.transactions(), make.exchanges(), make.transfers(), prices,
                          make.balances(), make.mapping())
    ledger = Ledger(tables)
    assert ledger.exchange_rates.count() == 2
    folder = ledger.stage.folder.removeprefix("file:")
    assert os.path.isdir(folder)
    ledger.close()
    assert not os.path.exists(folder)
