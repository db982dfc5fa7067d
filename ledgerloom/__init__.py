"""ledgerloom: multi-currency ledger analytics on Spark DataFrames."""

from ledgerloom.settings import LedgerSettings

__all__ = ["LedgerSettings"]
