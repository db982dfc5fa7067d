"""Operators put together: derived views, reports, a whole ledger run."""
