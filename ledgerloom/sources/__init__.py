"""Files and tables the ledger is read from and written to."""
