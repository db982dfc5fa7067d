"""Configuration of a ledger run: plain data, no logic."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# --- Fixed values of the data model -----------------------------------------
REPORTING_CURRENCIES = ("USD", "BRL")
FIXED_VALUE_INSTRUMENTS = ("EUR", "USD", "BRL", "USDC", "BUSD", "USDT", "GUSD")
ESTIMATE_CUTOFF = dt.date(2020, 1, 1)
TOLERANCES = (
    (5.0, ("Nubank", "BRL", "USD", "EUR", "USDC", "MATIC", "Rivalry")),
    (0.0001, ("BTC", "ETH", "AVAX", "BNB")),
    (1.0, ("SHIB",)),
)
DEFAULT_TOLERANCE = 0.001
OWN_CATEGORY_SUBCATEGORIES = ("Rivalry",)
INCOME = "Income"
EXPENSES = "Expenses"
PURCHASE = "Purchase"
SALE = "Sale"
FIX_TAG = "Fix"
FIX_CATEGORY = "Taxes"
FIX_SUBCATEGORY = "Buy tax"
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class LedgerSettings:
    """Knobs of the reports and of the reconciliation.

    ``two_sided``: also reject negative differences in the validation report
    and test the tolerance on the absolute difference (default: one-sided).
    ``fix_quote_weight``: give the day-weighted quote leg of a trade the same
    sign as its unweighted amount (default: opposite sign).
    ``scale``: decimals at which balances are compared.
    """

    targets: tuple[str, ...] = REPORTING_CURRENCIES
    fixed_value: tuple[str, ...] = FIXED_VALUE_INSTRUMENTS
    estimate_cutoff: dt.date = ESTIMATE_CUTOFF
    tolerances: tuple[tuple[float, tuple[str, ...]], ...] = TOLERANCES
    default_tolerance: float = DEFAULT_TOLERANCE
    own_category: tuple[str, ...] = OWN_CATEGORY_SUBCATEGORIES
    scale: int = 7
    two_sided: bool = False
    fix_quote_weight: bool = False
