"""Categories of instruments: rules for bonds, a maintained list for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.values import case
from ledgerloom.settings import INCOME

# --- Fixed values of the bond naming rules, each list in order of precedence --
ISSUERS = (("cdb", "CDB"), ("td", "TD"))
INDEXES = (("cdi", "CDI"), ("prefix", "Prefix"), ("ipca", "IPCA"))
OTHER_INDEX = "SELIC"
PURPOSES = (("b", "B", "Bonds"), ("l", "L", "Savings"))
OTHER_PURPOSE = ("E", "Emergency fund")
# -----------------------------------------------------------------------------


def classify_bonds(tickers: DataFrame) -> DataFrame:
    """Category rows for the tickers whose name marks them as bonds."""
    name = F.lower("ticker")
    issuer = case((name.startswith(p), F.lit(label)) for p, label in ISSUERS)
    index = case(((name.contains(p), F.lit(label)) for p, label in INDEXES), F.lit(OTHER_INDEX))
    purpose = case(((name.endswith(s), F.lit(code)) for s, code, _ in PURPOSES),
                   F.lit(OTHER_PURPOSE[0]))
    category = case(((name.endswith(s), F.lit(label)) for s, _, label in PURPOSES),
                    F.lit(OTHER_PURPOSE[1]))
    return (tickers.select("ticker").filter(issuer.isNotNull()).distinct()
            .select(category.alias("category"),
                    F.concat_ws(" ", issuer, index, purpose).alias("subcategory"),
                    F.col("ticker").alias("currency"),
                    F.lit(INCOME).alias("category_type")))


def full_category_mapping(prices: DataFrame, manual: DataFrame) -> DataFrame:
    """category, subcategory, currency, category_type of classified and listed items.

    Any frame with the priced tickers will do for ``prices``.
    """
    return classify_bonds(prices).unionByName(
        manual.select("category", "subcategory", "currency", "category_type"))
