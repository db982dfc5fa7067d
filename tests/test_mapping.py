import pytest

from ledgerloom.operators import mapping


@pytest.mark.parametrize("ticker, category, subcategory", [
    ("CDB CDI 1 B", "Bonds", "CDB CDI B"),
    ("cdb Prefix l", "Savings", "CDB Prefix L"),
    ("TD IPCA 2 E", "Emergency fund", "TD IPCA E"),
    ("TD 2030", "Emergency fund", "TD SELIC E"),
    ("CDB prefix cdi B", "Bonds", "CDB CDI B"),
])
def test_bond_rules(make, ticker, category, subcategory):
    prices = make.prices((ticker, "BRL", "2023-01-31", 1), (ticker, "USD", "2023-02-28", 1),
                         ("ATD", "BRL", "2023-01-31", 1))
    found = mapping.full_category_mapping(prices, make.mapping()).collect()
    assert [tuple(r) for r in found] == [(category, subcategory, ticker, "Income")]


def test_listed_rows_are_kept_with_their_duplicates(make):
    listed = make.mapping(("Crypto", "S", "BTC"), ("Crypto", "S", "BTC"))
    assert mapping.full_category_mapping(make.prices(), listed).count() == 2
