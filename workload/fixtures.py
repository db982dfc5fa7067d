"""The six ledger tables derived from the driver's tables.

The text of each view is valid for Spark SQL and for DuckDB; ``{name}`` stands
for a table or an earlier view. Spark gets DataFrames in those places, DuckDB
the names of the registered tables and of the CTEs before it.
"""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans.ledger import LedgerTables
from ledgerloom.sources.scratch import Stage

SOURCES = ("nation", "customer", "part", "orders", "lineitem", "events")

# The unpartitioned row_number in ``balances`` runs over one row per account and
# instrument of the fixtures, of which there are some 500 at every scale.
VIEWS = {
    "instruments": """
        select p_partkey,
         case when p_partkey % 40 < 4 then 'CDB ' || case p_partkey % 4 when 0 then 'CDI' when 1 then 'IPCA' when 2 then 'Prefix' else 'X' end || ' ' || cast(p_partkey % 40 as string) || case p_partkey % 3 when 0 then ' B' when 1 then ' L' else '' end
              when p_partkey % 40 < 8 then 'TD ' || case p_partkey % 4 when 0 then 'SELIC' when 1 then 'IPCA' else 'Prefix' end || ' ' || cast(p_partkey % 40 as string) || ' E'
              else 'T' || cast(p_partkey % 40 as string) end as ticker,
         case p_partkey % 40 % 3 when 0 then 'USD' when 1 then 'BRL' else 'EUR' end as quote
        from {part}
    """,
    "prices": """
        select ticker, quote as currency, last_day(cast(l_shipdate as date)) as calendar_date,
         case when min(l_suppkey) = 0 and min(l_quantity) = 1 then 0e0 else round(avg(l_extendedprice / l_quantity), 6) end as price
        from {lineitem} join {instruments} on l_partkey = p_partkey group by 1, 2, 3
        union all select 'USD', 'BRL', last_day(cast(o_orderdate as date)), round(2e0 + avg(o_totalprice) / 250000, 6) from {orders} group by 3
        union all select 'BRL', 'BRL', last_day(cast(o_orderdate as date)), 1e0 from {orders} group by 3
        union all select 'EUR', 'USD', last_day(cast(o_orderdate as date)), round(1e0 + avg(o_totalprice) / 2500000, 6) from {orders} group by 3
        union all select 'EUR', 'BRL', last_day(cast(o_orderdate as date)), round(3e0 + avg(o_totalprice) / 250000, 6) from {orders} group by 3
    """,
    "exchanges": """
        select l_orderkey * 10 + l_linenumber as id, ticker, 'ACC' || cast(l_suppkey % 10 as string) as account,
         cast(l_shipdate as date) as calendar_date, l_extendedprice / l_quantity as price, l_quantity as units,
         l_extendedprice * l_tax as tax, case when l_returnflag = 'R' then 'Sale' else 'Purchase' end as exchange_type,
         case l_suppkey % 4 when 0 then 'USD' when 1 then 'BRL' when 2 then 'EUR' else quote end as currency, quote as tax_currency,
         l_linestatus = 'F' as count_to_balance
        from {lineitem} join {instruments} on l_partkey = p_partkey
    """,
    "transactions": """
        select o_orderkey as id, o_orderpriority as tag,
         case when o_orderstatus = 'P' then -o_totalprice else o_totalprice end as amount,
         'ACC' || cast(o_custkey % 10 as string) as account, cast(o_orderdate as date) as calendar_date,
         case when o_custkey % 50 = 0 then 'Work' else c_mktsegment end as category,
         case when o_custkey % 50 = 0 then 'T' || cast(8 + o_orderkey % 32 as string) when o_custkey % 50 = 1 then 'Rivalry' else n_name end as subcategory,
         case o_custkey % 3 when 0 then 'USD' when 1 then 'BRL' else 'EUR' end as currency,
         o_orderpriority <> '5-LOW' as count_to_balance,
         case when o_orderstatus = 'P' then 'Expenses' else 'Income' end as transaction_type
        from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
    """,
    "transfers": """
        select event_id as id, 'ACC' || cast(user_id % 10 as string) as source_acc, 'ACC' || cast((user_id * 7 + 3) % 10 as string) as destination_acc,
         cast(ts as date) as calendar_date, value as amount, case user_id % 3 when 0 then 'USD' when 1 then 'BRL' else 'EUR' end as currency, true as count_to_balance
        from {events} where event_type = 'purchase'
    """,
    "category_mapping": """
        select distinct case p_partkey % 40 % 5 when 0 then 'Crypto' when 1 then 'Growth stocks' when 2 then 'Cash' when 3 then 'Commodities' else 'Value stocks' end as category,
         'S' || cast(p_partkey % 40 % 7 as string) as subcategory, ticker as currency, 'Income' as category_type from {instruments} where p_partkey % 40 >= 8
        union all select 'Cash', n_name, n_name, 'Income' from {nation} where n_nationkey < 10
        union all select 'Sponsor', 'Rivalry', 'Rivalry', 'Income'
    """,
    "balances": """
        select account, date '2001-12-31' as calendar_date, currency, total + case rn % 4 when 1 then 3e0 when 2 then 0.05e0 when 3 then -100e0 else 0e0 end as amount
        from (select account, currency, round(sum(d), 2) as total, row_number() over (order by account, currency) as rn
         from (select account, currency, amount as d from {transactions}
          union all select account, ticker, case when exchange_type = 'Purchase' then units else -units end from {exchanges}
          union all select account, currency, case when exchange_type = 'Purchase' then -price * units else price * units end from {exchanges}
          union all select destination_acc, currency, amount from {transfers}
          union all select source_acc, currency, -amount from {transfers}) t group by 1, 2) u
        union all select 'ACC' || cast(c_custkey % 10 as string), date '2000-12-31', case c_custkey % 3 when 0 then 'USD' when 1 then 'BRL' else 'EUR' end, round(sum(c_acctbal), 2) from {customer} group by 1, 3
    """,
}

# Small base tables that aggregate the large inputs, which several operators read.
LOADED = ("prices", "balances", "category_mapping")

_known: dict[tuple[str, str, str], DataFrame] = {}
_stages: dict[str, Stage] = {}


def session_stage(spark: SparkSession) -> Stage:
    """The stage of all queries of a session, discarded when the process ends."""
    app = spark.sparkContext.applicationId
    if app not in _stages:
        _stages[app] = Stage(spark)
        atexit.register(_discard, app)
    return _stages[app]


def _discard(app: str) -> None:
    try:
        _stages.pop(app).discard()
    except Exception:  # the session has ended: its folder is the cluster's to clear
        pass


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _known:
        _known[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _known[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view; lazy down to the scans of the driver's tables.

    Only the ``LOADED`` ones are written, once per session, and read back as a
    loaded table would be.
    """
    if name in SOURCES:
        return source(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _known:
        text = VIEWS[name]
        inputs = {n: view(spark, sf_dir, n) for n in (*SOURCES, *VIEWS) if "{" + n + "}" in text}
        df = spark.sql(text, **inputs)
        _known[key] = session_stage(spark).always(df, name) if name in LOADED else df
    return _known[key]


def ledger_tables(spark: SparkSession, sf_dir: str) -> LedgerTables:
    return LedgerTables(*[view(spark, sf_dir, n) for n in (
        "transactions", "exchanges", "transfers", "prices", "balances", "category_mapping")])


def prelude(*names: str) -> str:
    """The CTEs an oracle needs, for use after ``with``."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for n in VIEWS:
            if "{" + n + "}" in VIEWS[name]:
                visit(n)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    plain = {n: n for n in (*SOURCES, *VIEWS)}
    return ",\n".join(f"{n} as ({VIEWS[n].format(**plain)})" for n in needed)
