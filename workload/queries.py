"""The registered queries: library operators over the derived ledger tables.

Money sums are rounded at the very end, where no engine's summation order can
show; everything else is returned as computed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.values import sanitize
from ledgerloom.operators import (
    fx, ingest, maintenance, mapping, positions, reconcile, reports, trades,
)
from ledgerloom.operators.references import CASCADE, Reference, delete_rows, update_keys
from ledgerloom.plans import run as runs
from ledgerloom.plans.advance import AdvancedTables
from ledgerloom.plans.ledger import Ledger
from ledgerloom.settings import EXPENSES, INCOME, LedgerSettings
from ledgerloom.sources import csv_files
from ledgerloom.sources.snapshots import SnapshotTables
from workload.fixtures import ledger_tables, session_stage, source, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# All trades of the fixtures precede the default cut-off; this one also lets
# them reach the blended estimate.
SETTINGS = LedgerSettings(estimate_cutoff=dt.date(1998, 1, 1), scale=2)


def query(build: Query) -> Query:
    """Register under the function's name (``_`` ends one that an import has taken)."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def rounded(digits: int, *columns: str) -> Callable[[Query], Query]:
    """Round columns of the result; a negative zero becomes zero."""
    def decorate(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            values = {c: F.round(c, digits) for c in columns}
            return build(spark, sf_dir).withColumns(
                {c: F.when(v == 0, F.lit(0.0)).otherwise(v) for c, v in values.items()})
        return run
    return decorate


def ledger(spark: SparkSession, sf_dir: str, *shared: str) -> Ledger:
    return Ledger(ledger_tables(spark, sf_dir), SETTINGS, session_stage(spark), shared)


# --- exchange rates -----------------------------------------------------------

@query
def exchange_rates(spark, sf_dir):
    return fx.exchange_rates(view(spark, sf_dir, "prices"), stage=session_stage(spark))


@query
def fx_grid(spark, sf_dir):
    return fx.rate_grid(view(spark, sf_dir, "prices"))


@query
def fx_conversions(spark, sf_dir):
    return fx.conversions(view(spark, sf_dir, "prices"), stage=session_stage(spark))


@query
def fx_consolidation(spark, sf_dir):
    return fx.consolidation(view(spark, sf_dir, "prices"), stage=session_stage(spark))


# --- mapping, positions, allocation -------------------------------------------

@query
def full_category_mapping(spark, sf_dir):
    return mapping.full_category_mapping(view(spark, sf_dir, "prices"),
                                         view(spark, sf_dir, "category_mapping"))


@query
@rounded(2, "units", "avg_units")
def cash_flow(spark, sf_dir):
    return positions.cash_flow(view(spark, sf_dir, "transactions"),
                               view(spark, sf_dir, "exchanges"))


@query
@rounded(2, "position")
def running_position(spark, sf_dir):
    book = ledger(spark, sf_dir)
    flows = positions.cash_flow(book.tables.transactions, book.tables.exchanges)
    return (positions.running_position(book.exchange_rates, flows)
            .select("ticker", "currency", "calendar_month", "position"))


@query
@rounded(2, "c_value")
def valuation_change(spark, sf_dir):
    return (ledger(spark, sf_dir).positions
            .select("ticker", "currency", "calendar_month", "prev_price", "price", "c_value"))


@query
@rounded(2, "units", "avg_units", "prev_position", "position", "avg_position",
         "c_position", "c_avg_position", "c_value")
def positions_(spark, sf_dir):
    return ledger(spark, sf_dir).positions


@query
@rounded(2, "position", "avg_position")
def allocation(spark, sf_dir):
    return ledger(spark, sf_dir).allocation


# --- trade income and the balance sheet ---------------------------------------

@query
def trade_rate_lookup(spark, sf_dir):
    book = ledger(spark, sf_dir)
    return trades.rate_lookups(book.tables.exchanges, book.exchange_rates, SETTINGS, book.stage)


@query
def trade_price_estimate(spark, sf_dir):
    return (trades.price_estimates(trade_rate_lookup(spark, sf_dir), SETTINGS)
            .select("calendar_date", "ticker", "currency", "units", "original_trade_price",
                    "ex_currency", "c_price", "linear_estimate", "c_linear_estimate",
                    "proportional_estimate", "final_estimate"))


@query
def trade_income(spark, sf_dir):
    return ledger(spark, sf_dir).trade_income


@query
@rounded(2, "expenses")
def converted_expenses(spark, sf_dir):
    book = ledger(spark, sf_dir)
    return reports.converted_expenses(book.tables.transactions, book.exchange_rates)


@query
@rounded(2, "income")
def converted_income(spark, sf_dir):
    book = ledger(spark, sf_dir)
    return reports.converted_income(book.tables.transactions, book.exchange_rates,
                                    book.full_category_mapping, SETTINGS)


@query
@rounded(2, "income")
def valuation_income(spark, sf_dir):
    book = ledger(spark, sf_dir)
    return reports.valuation_income(book.positions, book.full_category_mapping)


@query
@rounded(2, "income")
def trade_income_by_category(spark, sf_dir):
    book = ledger(spark, sf_dir)
    return reports.trade_income_by_category(book.trade_income, book.full_category_mapping)


@query
@rounded(2, "income", "expenses")
def balance_report(spark, sf_dir):
    return ledger(spark, sf_dir, "exchange_rates").balance


@query
def report_csv_roundtrip(spark, sf_dir):
    """The balance sheet, written as a report and read back."""
    report = balance_report(spark, sf_dir)
    path = f"{session_stage(spark).folder}/balance-{uuid.uuid4().hex[:8]}.csv"
    csv_files.write_csv(report, path)
    return csv_files.typed(csv_files.read_text(spark, path), report.schema, day_first=False)


@query
def view_query(spark, sf_dir):
    """Categories of all rates, by SQL over the registered views."""
    ledger(spark, sf_dir, "exchange_rates").register_views("ledger_")
    return spark.sql("""
        select r.ticker, r.currency, r.calendar_month, r.price, m.category, m.subcategory
        from ledger_exchange_rates r left join ledger_full_category_mapping m on m.currency = r.ticker""")


# --- reconciliation -----------------------------------------------------------

@query
def latest_balances(spark, sf_dir):
    return reconcile.latest_balances(view(spark, sf_dir, "balances"))


@query
@rounded(2, "income", "expenses")
def cash_in_out(spark, sf_dir):
    return reconcile.cash_in_out(view(spark, sf_dir, "transactions"))


@query
@rounded(2, "aport", "deport")
def trade_flows(spark, sf_dir):
    return reconcile.trade_flows(view(spark, sf_dir, "exchanges"))


@query
@rounded(2, "transf_in", "transf_out")
def transfer_flows(spark, sf_dir):
    return reconcile.transfer_flows(view(spark, sf_dir, "transfers"))


@query
@rounded(2, "balance", "calculated_balance", "difference", *reconcile.FLOWS)
def reconciliation(spark, sf_dir):
    return ledger(spark, sf_dir).reconciliation


@query
@rounded(2, "balance", "calculated_balance", "difference", *reconcile.FLOWS)
def validation_report(spark, sf_dir):
    return ledger(spark, sf_dir).validation_report


@query
@rounded(2, "amount")
def adjustment_entries(spark, sf_dir):
    return ledger(spark, sf_dir).adjustment_entries


@query
def adjustment_flag(spark, sf_dir):
    return ledger(spark, sf_dir).adjustment_flag


@query
@rounded(2, "balance", "calculated_balance", "difference", *reconcile.FLOWS)
def adjusted_validation(spark, sf_dir):
    """Reconciliation of the ledger after its discrepancies are booked."""
    book = ledger(spark, sf_dir)
    return book.reconciliation_after(ingest.tag_expenses(book.adjustment_entries))


# --- derived tables brought up to date ----------------------------------------

def advanced(spark: SparkSession, sf_dir: str, derived: str) -> AdvancedTables:
    """The ledger loaded in three steps, with a derived table advanced after each of the first two.

    The second step adds movements and prices of all years, so earlier months change.
    """
    tables = SnapshotTables(spark, f"{session_stage(spark).folder}/ledger-{uuid.uuid4().hex[:8]}")
    state = AdvancedTables(tables, session_stage(spark), SETTINGS)
    tables.publish("balances", view(spark, sf_dir, "balances"), ("calendar_date",))
    number = {"prices": F.dayofyear("calendar_date") + F.length("ticker")}
    for step, turns in enumerate(((0, 3), (4, 5), (6, 6))):
        for name in ("transactions", "exchanges", "transfers", "prices"):
            turn = F.pmod(number.get(name, F.col("id")), F.lit(7))
            tables.append(name, view(spark, sf_dir, name).filter(turn.between(*turns)))
        if step < 2:
            getattr(state, derived)()
    return state


@query
def exchange_rates_advanced(spark, sf_dir):
    return advanced(spark, sf_dir, "rates").rates()[0]


@query
@rounded(2, "units", "avg_units", "prev_position", "position", "avg_position",
         "c_position", "c_avg_position", "c_value")
def positions_advanced(spark, sf_dir):
    return advanced(spark, sf_dir, "positions").positions()


@query
@rounded(2, "balance", "calculated_balance", "difference", *reconcile.FLOWS)
def reconciliation_advanced(spark, sf_dir):
    return advanced(spark, sf_dir, "flows").reconciliation()


# --- ingest -------------------------------------------------------------------

def unsigned(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Income or expense movements as their extract holds them: no sign, no type."""
    df = view(spark, sf_dir, "transactions").filter(F.col("transaction_type") == kind)
    return df.withColumn("amount", F.abs("amount")).drop("transaction_type")


def price_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prices with one column per day-first date, missing ones NULL."""
    prices = view(spark, sf_dir, "prices").withColumn(
        "day", dates.format_day_first(F.col("calendar_date")))
    # A report has a column for each month, so their number is that of the months.
    days = [r["day"] for r in prices.select("day").distinct().orderBy("day").collect()]
    return prices.groupBy("ticker", "currency").pivot("day", days).agg(F.max("price"))


@query
def ingest_csv_roundtrip(spark, sf_dir):
    extract = view(spark, sf_dir, "exchanges").drop("id").withColumn(
        "calendar_date", dates.format_day_first(F.col("calendar_date")))
    path = f"{session_stage(spark).folder}/exchange-{uuid.uuid4().hex[:8]}.csv"
    csv_files.write_csv(extract, path)
    return csv_files.read_extract(spark, "exchange", path)


@query
def ingest_csv_mixed_headers(spark, sf_dir):
    """Purchases and sales in one folder, the columns of the sales the other way round."""
    extract = view(spark, sf_dir, "exchanges").drop("id").withColumn(
        "calendar_date", dates.format_day_first(F.col("calendar_date")))
    path = f"{session_stage(spark).folder}/mixed-{uuid.uuid4().hex[:8]}.csv"
    for kind, columns in (("Purchase", extract.columns), ("Sale", extract.columns[::-1])):
        (extract.filter(F.col("exchange_type") == kind).select(*columns)
         .write.mode("append").option("header", True).option("escape", '"').csv(path))
    return csv_files.read_extract(spark, "exchange", path)


@query
def price_unpivot(spark, sf_dir):
    return ingest.unpivot_prices(price_matrix(spark, sf_dir))


@query
def date_parse(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    text = orders.select("o_orderkey", F.date_format("o_orderdate", "d/M/yyyy").alias("text"))
    return text.select("o_orderkey", "text",
                       dates.parse_day_first(F.col("text")).alias("calendar_date"))


@query
def date_format_export(spark, sf_dir):
    orders = source(spark, sf_dir, "orders")
    return orders.select("o_orderkey", dates.format_day_first(
        F.col("o_orderdate").cast("date")).alias("calendar_date"))


@query
def tag_transactions(spark, sf_dir):
    return (ingest.tag_income(unsigned(spark, sf_dir, INCOME))
            .unionByName(ingest.tag_expenses(unsigned(spark, sf_dir, EXPENSES))))


@query
def mapping_dedupe(spark, sf_dir):
    listed = view(spark, sf_dir, "category_mapping")
    return ingest.dedupe_mapping(listed.unionByName(listed))


@query
def sanitize_values(spark, sf_dir):
    parts = source(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") == 1, F.lit("nan"))
        .otherwise(F.concat(F.lit("'"), "p_name", F.lit("' o'"))).alias("p_name"),
        F.when(F.col("p_size") == 2, F.lit(float("nan")))
        .otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return sanitize(parts)


@query
def append_union(spark, sf_dir):
    rows = view(spark, sf_dir, "transactions")
    return ingest.append_rows(rows.filter(F.col("transaction_type") == INCOME),
                              rows.filter(F.col("transaction_type") == EXPENSES))


@query
def reset_transactions(spark, sf_dir):
    """Whatever the table held, it becomes the income and expense extracts."""
    income = ingest.tag_income(unsigned(spark, sf_dir, INCOME))
    expenses = ingest.tag_expenses(unsigned(spark, sf_dir, EXPENSES))
    return ingest.append_rows(income, expenses).drop("id")


@query
def filtered_read(spark, sf_dir):
    flagged = view(spark, sf_dir, "transactions").withColumn("remove", ~F.col("count_to_balance"))
    return ingest.read_filtered(flagged, "USD", drop_removed=True)


@query
def active_currencies(spark, sf_dir):
    return ingest.active_currencies(view(spark, sf_dir, "exchanges"))


@query
@rounded(2, "amount")
def concat_adjustments(spark, sf_dir):
    expenses = unsigned(spark, sf_dir, EXPENSES)
    return ingest.append_rows(expenses, ledger(spark, sf_dir).adjustment_entries)


# --- whole runs ---------------------------------------------------------------

def loaded(spark: SparkSession, sf_dir: str) -> SnapshotTables:
    """The ledger, written as extracts and loaded in order."""
    folder = f"{session_stage(spark).folder}/run-{uuid.uuid4().hex[:8]}"
    day = dates.format_day_first(F.col("calendar_date"))
    extracts = {"exchange": partial(view, spark, sf_dir, "exchanges"), "balances": partial(view, spark, sf_dir, "balances"),
                "prices": partial(price_matrix, spark, sf_dir), "income": partial(unsigned, spark, sf_dir, INCOME),
                "expenses": partial(unsigned, spark, sf_dir, EXPENSES), "transf": partial(view, spark, sf_dir, "transfers")}

    def extract(name: str) -> None:
        rows = extracts[name]()
        if name != "prices":
            rows = rows.drop("id").withColumn("calendar_date", day)
        csv_files.write_csv(rows, f"{folder}/{name}.csv")

    with ThreadPoolExecutor(runs.AHEAD) as pool:
        list(pool.map(extract, extracts))
    tables = SnapshotTables(spark, f"{folder}/tables")
    paths = {name: f"{folder}/{name}.csv" for name in runs.LOAD_ORDER}
    runs.load_all(tables, runs.LedgerFiles(paths, f"{folder}/reports"), session_stage(spark))
    tables.publish("category_mapping", view(spark, sf_dir, "category_mapping"))
    return tables


@query
@rounded(2, "total")
def pipeline_load(spark, sf_dir):
    """What each table holds after a load: rows, and the sum of its amounts."""
    tables, found = loaded(spark, sf_dir), []
    for name, amount in (("transactions", "amount"), ("exchanges", "units"), ("transfers", "amount"),
                         ("balances", "amount"), ("prices", "price")):
        found.append(tables.read(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"),
                                           F.sum(amount).alias("total")))
    return reduce(DataFrame.unionByName, found)


@query
@rounded(2, "balance", "calculated_balance", "difference", *reconcile.FLOWS)
def pipeline_settle(spark, sf_dir):
    """The reconciliation after a load and a settlement that may adjust any difference."""
    tables = loaded(spark, sf_dir)
    settings = LedgerSettings(scale=2, tolerances=((1e12, ("USD",)),), default_tolerance=1e12)
    outcome = runs.settle(tables, settings, session_stage(spark))
    if outcome is not runs.Outcome.ADJUSTED:
        raise RuntimeError(f"settled as {outcome}")
    return AdvancedTables(tables, session_stage(spark), settings).reconciliation()


# --- table maintenance --------------------------------------------------------

@query
@rounded(2, "amount")
def upsert_balances(spark, sf_dir):
    """Recomputed cash balances, one late correction each, merged into the stated ones."""
    cash = (view(spark, sf_dir, "transactions").groupBy("account", "currency")
            .agg(F.sum("amount").alias("amount")))
    corrections = F.inline(F.array(*[
        F.struct(F.lit(day).alias("calendar_date"), F.lit(line).alias("line"),
                 (F.col("amount") + line).alias("amount"))
        for day in (dt.date(2001, 12, 31), dt.date(2002, 12, 31)) for line in (1, 2)]))
    batch = cash.select("account", "currency", corrections)
    return maintenance.upsert(
        view(spark, sf_dir, "balances"), batch.select("account", "calendar_date", "currency",
                                                      "amount", "line"),
        ["account", "calendar_date", "currency"], ["amount"], sequence=["line"],
        stage=session_stage(spark))


@query
@rounded(2, "c_acctbal")
def upsert_from_select(spark, sf_dir):
    """Customers in debt join the table of customers in credit; all balances double."""
    customers = source(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    table = customers.filter(F.col("c_acctbal") >= 0)
    batch = (customers.filter(F.col("c_acctbal") < 5000)
             .withColumns({"c_name": F.upper("c_name"), "c_acctbal": F.col("c_acctbal") * 2}))
    return maintenance.upsert(table, batch, ["c_custkey"], ["c_acctbal"],
                              stage=session_stage(spark))


@query
def delete_where(spark, sf_dir):
    return maintenance.delete_where(source(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F")


@query
def update_where(spark, sf_dir):
    return maintenance.update_where(
        source(spark, sf_dir, "orders"), F.col("o_orderpriority") == "5-LOW",
        {"o_orderpriority": F.lit("LOW"), "o_totalprice": F.lit(0.0)})


@query
def update_cascade(spark, sf_dir):
    """Builders get new keys; accounts of customers in debt follow, and orders on those accounts."""
    customers = source(spark, sf_dir, "customer")
    tables = {"customer": customers, "orders": source(spark, sf_dir, "orders"),
              "accounts": customers.filter(F.col("c_acctbal") < 0).select("c_custkey", "c_acctbal")}
    links = (Reference("accounts", "c_custkey", "customer", "c_custkey"),
             Reference("orders", "o_custkey", "accounts", "c_custkey"))
    changed = update_keys(tables, links, "customer", F.col("c_mktsegment") == "BUILDING",
                          {"c_custkey": F.col("c_custkey") + 1_000_000_000_000}, session_stage(spark))
    return changed["orders"]


@query
def delete_cascade(spark, sf_dir):
    """Customers of one segment go with their orders and the items of these."""
    tables = {name: source(spark, sf_dir, name) for name in ("customer", "orders", "lineitem")}
    links = (Reference("orders", "o_custkey", "customer", "c_custkey", on_delete=CASCADE),
             Reference("lineitem", "l_orderkey", "orders", "o_orderkey", on_delete=CASCADE))
    changed = delete_rows(tables, links, "customer", F.col("c_mktsegment") == "BUILDING",
                          session_stage(spark))
    return changed["lineitem"]


@query
@rounded(2, "amount")
def upsert_dates(spark, sf_dir):
    """The balances after two of their dates were corrected, one cleared and one marked."""
    tables = SnapshotTables(spark, f"{session_stage(spark).folder}/dates-{uuid.uuid4().hex[:8]}")
    balances, day, stage = view(spark, sf_dir, "balances"), F.col("calendar_date"), session_stage(spark)
    tables.publish("balances", balances, ("calendar_date",))
    ends = balances.agg(F.max("calendar_date").alias("last")).first()["last"]
    ends = [ends, ends - dt.timedelta(days=1)]
    batch = reduce(DataFrame.unionByName, [
        balances.filter(day == ends[0]).withColumns({"calendar_date": F.lit(d), "amount": F.col("amount") + 1})
        for d in ends])
    runs.upsert_into(tables, "balances", batch, ["amount"], stage)
    runs.delete_from(tables, "balances", (day == ends[1]) & (F.col("currency") == "USD"), stage)
    runs.update_table(tables, "balances", F.col("amount") < 0, {"amount": F.lit(0.0)}, stage)
    return tables.read("balances", balances.schema)


@query
def surrogate_id(spark, sf_dir):
    """Ids are arbitrary, so what must hold of them is shown instead."""
    stored = session_stage(spark).always(view(spark, sf_dir, "transactions").drop("id"), "numbered")
    return maintenance.assign_ids(stored, stage=session_stage(spark)).agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.sum("id").alias("id_sum"), F.count_distinct("id").alias("n_ids"))


@query
def check_not_null(spark, sf_dir):
    matrix = price_matrix(spark, sf_dir)
    return maintenance.not_null_violations(matrix, matrix.columns)


@query
def check_primary_key(spark, sf_dir):
    return maintenance.primary_key_violations(view(spark, sf_dir, "exchanges"), ["id"])


@query
def check_foreign_key(spark, sf_dir):
    african = source(spark, sf_dir, "nation").join(
        source(spark, sf_dir, "region").filter(F.col("r_name") == "AFRICA"),
        F.col("n_regionkey") == F.col("r_regionkey"), "left_anti")
    return maintenance.foreign_key_violations(
        source(spark, sf_dir, "customer"), "c_nationkey", african, "n_nationkey")


# --- date helpers -------------------------------------------------------------

@query
def date_trunc_units(spark, sf_dir):
    date = F.col("o_orderdate").cast("date")
    return source(spark, sf_dir, "orders").select(
        "o_orderkey", dates.truncate(date, "year").alias("year_start"),
        dates.truncate(date).alias("month_start"))


@query
def calendar_steps(spark, sf_dir):
    date = F.col("o_orderdate").cast("date")
    return source(spark, sf_dir, "orders").select(
        "o_orderkey", dates.next_day(date).alias("next_day"),
        dates.next_month(date).alias("next_month"),
        dates.previous_month(date).alias("previous_month"))
