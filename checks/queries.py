"""Registered queries: every operator over the whole star-derived ledger.

Amounts are decimals inside the library; :func:`plain` turns them into doubles at
the very end so results compare with any SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from acreledger import Ledger
from acreledger.functions import expr, text
from acreledger.operators import asof, calendar, entries, keys, reshape, schedule, splits, sums, tour, tree
from acreledger.plans import (
    cash,
    chart,
    closing,
    depreciation,
    invoices,
    loads,
    notes,
    position,
    prices,
    production,
    summary,
    tax,
)
from acreledger.session import cut_lineage, drop_dir, new_work_dir
from acreledger.sources import files, update
from acreledger.sources.ledger import (
    by_text,
    discount_table,
    load_ledger,
    normalise_post_date,
    write_csv,
    write_ledger,
    write_partitioned,
    write_sheets,
)
from acreledger.sources.star import CROP_WORDS, URI_PREFIX, star_ledger
from acreledger.streaming import ingest, windows

YEAR = 1998
YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
PRICE_YEAR = 2024
LEVEL = 3
SHARES = 500.0
PARTS = 4  # of the ledger, one summed after the other
DISCOUNTS = {"Assets": 80, "Liabilities": 100, "Cash": 70, "Grain": 70}
LOAD_LABELS = {"CORN": "ring", "BEANS": "widget"}
LOAD_PREFIX = "LOADS"
DOCUMENT_PREFIX = "SCAN_7_"
ENTERED = "2024-06-01 12:00:00"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, everything else unchanged."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(build: Callable[[Ledger], DataFrame]) -> Callable[[Ledger], DataFrame]:
    """Register a function of a ledger under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(star_ledger(spark, folder)))

    REGISTRY[build.__name__] = run
    return build


def table_query(build: Callable[[SparkSession, str], DataFrame]):
    """Register a function of session and folder under its own name."""
    REGISTRY[build.__name__] = lambda spark, folder: plain(build(spark, folder))
    return build


def stamp(column: str) -> Column:
    """Timestamp as text with microseconds."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def count_rows() -> Column:
    return F.count(F.lit(1)).alias("row_count")


# --- accounts ------------------------------------------------------------------


@query
def account_totals(ledger):
    """A1 S1 J1"""
    return splits.account_totals(ledger)


@query
def account_totals_year(ledger):
    """A1 F1 J9"""
    return splits.account_totals(ledger, YEAR)


@query
def account_paths(ledger):
    """X1"""
    return tree.with_paths(ledger.accounts, LEVEL).select("guid", "name", "parent_accounts")


@query
def account_level(ledger):
    """X2"""
    return tree.with_paths(ledger.accounts, LEVEL).select("guid", "finpack_account")


@query
def account_descriptor(ledger):
    """P9 R1 J3"""
    return tree.all_accounts(ledger, CROP_WORDS, LEVEL, with_notes=True).select("guid", "crop", "account_notes")


@query
def accounts_by_term(ledger):
    """X3"""
    return tree.accounts_matching(tree.with_paths(ledger.accounts, LEVEL), "PROMO|red")


@query
def accounts_below_term(ledger):
    """X3 by intervals: accounts with a term in their name, and all below them"""
    hit = F.col("name").contains("PROMO") | F.col("name").contains("red")
    return tour.accounts_below(ledger.accounts, hit).select("commodity_guid", "guid")


@query
def subtree_totals(ledger):
    """Value booked on each account and all below it, in hundredths"""
    amounts = ledger.splits.select(F.col("account_guid").alias("guid"), "value_num")
    return tour.subtree_totals(ledger.accounts, amounts, "value_num")


@query
def accounts_of_type(ledger):
    """R6 F3"""
    return tree.accounts_of_type(ledger.accounts, chart.CASH_TYPES)


# --- splits and cash -----------------------------------------------------------


@query
def all_transactions(ledger):
    """J1 R15 P1"""
    return splits.all_transactions(ledger).select(
        "split_guid", "tx_guid", "account_name", "account_code", "account_desc", "tx_num", "description",
        F.to_date("post_date").alias("post_date"), "split_action", "memo", "amt", "qty",
    )


@query
def transactions_by_text(ledger):
    """SC3 SC4: splits of a year and a sign as a query text with parameters"""
    text = """SELECT s.guid AS split_guid, a.name AS account_name, s.value_num, to_date(t.post_date) AS post_date
        FROM {splits} s JOIN {accounts} a ON a.guid = s.account_guid JOIN {transactions} t ON t.guid = s.tx_guid
        WHERE t.post_date >= make_timestamp(:year, 1, 1, 0, 0, 0) AND t.post_date < make_timestamp(:year + 1, 1, 1, 0, 0, 0)
        AND s.value_num < :below"""
    tables = ["splits", "accounts", "transactions"]
    return by_text(ledger.splits.sparkSession, ledger, text, tables, year=YEAR, below=0)


@query
def counter_splits(ledger):
    """J2 inverse, summed per source account and type of the other side"""
    rows = [splits.counter_splits(part, chart.CASH_TYPES, pairs=True) for part in splits.in_parts(ledger, PARTS)]
    return sums.exact_totals(rows, ["src_guid", "src_name", "account_type"], splits.AMOUNTS, {"row_count": F.lit(1)})


@query
def counter_splits_direct(ledger):
    """J2 direct"""
    rows = splits.counter_splits(ledger, chart.STOCK_TYPES, inverse=False, pairs=True)
    return sums.exact_totals(rows, ["account_guid", "src_type"], splits.AMOUNTS, {"row_count": F.lit(1)})


@query
def counter_splits_once(ledger):
    """J2 with each split counted once"""
    rows = splits.counter_splits(ledger, chart.CASH_TYPES, distinct_splits=True, pairs=True)
    amounts = {"amt": splits.AMOUNTS["amt"]}
    return sums.exact_totals(rows, ["src_guid", "account_type"], amounts, {"row_count": F.lit(1)})


@query
def counter_flows(ledger):
    """J2 in weighted form"""
    flows = splits.counter_flows(ledger, chart.CASH_TYPES)
    return sums.exact_totals(flows, ["account_guid"], splits.AMOUNTS, {"row_count": F.col("sources")})


@query
def cash_clean(ledger):
    """R16 R7 J6 J7 F4 F11"""
    return cash.cleaned_cash_transactions(ledger, [YEAR], level=LEVEL, crops=CROP_WORDS).select(
        "split_guid", "src_guid", "account_code", "account_type", "finpack_account", "parent_accounts",
        F.to_date("post_date").alias("post_date"), "amt", "quantity",
    )


@query
def reclassified(ledger):
    """R17 P8"""
    return cash.farm_cash_transactions(ledger, [YEAR], level=LEVEL, crops=CROP_WORDS).select(
        "split_guid", "src_guid", "account_code", "account_type", "account_name", "amt", "quantity"
    )


@query
def farm_with_depreciation(ledger):
    """R17 with G2, summed per code and ancestor"""
    rows = depreciation.depreciation_transactions(ledger, YEAR, CROP_WORDS, LEVEL)
    flows = cash.farm_flows(ledger, [YEAR], quantity=True, paths=True, level=LEVEL, crops=CROP_WORDS)
    tx = flows.unionByName(rows, allowMissingColumns=True)
    keys = ["account_code", "finpack_account"]
    counted = tx.groupBy(*keys).agg(F.sum(F.coalesce("sources", F.lit(1))).alias("row_count"))
    # null keys are groups of their own
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = summary.summary(tx, keys).alias("a").join(counted.alias("b"), same)
    return both.select("a.*", "row_count").withColumn("amt", F.round("amt", 2))


# --- summaries -----------------------------------------------------------------


def _with_depreciation(ledger, years):
    rows = depreciation.depreciation_transactions(ledger, years, CROP_WORDS, LEVEL)
    flows = cash.farm_flows(ledger, years)
    return flows.unionByName(rows, allowMissingColumns=True)


@query
def exec_summary(ledger):
    """R12 A9 O2 O3"""
    return summary.executive_summary(cash.farm_flows(ledger, [YEAR]))


@query
def exec_summary_depreciation(ledger):
    """R12 with depreciation"""
    out = summary.executive_summary(_with_depreciation(ledger, [YEAR]), include_depreciation=True)
    return out.withColumn("Amount", F.round("Amount", 2))


@query
def summary_by_account(ledger):
    """R13 P4"""
    return summary.summary_by_account(cash.farm_flows(ledger, [YEAR], quantity=True))


@query
def summary_by_ancestor(ledger):
    """R13 X2"""
    flows = cash.farm_flows(ledger, [YEAR], quantity=True, paths=True, crops=CROP_WORDS, level=LEVEL)
    return summary.summary_by_ancestor(flows)


def _account_report(ledger):
    return lambda years: summary.summary_by_account(cash.farm_flows(ledger, years), by_year=True)


@query
def trend_pivot(ledger):
    """R14 RS1 S16 U5"""
    wide = summary.trend_data(_account_report(ledger), YEARS, ["Code", "Account"], "Amount")
    return wide.withColumnsRenamed({str(y): f"y{y}" for y in YEARS})


@query
def trend_string(ledger):
    """R14 RS4 J17 S17"""
    return summary.with_trend(_account_report(ledger), YEARS, ["Code", "Account"], "Amount")


@query
def exec_trend(ledger):
    """R14 over R12, all years in one pass"""
    report = lambda years: summary.executive_summary(cash.farm_flows(ledger, years), by_year=True)
    return summary.with_icon(summary.with_trend(report, YEARS, ["Account"], "Amount"))


@query
def exec_by_year(ledger):
    """R12 per year"""
    return summary.executive_summary(cash.farm_flows(ledger, YEARS), by_year=True)


@query
def detail_with_totals(ledger):
    """R34 A8 A10 P10"""
    return summary.transaction_details(
        cash.farm_cash_transactions(ledger, [YEAR], quantity=False, paths=False)
    )


# --- positions -----------------------------------------------------------------


@query
def running_position(ledger):
    """W5 W6 R8"""
    return position.running_positions(position.category_positions(ledger))


@table_query
def closing_positions(spark, folder):
    """W5 W6 R10 SK5: closing balances over stored yearly sums; one year's splits are put right, and it is summed again"""
    work = new_work_dir(spark, "closings")
    books, path = f"{work}/books", f"{work}/closings"
    ledger = star_ledger(spark, folder)
    this_year = splits.transaction_heads(ledger, [YEAR]).select("tx_guid", F.lit(1).alias("off"))
    draft = ledger.splits.join(this_year, "tx_guid", "left").withColumn("value_num", F.col("value_num") + F.coalesce("off", F.lit(0)))
    tables = {"accounts": ledger.accounts, "transactions": ledger.transactions, "splits": draft.select(*ledger.splits.columns)}
    write_ledger(Ledger(tables), books, list(tables))
    closing.renew_closings(spark, books, path)
    right = load_ledger(spark, books).splits.where(F.col("post_year") == YEAR).withColumn("value_num", F.col("value_num") - 1)
    update.update_in_place(spark, f"{books}/splits", right, "guid", "post_year")
    renewed = closing.renew_closings(spark, books, path)
    if renewed != [YEAR]:
        raise ValueError(f"sums renewed for {renewed}")
    result = cut_lineage(position.running_positions(closing.stored_positions(spark, path)), free=True)
    drop_dir(spark, work)
    return result


@query
def balance_details(ledger):
    """R8 R10 U-2: detail rows of all categories, summed per account"""
    return position.balance_totals(ledger, YEAR).withColumnsRenamed({"category": "balance_sheet_category", "rows": "row_count"})


@query
def balance_sheet(ledger):
    """R10"""
    return position.balance_sheet(ledger, YEAR, PRICE_YEAR)


@query
def share_value(ledger):
    """R11 SC8 A8"""
    sheet = position.balance_sheet(ledger, YEAR, PRICE_YEAR)
    discounts = discount_table(sheet.sparkSession, DISCOUNTS)
    return position.share_values(sheet, discounts, SHARES).withColumn("share_val", F.round("share_val", 6))


@query
def identity_check(ledger):
    """R26 A6"""
    return position.identity_check(ledger, YEAR)


@query
def cash_by_source(ledger):
    """SK2 table of R26"""
    return position.cash_by_source(ledger, YEAR)


@query
def stock_value(ledger):
    """R9 J8 P7"""
    return position.stock_values(ledger, through=YEAR, price_year=PRICE_YEAR)


@query
def stock_value_detail(ledger):
    """R9 per account name, description and commodity"""
    return position.stock_values(
        ledger, ["account_name", "account_desc", "commodity_guid"], price_year=PRICE_YEAR
    )


# --- prices --------------------------------------------------------------------


@query
def price_list(ledger):
    """R2 J16"""
    return prices.commodity_prices(ledger, PRICE_YEAR).select(
        F.col("guid"), "commodity_guid", "fullname", stamp("date"), "type", "value_num", "value_denom"
    )


@query
def price_series(ledger):
    """R35 A3 None"""
    return prices.commodity_bids(ledger, None, PRICE_YEAR).select("crop", stamp("date"), "cash")


@query
def price_mean(ledger):
    """R4 A3"""
    return prices.commodity_bids(ledger, "mean", PRICE_YEAR).withColumn("cash", F.round("cash", 6))


@query
def price_last(ledger):
    """R4 W4"""
    return prices.commodity_bids(ledger, "last", PRICE_YEAR)


@query
def price_nearest(ledger):
    """Every ask with its nearest bid"""
    asks = ledger.prices.where(F.col("type") == "ask").select("guid", "commodity_guid", "date")
    return prices.nearest_bids(ledger, asks).select("guid", "commodity_guid", stamp("near_time"), "near_cash")


@query
def price_nearest_one(ledger):
    """R3 J14"""
    return prices.nearest_commodity_bid(ledger, "click", "2024-01-15 12:00:00").select(stamp("near_time"), "cash")


@query
def price_named(ledger):
    """R36"""
    return prices.bids_of_commodities(ledger, ["ring", "gear"]).select("guid", "fullname", "value_num")


# --- invoices ------------------------------------------------------------------


@query
def invoice_lines(ledger):
    """U-1 R18 J4 P5"""
    return invoices.invoice_lines(ledger, YEAR).select(
        "inv_type", "inv_guid", "inv_id", F.to_date("date_posted").alias("date_posted"), "tx_guid", "post_lot",
        "operation_id", "operation", "org_name", "org_notes", "account_guid", "account_code", "account_name",
        "entry_guid", "description", "quantity", "price", "amt", "quantity_type", "paytype", "disc_how",
        "disc_type", "disc_amt", F.to_date("due_date").alias("due_date"), "linked_document",
    )


@query
def slot_lookup(ledger):
    """J3"""
    return invoices.invoice_heads(ledger, YEAR).select(
        "inv_guid", "inv_type", F.to_date("due_date").alias("due_date"), "linked_document"
    )


@query
def invoice_quantities(ledger):
    """J7 right side"""
    return invoices.invoice_quantities(ledger)


@query
def lot_payments(ledger):
    """payments per lot"""
    return invoices.payments(ledger.splits)


@query
def contract_status(ledger):
    """R25 J12 F13"""
    out = invoices.contract_status(ledger, YEAR, CROP_WORDS)
    return out.withColumns({c: F.to_date(c) for c in ("Contract Date", "Delivery Start", "Delivery End")})


@query
def open_contracts(ledger):
    """R30 F15"""
    return invoices.open_bushels(invoices.contract_status(ledger, YEAR, CROP_WORDS))


@query
def sibling_discounts(ledger):
    """J12"""
    lines = (
        invoices.invoice_lines(ledger)
        .where(F.col("inv_type") == "INVOICE")
        .withColumn("amount", F.col("amt") - F.col("disc_amt"))
        .withColumn("in_year", expr.in_year("date_posted", YEAR))
    )
    return invoices.sibling_discounts(lines)


@query
def capital_documents(ledger):
    """R31 F9 S18"""
    return invoices.capital_documents(ledger, URI_PREFIX, YEAR, "133")


# --- tax -----------------------------------------------------------------------


@query
def vendor_1099(ledger):
    """R19 F5"""
    return tax.vendor_1099(ledger, YEAR, CROP_WORDS, LEVEL)


@query
def vendor_1099_lines(ledger):
    """R19 J4"""
    return tax.vendor_1099_lines(ledger, YEAR)


@query
def deductible_expense(ledger):
    """R20 F12 S11"""
    return tax.deductible_expenses(ledger, YEAR)


@query
def interest_by_payee(ledger):
    """R21"""
    return tax.interest_payments(ledger, YEAR, "%rEd%")["Totals"]


@query
def interest_detail(ledger):
    """R21 detail"""
    return tax.interest_payments(ledger, YEAR, "%rEd%")["Detail"]


@query
def pattern_join(ledger):
    """J5 R22"""
    return tax.wage_transactions(ledger, YEAR)


@query
def wages_monthly(ledger):
    """R22"""
    return tax.wages_monthly(tax.wage_transactions(ledger, YEAR))


@query
def wages_totals(ledger):
    """R22"""
    return tax.wages_totals(tax.wage_transactions(ledger, YEAR))


@query
def labor_deposits(ledger):
    """R22 A2"""
    return tax.labor_deposits(ledger, YEAR, "146")


# --- depreciation --------------------------------------------------------------


@query
def depreciation_rows(ledger):
    """U1 G1 RS5 S9"""
    assets = depreciation.depreciable_assets(ledger, CROP_WORDS, LEVEL)
    return schedule.depreciation_rows(assets.drop("description")).select(
        "guid", "row_number", "post_date", F.round("amt", 6).alias("amt"), "description", "depreciation_code"
    )


@query
def depreciation_year(ledger):
    """G2 R5"""
    return depreciation.depreciation_transactions(ledger, YEAR, CROP_WORDS, LEVEL).select(
        "account_code", "account_type", "src_guid", "src_name", "finpack_account",
        F.to_date("post_date").alias("post_date"), F.round("amt", 6).alias("amt"), "quantity",
    )


# --- production ----------------------------------------------------------------


@query
def rented_acres(ledger):
    """R23"""
    return production.rented_acres(ledger, YEAR, CROP_WORDS)


@query
def planted_acres(ledger):
    """R23"""
    return production.planted_acres(production.rented_acres(ledger, YEAR, CROP_WORDS), True)


@query
def rent_and_yield(ledger):
    """R23 J8"""
    return production.production(ledger, YEAR, True, CROP_WORDS)


@query
def melt_terms(ledger):
    """U1 RS3"""
    return production.lease_terms(invoices.invoice_lines(ledger, YEAR), CROP_WORDS)


@query
def flex_lease(ledger):
    """R24 J11 S5"""
    return production.flexible_lease(ledger, YEAR, PRICE_YEAR, CROP_WORDS)


@query
def progress(ledger):
    """R28 RS2 P13"""
    return production.harvest_progress(ledger, crops=CROP_WORDS).withColumn("pct", F.round("pct", 6)).withColumn(
        "progress", F.round("progress", 6)
    ).drop("bar_width")


@query
def latest_posting(ledger):
    """A4"""
    return production.latest_by_account(ledger).withColumn("post_date", F.to_date("post_date"))


@query
def last_delivery(ledger):
    """A4"""
    out = production.last_delivery(production.latest_by_account(ledger))
    return out.select(F.to_date("last_delivery").alias("last_delivery"))


@query
def multi_agg(ledger):
    """A5 F4"""
    return production.machine_yield(ledger.machine, ["Customer#000000001"]).withColumn(
        "Date", F.to_date("Date")
    )


@query
def production_vs_machine(ledger):
    """R29 J15"""
    machine = production.machine_yield(ledger.machine)
    grown = production.production(ledger, YEAR, True, CROP_WORDS)
    return production.production_vs_machine(machine, grown).withColumns(
        {
            "Date": F.to_date("Date"),
            "Bu/Acres Worked": F.round("`Bu/Acres Worked`", 6),
            "Bu/Total Acres": F.round("`Bu/Total Acres`", 6),
        }
    )


# --- notes and calendar --------------------------------------------------------


@query
def note_rows(ledger):
    """SC4 S8 F6"""
    picked = F.col("title").ilike("push-ups%") & ~F.col("body").ilike("50")
    return notes.note_rows(ledger.notes, picked).select("note_id", "title", "body", stamp("created_date"))


@query
def daily_sum(ledger):
    """W1 S20"""
    return notes.counter(ledger.notes, "push-ups%")


@query
def weekly_sum(ledger):
    """W2"""
    return notes.counter(ledger.notes, "pull-ups%", "week")


@query
def weekly_mean(ledger):
    """Weekly mean of daily sums"""
    return calendar.resample(notes.counter(ledger.notes, "push-ups%"), "bucket", "body", "week", "mean").select(
        F.col("bucket"), F.round("body", 6).alias("body")
    )


@query
def monthly_mean(ledger):
    """W3 F14"""
    late = F.col("created_date") > F.lit("2024-01-02").cast("timestamp")
    return notes.counter(ledger.notes, "weigh-in%", "month", "mean", "double", where=late).withColumn(
        "body", F.round("body", 6)
    )


@query
def daily_orders(ledger):
    """W1 on postings: splits per day and type of action, every group with its own calendar"""
    heads = splits.transaction_heads(ledger).select("tx_guid", "post_date")
    known = ledger.accounts.select(F.col("guid").alias("account_guid"))
    rows = ledger.splits.select("tx_guid", "account_guid", F.col("action").alias("split_action"), *splits.AMOUNTS["amt"])
    credit = rows.where(expr.is_positive("value_num", "value_denom")).join(heads, "tx_guid").join(known, "account_guid", "left_semi")
    return calendar.resample(credit, "post_date", "amt", "day", "sum", ["split_action"], pair=splits.AMOUNTS["amt"])


@query
def daily_stats(ledger):
    """A7"""
    out = calendar.summary_statistics(notes.counter(ledger.notes, "push-ups%"), "body")
    return out.withColumn("mean", F.round("mean", 6)).withColumnsRenamed(
        {c: f"{c}_value" for c in ("count", "mean", "min", "max", "median", "sum")}
    )


# --- loads ---------------------------------------------------------------------


def _bids(ledger):
    return prices.commodity_bids(ledger, "mean", PRICE_YEAR)


def _posting(ledger):
    accounts = ledger.accounts.withColumn("parent_accounts", F.col("description"))
    return loads.posting_accounts(accounts)


@query
def posting_accounts(ledger):
    """Account to post from and to per commodity"""
    return _posting(ledger)


@query
def load_tickets(ledger):
    """R32 P11 A1"""
    return loads.tickets(ledger.loads, LOAD_LABELS).withColumn("post_date", F.to_date("post_date"))


def _priced(ledger, existing=None, now=None):
    rows = loads.load_transactions(
        ledger.loads, _bids(ledger), _posting(ledger), existing, "Farmers Coop", LOAD_LABELS, now
    )
    return rows.where(F.col("cash").isNotNull() & F.col("from_guid").isNotNull() & F.col("to_guid").isNotNull())


@query
def double_entry(ledger):
    """G3 S3 S14"""
    return loads.load_records(_priced(ledger), ledger.notes, URI_PREFIX).splits.select(
        "account_guid", "action", "value_num", "quantity_num", "value_denom", "memo", "reconcile_state"
    )


@query
def entered_loads(ledger):
    """Transactions of loads with the time of entry, here that of a stopped clock"""
    records = loads.load_records(_priced(ledger, now=F.lit(ENTERED).cast("timestamp")), ledger.notes, URI_PREFIX)
    return records.transactions.select("num", "description", stamp("enter_date"))


@query
def link_slots(ledger):
    """Document links for transactions titled after their ticket"""
    titled = ledger.notes.select(
        "id", F.concat(F.lit("Scale Ticket "), F.substring("id", 2, 20)).alias("title")
    )
    return entries.link_slots(ledger.transactions, titled, URI_PREFIX).select("obj_guid", "name", "slot_type", "string_val")


@query
def anti_existing(ledger):
    """Tickets not among the transactions of one year"""
    known = ledger.transactions.where(expr.in_year("post_date", YEAR))
    rows = loads.tickets(ledger.loads, LOAD_LABELS)
    return keys.not_yet_entered(rows, known, "num").select("num", "crop", "net_units")


@query
def semi_existing(ledger):
    """J9 SC9: transactions of tickets with a corn load"""
    corn = loads.tickets(ledger.loads, LOAD_LABELS).where(F.col("crop") == "ring")
    return keys.existing_records(ledger.transactions, corn, "num").select("num", "guid", "description")


@query
def ticket_notes(ledger):
    """Notes by ticket number"""
    titled = ledger.notes.select(
        "id", F.concat(F.lit("Scale Ticket "), F.substring("id", 2, 20)).alias("title")
    )
    return notes.ticket_notes(titled, ledger.transactions)


# --- text ----------------------------------------------------------------------


def statement_shops() -> list[str]:
    """One entry per rewrite step: the text that the step looks for, with what it needs around it."""
    plain = [step.find for step in text.STATEMENT_REWRITES if not step.regex]
    starred = [step.find.split("<=")[1].split(r"\*")[0] + "*A1,Shopping," for step in text.STATEMENT_REWRITES if step.regex]
    return [x if x.endswith(",") else f"{x},Shopping," for x in [*starred, *plain]]


def statement_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Card statement lines made from orders, and every document text as a line."""
    shops = statement_shops()
    shop = F.element_at(F.array(*[F.lit(s) for s in shops]), (F.col("o_orderkey") % len(shops) + 1).cast("int"))
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("line_id"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(","), shop, F.lit("Sale")).alias("line"),
    )
    documents = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("line_id"), F.col("text").alias("line")
    )
    return orders.unionByName(documents)


@table_query
def scrub_text(spark, folder):
    """R27 S13 SC7"""
    return text.scrub_statement(statement_lines(spark, folder)).select("line_id", F.md5("line").alias("line_md5"))


@table_query
def statement_file(spark, folder):
    """SC7: statement lines of orders written as a text file and read back"""
    work = new_work_dir(spark, "statement")
    lines = statement_lines(spark, folder).where(F.col("line_id").startswith("o"))
    lines.select("line").write.text(f"{work}/lines")
    read = files.read_statement_lines(spark, f"{work}/lines")
    result = cut_lineage(text.scrub_statement(read).select(F.md5("line").alias("line_md5")))
    drop_dir(spark, work)
    return result


@table_query
def sink_csv(spark, folder):
    """SK1 SK2: cash by source written as CSV and read back"""
    work = new_work_dir(spark, "csv")
    table = plain(position.cash_by_source(star_ledger(spark, folder), YEAR))
    write_csv(table, f"{work}/cash")
    read = spark.read.schema(table.schema).option("header", True).option("emptyValue", "").option("nullValue", None)
    result = cut_lineage(read.csv(f"{work}/cash"))
    drop_dir(spark, work)
    return result


@table_query
def sink_sheets(spark, folder):
    """SK4: the sheets of the interest report, one folder each, both read back"""
    work = new_work_dir(spark, "sheets")
    sheets = tax.interest_payments(star_ledger(spark, folder), YEAR, "%rEd%")
    write_sheets(sheets, work)
    read = [spark.read.parquet(f"{work}/{name}").withColumn("sheet", F.lit(name)) for name in sheets]
    result = cut_lineage(read[0].unionByName(read[1], allowMissingColumns=True))
    drop_dir(spark, work)
    return result


@table_query
def written_ledger(spark, folder):
    """SC1 F1 S7: a ledger written in year folders and read with its declared types, one year of it"""
    work = new_work_dir(spark, "books")
    write_ledger(star_ledger(spark, folder), work, ["accounts", "transactions", "splits"])
    result = cut_lineage(splits.account_totals(load_ledger(spark, work), YEAR))
    drop_dir(spark, work)
    return result


@table_query
def sink_by_crop(spark, folder):
    """SK4: production with one folder per crop"""
    work = new_work_dir(spark, "crops")
    grown = REGISTRY["rent_and_yield"](spark, folder)
    write_partitioned(grown, f"{work}/out", "crop")
    result = cut_lineage(spark.read.schema(grown.schema).parquet(f"{work}/out").select(*grown.columns))
    drop_dir(spark, work)
    return result


@table_query
def machine_file(spark, folder):
    """SC6: machine data written as CSV and read back"""
    work = new_work_dir(spark, "machine")
    write_csv(star_ledger(spark, folder).machine, f"{work}/machine")
    machine = production.machine_yield(files.read_machine_yield(spark, f"{work}/machine"))
    result = cut_lineage(machine.withColumn("Date", F.to_date("Date")))
    drop_dir(spark, work)
    return result


@table_query
def second_ledger(spark, folder):
    """SC2: two book sets in one report; the second holds the transactions with numbers ending in 7"""
    business = star_ledger(spark, folder)
    own = business.transactions.where(F.col("num").endswith("7"))
    tables = {
        "accounts": business.accounts,
        "transactions": own,
        "splits": business.splits.join(own.select(F.col("guid").alias("tx_guid")), "tx_guid", "left_semi"),
    }
    books = {"business": business, "personal": Ledger(tables)}
    named = [splits.account_totals(b).select(F.lit(n).alias("books"), "*") for n, b in books.items()]
    return named[0].unionByName(named[1])


@query
def detail_ordered(ledger):
    """O1: transaction details in report order"""
    return summary.transaction_details(
        cash.farm_cash_transactions(ledger, [YEAR], quantity=False, paths=False), ordered=True
    )


@table_query
def document_tickets(spark, folder):
    """ST6 S12: ticket number and title from document file names"""
    prefix = DOCUMENT_PREFIX
    paths = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.concat(
            F.lit("/in/box/"), F.lit(prefix), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".pdf")
        ).alias("path")
    )
    return windows.document_tickets(paths, prefix)


@query
def post_date_text(ledger):
    """SK5 S7"""
    raw = ledger.transactions.select(
        "guid",
        F.when(F.col("num").endswith("7"), F.lit("not a date"))
        .otherwise(F.date_format("post_date", "yyyy-MM-dd"))
        .alias("post_date"),
    )
    return normalise_post_date(raw)


@table_query
def post_date_update(spark, folder):
    """SK5 S7: text dates of one year made canonical in a written table, in place; other years are left as they are"""
    work = new_work_dir(spark, "dates")
    day = F.date_format("post_date", "yyyy-MM-dd")
    sloppy = F.when(F.col("num").endswith("7"), F.lit("not a date")).otherwise(day)
    dated = star_ledger(spark, folder).transactions.withColumn("post_year", F.year("post_date"))
    text = F.when(F.col("post_year") == YEAR, sloppy).otherwise(F.concat(day, F.lit(" 00:00:00")))
    update.overwrite_folders(dated.select("guid", text.alias("post_date"), "post_year"), f"{work}/tx", "post_year")
    before = spark.read.parquet(f"{work}/tx")
    fixed = normalise_post_date(before.where(F.col("post_year") == YEAR))
    update.update_in_place(spark, f"{work}/tx", fixed, "guid", "post_year")
    result = cut_lineage(spark.read.parquet(f"{work}/tx"))
    drop_dir(spark, work)
    return result


@query
def nearest_moments(ledger):
    """J13 on postings: nearest posting of the same customer type for each shipment"""
    accounts = ledger.accounts.where(F.col("guid").startswith("c")).select(
        F.col("guid").alias("account_guid"), "account_type"
    )
    tx = ledger.transactions.select(F.col("guid").alias("tx_guid"), "post_date", F.col("num").alias("tie"))
    # on the transaction first, where the splits lie already; guids go through the shuffles as bytes
    legs = ledger.splits.withColumn("guid", expr.packed("guid")).join(tx, "tx_guid").join(accounts, "account_guid")
    points = legs.groupBy("account_type", F.col("post_date").alias("at")).agg(
        F.max("value_num").alias("largest"), F.min("tie").alias("tie")
    )
    facts = legs.select("guid", "account_type", F.col("reconcile_date").alias("at"))
    return asof.nearest(facts, points, "account_type", "at", "largest", "tie").select(expr.unpacked("guid").alias("guid"), F.to_date("near_time").alias("near_time"), "near_largest")


# --- streams -------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    source = spark.read.parquet(f"{folder}/events.parquet").schema
    stream = (
        spark.readStream.schema(source).option("pathGlobFilter", "events.parquet").parquet(folder)
    )
    return stream.select(
        F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("bigint").alias("cents")
    )


def _stream_totals(spark: SparkSession, folder: str, unit: str) -> DataFrame:
    work = new_work_dir(spark, f"totals-{unit}")
    totals = windows.windowed_totals(_event_stream(spark, folder), "ts", "cents", unit)
    windows.start_totals(totals, f"{work}/out", f"{work}/checkpoint", available_now=True).awaitTermination()
    result = cut_lineage(windows.read_totals(spark, f"{work}/out"))
    drop_dir(spark, work)
    return result


@table_query
def stream_daily(spark, folder):
    """ST7"""
    return _stream_totals(spark, folder, "day")


@table_query
def stream_weekly(spark, folder):
    """ST7"""
    return _stream_totals(spark, folder, "week")


@table_query
def stream_ingest(spark, folder):
    """ST1-ST5 R32 SC5 SC10 SK3: load files written from line items, ingested as a stream

    Once while the books are locked, which must write nothing, then with the lock gone.  At last all files
    come again to a stream that has lost its state: the key index knows their tickets.
    """
    ledger = star_ledger(spark, folder)
    work = new_work_dir(spark, "ingest")
    load_time = lambda c: F.date_format(c, files.LOAD_TIME_FORMAT)
    drop = ledger.loads.select(
        F.col("ticket_number").alias(" Ticket Number"),
        load_time("tare_time").alias(" Tare Time Stamp"),
        load_time("gross_time").alias(" Gross Time Stamp"),
        F.col("crop_description").alias(" Crop Description"),
        F.col("net_units").alias(" Net Units"),
    )
    drop.repartition(F.col("` Ticket Number`")).write.option("header", True).csv(f"{work}/{LOAD_PREFIX}-drop")
    target = ingest.IngestTarget(f"{work}/ledger")
    held = spark.createDataFrame([("books", 1)], "hostname string, pid bigint")

    def run(checkpoint: str, locks: DataFrame) -> None:
        stream = files.stream_load_files(spark, f"{work}/{LOAD_PREFIX}-drop", prefix="part-")
        ingest.start_ingest(
            stream, target, f"{work}/{checkpoint}", _bids(ledger), _posting(ledger), ledger.notes,
            "Farmers Coop", URI_PREFIX, LOAD_LABELS, available_now=True, locks=lambda: locks,
        ).awaitTermination()

    try:
        run("checkpoint", held)
    except StreamingQueryException as refused:
        if "locked" not in str(refused):
            raise
    if not target.read(spark, "splits").isEmpty():
        raise AssertionError("locked books were written")
    run("checkpoint", held.limit(0))
    run("state-lost", held.limit(0))  # every file once more, without the state that knew them
    result = cut_lineage(target.read(spark, "splits").select("account_guid", "action", "value_num", "quantity_num"))
    drop_dir(spark, work)
    return result


@table_query
def reshape_total(spark, folder):
    """Price list per commodity with a Total row"""
    ledger = star_ledger(spark, folder)
    per = ledger.prices.groupBy("commodity_guid").agg(F.sum("value_num").alias("value_num"), count_rows())
    return reshape.with_total_row(per, "Total", "commodity_guid", ["value_num", "row_count"])
