import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from acreledger.operators import splits
from acreledger.plans import cash, chart, position, summary

from .conftest import values

DAY = dt.datetime(2020, 5, 1)


def acc(guid, kind, code=""):
    return {"guid": guid, "name": guid.upper(), "account_type": kind, "code": code, "parent_guid": None}


ACCOUNTS = [acc("bank", "BANK", "100"), acc("cash", "CASH", "101"), acc("ap", "PAYABLE"), acc("ar", "RECEIVABLE"),
            acc("fuel", "EXPENSE", "500"), acc("seed", "EXPENSE", "510"), acc("corn", "ASSET", "133a"),
            acc("prepaid", "ASSET", "146"), acc("home", "EXPENSE", "910"), acc("harvest", "INCOME", "301c"),
            acc("stock", "STOCK"), acc("land", "ASSET", "150")]


def split(n, tx, account, cents, action="", denom=100):
    return {"guid": f"s{n}", "tx_guid": tx, "account_guid": account, "action": action, "value_num": cents,
            "value_denom": denom, "quantity_num": cents, "quantity_denom": 100}


def tx(guid, when=DAY):
    return {"guid": guid, "num": guid, "post_date": when, "enter_date": when, "description": guid}


SPLITS = [
    split(1, "two", "bank", -1000), split(2, "two", "fuel", 1000),
    split(3, "three", "bank", -300), split(4, "three", "cash", -200), split(5, "three", "seed", 500),
    split(6, "four", "bank", -100), split(7, "four", "bank", -100), split(8, "four", "fuel", 150), split(9, "four", "corn", 50),
    split(10, "move", "bank", -700), split(11, "move", "cash", 700),
    split(12, "pay", "bank", -90, "Payment"), split(13, "pay", "ap", 90, "Payment"),
    split(14, "zero", "bank", -5, denom=0), split(15, "zero", "fuel", 5, denom=0),
    split(16, "paid", "bank", -60), split(17, "paid", "seed", 60, "Payment"),
    split(18, "inc", "bank", 40), split(19, "inc", "harvest", -40),
    split(20, "own", "bank", -80), split(21, "own", "home", 30), split(22, "own", "prepaid", 50),
]
TX = [tx(t) for t in ("two", "three", "four", "move", "pay", "zero", "paid", "inc", "own")]


@pytest.fixture
def ledger(ledger_of):
    return ledger_of(accounts=ACCOUNTS, splits=SPLITS, transactions=TX)


def brute(split_rows, types, inverse):
    """The per-account loop the set form replaces."""
    by_tx = defaultdict(set)
    for s in split_rows:
        by_tx[s["tx_guid"]].add(s["account_guid"])
    out = []
    for guid in [a["guid"] for a in ACCOUNTS if a["account_type"] in types]:
        for s in split_rows:
            touched = by_tx[s["tx_guid"]]
            if inverse and guid in touched and s["account_guid"] != guid:
                out.append((s["guid"], guid))
            if not inverse and s["account_guid"] == guid:
                out += [(s["guid"], other) for other in touched if other != guid]
    return sorted(out)


@pytest.mark.parametrize("inverse", [True, False])
@pytest.mark.parametrize("types", [chart.CASH_TYPES, ["EXPENSE"], ["BANK"]])
def test_counter_splits_equal_loop(ledger, types, inverse):
    got = values(splits.counter_splits(ledger, types, inverse), "split_guid", "src_guid")
    assert got == brute(SPLITS, types, inverse)


def test_signs_and_zero_denominator(ledger):
    got = {r["split_guid"]: r for r in splits.counter_splits(ledger, ["BANK"]).collect()}
    assert float(got["s2"]["amt"]) == -10.0
    assert got["s15"]["amt"] is None


def test_distinct_splits_once(ledger):
    rows = splits.counter_splits(ledger, chart.CASH_TYPES, distinct_splits=True).collect()
    pairs = dict(sorted(brute(SPLITS, chart.CASH_TYPES, True), reverse=True))
    assert {r["split_guid"]: r["src_guid"] for r in rows} == pairs and len(rows) == len(pairs)


def random_ledger(ledger_of, hot):
    rng = random.Random(7)
    rows, heads = [], []
    for t in range(40):
        heads.append(tx(f"t{t}", dt.datetime(2018 + t % 4, 3, 1 + t % 28)))
        legs = 60 if t == 0 and hot else rng.randint(2, 5)
        for _ in range(legs):
            rows.append(split(len(rows), f"t{t}", rng.choice(ACCOUNTS)["guid"], rng.randint(-9999, 9999),
                              rng.choice(["", "Payment", "Bill"])))
    return ledger_of(accounts=ACCOUNTS, splits=rows, transactions=heads), rows


@pytest.mark.parametrize("hot", [False, True])
def test_weighted_flows_equal_joined_rows(ledger_of, hot):
    ledger, _ = random_ledger(ledger_of, hot)
    joined = cash.farm_cash_transactions(ledger, quantity=False, paths=False)
    flows = cash.farm_flows(ledger)
    keys = ["account_code", "account_type"]
    left = values(summary.summary(joined, keys), *keys, "amt")
    assert left == values(summary.summary(flows, keys), *keys, "amt") and left


def test_positions_equal_details(ledger_of):
    ledger, _ = random_ledger(ledger_of, True)
    details = position.balance_sheet_details(ledger, 2020, quantity=False, paths=False)
    sums = details.groupBy("balance_sheet_category").agg(F.sum("amt").alias("amt"), F.sum("qty").alias("qty"))
    want = values(sums, "balance_sheet_category", "amt", "qty")
    sheet = position.balance_sheet(ledger, 2020).where("balance_sheet_category <> 'Grain'")
    assert values(sheet, "balance_sheet_category", "amt", "qty") == want and len(want) == 3


def test_running_equals_each_year(ledger_of):
    ledger, _ = random_ledger(ledger_of, False)
    running = position.running_positions(position.category_positions(ledger))
    for year in (2019, 2021):
        want = {r[0]: r[1] for r in values(position.balance_sheet(ledger, year), "balance_sheet_category", "amt")}
        for category, amount in values(running.where(f"year = {year}"), "category", "closing_amt"):
            assert amount == want[category]


def test_cleaned_drops_transfers_and_payments(ledger):
    got = {r[0] for r in values(cash.cleaned_cash_transactions(ledger), "split_guid")}
    assert got == {"s2", "s5", "s8", "s9", "s15", "s19", "s21", "s22"}
    assert len(values(cash.cleaned_cash_transactions(ledger), "split_guid")) == 9, "three legs: once per cash account"


def test_farm_reclassification(ledger):
    got = {r["split_guid"]: (r["account_code"], r["account_type"], r["account_name"]) for r in
           cash.farm_cash_transactions(ledger, [2020]).collect()}
    assert "s19" not in got, "harvest income is not cash"
    assert got["s9"] == ("301c", "INCOME", "Corn")
    assert got["s22"] == ("146", "EXPENSE", "PREPAID")
    assert got["s21"] == ("910", "NF EXPENSE", "HOME")


def test_trend_equals_single_years(ledger_of):
    ledger, _ = random_ledger(ledger_of, False)
    years = [2018, 2019, 2020, 2021]
    report = lambda ys: summary.summary_by_account(cash.farm_flows(ledger, ys), by_year=True)
    wide = {r["Code"]: r for r in summary.trend_data(report, years, ["Code", "Account"], "Amount").collect()}
    for year in years:
        for code, amount in values(summary.summary_by_account(cash.farm_flows(ledger, [year])), "Code", "Amount"):
            assert wide[code][str(year)] == pytest.approx(amount)


def test_executive_summary_without_income(ledger_of):
    ledger = ledger_of(accounts=ACCOUNTS, splits=SPLITS[:2], transactions=TX)
    rows = [(r["Account"], r["Amount"]) for r in summary.executive_summary(cash.farm_flows(ledger)).collect()]
    assert [r[0] for r in rows] == ["INCOME", "EXPENSE", "OIBDA"]
    assert rows[0][1] is None and float(rows[1][1]) == -10.0 and rows[2][1] is None


def test_detail_report_totals(ledger):
    rows = summary.transaction_details(cash.farm_cash_transactions(ledger, [2020], quantity=False, paths=False))
    got = values(rows.where("row_kind = 'total'"), "account_code", "Src", "Date", "Amount")
    assert ("500", "Total", dt.date(2020, 12, 31), -11.5) in got
    assert values(rows.where("account_code = '910' and row_kind = 'detail'"), "display") == [("HOME (910)",)]


def test_identity_on_balanced_single_cash_books(ledger_of):
    legs = [split(1, "a", "bank", -1000), split(2, "a", "fuel", 1000), split(3, "b", "bank", 2500), split(4, "b", "corn", -2500)]
    ledger = ledger_of(accounts=ACCOUNTS, splits=legs, transactions=[tx("a", dt.datetime(2019, 1, 5)), tx("b")])
    row = position.identity_check(ledger, 2020).collect()[0]
    assert row["balanced"] and float(row["closing_cash"]) == 15.0 and float(row["opening_cash"]) == -10.0
    paid = legs + [split(5, "c", "bank", -100), split(6, "c", "seed", 100, "Payment")]
    broken = ledger_of(accounts=ACCOUNTS, splits=paid, transactions=[tx("a"), tx("b"), tx("c")])
    assert not position.identity_check(broken, 2020).collect()[0]["balanced"]


def test_years_restrict_both_sides_before_they_meet(spark, tmp_path):
    from acreledger.plans.chart import CASH_TYPES
    from acreledger.sources.ledger import load_ledger
    from acreledger.sources.star import star_ledger
    from acreledger.sources.ledger import write_ledger

    star = star_ledger(spark, "/root/testdata/sf0.001")
    write_ledger(star, str(tmp_path), ["accounts", "transactions", "splits"])
    back = load_ledger(spark, str(tmp_path))
    for df, sides in ((splits.counter_splits(back, CASH_TYPES, True, [1995]), 2), (splits.counter_flows(back, CASH_TYPES, [1995]), 2)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("1995-01-01") >= sides
        scans = df._jdf.queryExecution().executedPlan().toString()
        assert scans.count("(post_year") >= 2 * sides and "PartitionFilters: []" in scans  # accounts only
    rows = lambda books: values(splits.counter_flows(books, CASH_TYPES, [1995]), "split_guid", "amt", "sources")
    assert rows(back) == rows(star) and len(rows(back)) > 100
    sums = lambda books: values(splits.account_totals(books, 1995), "account_guid", "amt", "splits")
    assert sums(back) == sums(star)
    listed = lambda books: values(splits.counter_splits(books, CASH_TYPES, True, [1995, 1997]), "split_guid", "src_guid", "amt")
    assert listed(back) == listed(star)
