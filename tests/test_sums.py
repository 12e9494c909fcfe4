"""Exact sums of rationals against fractions."""

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from acreledger.functions import expr
from acreledger.operators.sums import exact_totals
from acreledger.operators.splits import AMOUNTS, account_totals
from acreledger.plans import cash, position, summary

from .test_splits import ACCOUNTS, brute, tx  # noqa: F401


def nine(value: Fraction) -> Decimal:
    scaled = value * 10**9
    return (Decimal(scaled.numerator) / Decimal(scaled.denominator)).quantize(Decimal(1), ROUND_HALF_UP).scaleb(-9)


@pytest.mark.parametrize("denoms", [[100], [10**6], [10**9], [3], [7], [1, 3, 7, 100, 10**6, 10**9], [0, 100], [-100, 8]])
def test_totals_equal_fractions(spark, denoms):
    rng = random.Random(len(denoms) + denoms[0])
    rows = [(i % 5, rng.randint(-10**12, 10**12), rng.choice(denoms)) for i in range(500)] + [(9, None, 100), (8, 5, 0), (None, 7, 100)]
    df = spark.createDataFrame(rows, "k int, n long, d long")
    want = {}
    for k, n, d in rows:
        want[k] = want.get(k, Fraction(0)) + (Fraction(n, d) if n is not None and d else 0)
    found = exact_totals(df, ["k"], {"amt": ("n", "d")}, {"rows": F.lit(1)}).collect()
    assert {r["k"]: r["amt"] for r in found} == {k: nine(v) for k, v in want.items()}
    assert sum(r["rows"] for r in found) == len(rows)


def test_whole_sums_beyond_a_long(spark):
    big = (1 << 63) - 1
    df = spark.createDataFrame([(big,), (big,), (big,), (-5,), (None,)], "n long")
    assert df.agg(expr.whole_sum("n")).first()[0] == 3 * big - 5
    assert df.where("n < 0").agg(expr.whole_sum("n")).first()[0] == -5
    assert df.where("n IS NULL").agg(expr.whole_sum("n")).first()[0] is None


def test_products_and_signs(spark):
    rows = [(1, 10**9, 1, 10**9), (-3, 7, 2, 3), (12345, 100, -678, 100), (5, 0, 1, 1), (1, 100, 1, 10**6), (None, 1, 1, 1)]
    df = spark.createDataFrame(rows, "n long, d long, p long, e long")
    found = [r[0] for r in df.select(expr.product("n", "d", "p", "e")).collect()]
    for value, (n, d, p, e) in zip(found, rows):
        if n is None or not d:
            assert value is None
        else:
            assert abs(Fraction(value) - Fraction(n, d) * Fraction(p, e)) <= Fraction(1, 10**18)
    assert found[0] == Decimal(1).scaleb(-18) and found[4] == Decimal(1).scaleb(-8)
    signs = [r[0] for r in df.select(expr.is_positive("n", "d")).collect()]
    assert signs == [True, False, True, None, True, None]
    both = spark.createDataFrame([(Decimal("123456789.123456789"), Decimal("98.000000001"))], "a decimal(38,9), b decimal(28,9)")
    assert both.select(expr.times(F.col("a"), F.col("b"))).first()[0] == Decimal("12098765334.222222111123456789")


@pytest.mark.parametrize("denom", [10**6, 10**9, 3])
def test_joined_and_weighted_reports_agree(ledger_of, denom):
    rng = random.Random(denom)
    rows, heads = [], []
    for t in range(30):
        heads.append(tx(f"t{t}"))
        for _ in range(rng.randint(2, 5)):
            rows.append({"guid": f"s{len(rows)}", "tx_guid": f"t{t}", "account_guid": rng.choice(ACCOUNTS)["guid"], "action": "",
                         "value_num": rng.randint(-99, 99), "value_denom": denom, "quantity_num": 1, "quantity_denom": denom})
    ledger = ledger_of(accounts=ACCOUNTS, splits=rows, transactions=heads)
    exact = {}
    for s in rows:
        exact[s["account_guid"]] = exact.get(s["account_guid"], 0) + Fraction(s["value_num"], denom)
    assert {r["account_guid"]: r["amt"] for r in account_totals(ledger).collect()} == {k: nine(v) for k, v in exact.items()}
    keys, near = ["account_code", "account_type"], Decimal(denom % 10 == 3).scaleb(-7)
    joined = {tuple(r[:2]): r["amt"] for r in summary.summary(cash.farm_cash_transactions(ledger, quantity=False, paths=False), keys).collect()}
    flows = {tuple(r[:2]): r["amt"] for r in summary.summary(cash.farm_flows(ledger), keys).collect()}
    assert flows and flows.keys() == joined.keys() and all(abs(flows[k] - joined[k]) <= near for k in flows)
    detail = position.balance_sheet_details(ledger, 2020, quantity=False, paths=False)
    detail = detail.groupBy("balance_sheet_category", "account_guid").agg(F.sum("amt").alias("amt"), F.sum("qty").alias("qty"), F.count("*").alias("rows"))
    detail = {tuple(r[:2]): r for r in detail.collect()}
    totals = {(r["category"], r["account_guid"]): r for r in position.balance_totals(ledger, 2020).collect()}
    assert totals.keys() == detail.keys() and {k: r["rows"] for k, r in totals.items()} == {k: r["rows"] for k, r in detail.items()}
    assert all(abs(totals[k][c] - detail[k][c]) <= near for k in totals for c in ("amt", "qty"))
    tx_rows = cash.fetch_transactions(ledger, ["BANK", "CREDIT", "CASH"], True, quantity=False, paths=False)
    by_source = {tuple(r[:2]): r for r in tx_rows.groupBy("src_code", "src_name").agg(F.sum("amt").alias("amt"), F.sum("qty").alias("qty")).collect()}
    linear = {tuple(r[:2]): r for r in position.cash_by_source(ledger, 2020).collect()}
    assert linear.keys() == by_source.keys() and all(abs(linear[k][c] - by_source[k][c]) <= near for k in linear for c in ("amt", "qty"))


def test_reports_by_account_and_source_never_fan_out(spark):
    from acreledger.sources.star import star_ledger

    ledger = star_ledger(spark, "/root/testdata/sf0.001")
    splits = ledger.splits.count()
    for df in (position.cash_by_source(ledger, 1998), position.balance_totals(ledger, 1998), account_totals(ledger)):
        df.collect()
        plan, todo, joins = df._jdf.queryExecution().executedPlan(), [], 0
        todo.append(plan)
        while todo:
            node = todo.pop()
            name = node.nodeName()
            if "Join" in name:
                joins += 1
                assert node.metrics().apply("numOutputRows").value() <= splits
            for inner in ("executedPlan", "plan"):
                if name.startswith(("AdaptiveSparkPlan",)) and inner == "executedPlan":
                    todo.append(node.executedPlan())
                if "QueryStage" in name and inner == "plan":
                    todo.append(node.plan())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        assert joins
