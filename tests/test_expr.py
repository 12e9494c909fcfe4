import datetime as dt

import pytest
from pyspark.sql import functions as F

from acreledger.functions import expr, text
from acreledger.functions.toml import toml_section
from acreledger.operators import keys, reshape
from acreledger.plans import chart
from acreledger.sources.schema import vendor_terms_toml

from .conftest import values


def col(spark, items, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")


def result(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_numeric_prefix(spark):
    df = col(spark, ["30", "30%", "12.5abc", "abc", "", None, " -3e2x", ".5"])
    assert result(df, expr.numeric_prefix("x")) == [30.0, 30.0, 12.5, 0.0, 0.0, None, -300.0, 0.5]


def test_rational(spark):
    df = spark.createDataFrame([(0, 1, 3), (1, 5, 0), (2, -12345, 100), (3, None, 1)], "i int, n bigint, d bigint")
    assert [None if v is None else float(v) for v in result(df, expr.rational("n", "d"))] == [0.333333333, None, -123.45, None]


def test_year_ranges(spark):
    df = col(spark, [dt.datetime(2019, 12, 31, 23, 59), dt.datetime(2020, 1, 1), dt.datetime(2020, 12, 31, 23), dt.datetime(2021, 1, 1), None], "timestamp")
    count = lambda c: df.where(c).count()
    assert count(expr.in_year("x", 2020)) == 2 and count(expr.in_year("x", 2020, True)) == 3
    assert count(expr.in_year("x", 0)) == 5 and count(expr.in_years("x", [2019, 2021])) == 2
    assert count(expr.in_years("x", [2020, 2021])) == 3 and count(expr.in_years("x", None)) == 5


def test_year_filter_is_pushed(spark, tmp_path):
    df = col(spark, [dt.datetime(2020, 1, 1)], "timestamp")
    df.write.parquet(f"{tmp_path}/t")
    plan = spark.read.parquet(f"{tmp_path}/t").where(expr.in_year("x", 2020))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(x,2020-01-01" in plan and "LessThan(x,2021-01-01" in plan


def test_descriptor_and_prefix(spark):
    df = col(spark, ["Corn on Soybeans", "Corn", "Oats", "my 133", "133a"])
    assert result(df, expr.descriptor("x", ["Corn", "Soybeans"], F.lit("General"))) == ["Soybeans", "Corn", "General", "General", "General"]
    assert result(df, expr.matches("x", "133|134")) == [False, False, False, False, True]


def test_capped_width_and_icons(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 3.0), (2, None)], "i int, x double")
    assert result(df, expr.capped_width("x", 75.0)) == [37.5, 75.0, None]
    assert result(col(spark, ["Corn"]), expr.icon_file("x")) == ["corn.png"]


def test_reclassification_is_sequential(spark):
    df = spark.createDataFrame([("1", "A", "n")], "account_code string, account_type string, account_name string")
    rules = [chart.Reclass("1", {"account_code": "2"}), chart.Reclass("2", {"account_type": "B"})]
    assert values(chart.reclassify(df, rules), "account_code", "account_type") == [("2", "B")]


def test_scrub(spark):
    lines = ["01/02,Amazon.com*AB12C,Shopping,Sale,-5", "x,AMZN Mktp US*QQ,Shopping,Sale", "DisneyPLUS,Bills & Utilities,Sale", "untouched line"]
    got = result(text.scrub_statement(col(spark, lines), "x"), "x")
    assert got == ["01/02,Amazon,Liabilities:Short Term Liabilities:Amazon,Sale,-5", "x,Amazon,Liabilities:Short Term Liabilities:Amazon,Sale",
                   "DisneyPLUS,Movies,Sale", "untouched line"]


def test_links_and_tickets(spark):
    df = col(spark, ["app://open?id=abc", "abc", None])
    assert result(df, text.link_id("app://open?id=", "x")) == ["abc", None, None]
    names = col(spark, ["PRE_00123.pdf", "PRE_000"])
    assert result(names, text.ticket_number("x", "PRE_")) == ["123.pdf", ""]
    assert result(names, text.ticket_title(text.ticket_number("x", "PRE_"))) == ["Scale Ticket 123.pdf", "Scale Ticket "]


def test_toml_terms_and_melt(spark):
    note = "[Vendor_Details]\nReceive_1099 = true\nCorn = 30\nSoybeans = 40\nMax = 300\nMin = 200\n"
    df = spark.createDataFrame([("1", note), ("2", "[Other]\nx = 1"), ("3", "Vendor_Details = 'no section'"), ("4", None)], "operation_id string, n string")
    out = toml_section(df, "n", "Vendor_Details", vendor_terms_toml(["Corn", "Soybeans"]))
    assert values(out, "operation_id", "Receive_1099", "Corn", "Max") == [("1", True, 30.0, 300.0), ("3", None, None, None)]
    melted = reshape.melt(out.where("Max is not null"), ["operation_id", "Max"], ["Corn", "Soybeans"], "crop", "Percentage")
    assert values(melted) == [("1", 300.0, "Corn", 30.0), ("1", 300.0, "Soybeans", 40.0)]


def test_number_text_has_no_exponent(spark):
    df = spark.createDataFrame([(0, 1e7), (1, 0.0), (2, -12.5), (3, 123456789.25)], "i int, x double")
    assert result(df, reshape.number_text("x")) == ["10000000.0", "0.0", "-12.5", "123456789.25"]


def test_trend_text_and_pivot(spark):
    df = spark.createDataFrame([("a", 2020, 1.5), ("a", 2022, 2.0), ("b", 2021, -3.0)], "k string, year int, v double")
    assert values(reshape.trend_text(df, ["k"], "year", [2020, 2021, 2022], "v")) == [("a", "1.5 0.0 2.0"), ("b", "0.0 -3.0 0.0")]
    assert values(reshape.pivot_mean(df, ["k"], "year", [2020, 2021, 2022], "v")) == [("a", 1.5, 0.0, 2.0), ("b", 0.0, -3.0, 0.0)]


def test_total_rows(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 5)], "k string, t string, v int")
    assert ("Total", None, 8) in values(reshape.with_total_row(df, "Total", "k", ["v"]))
    rows = values(reshape.detail_with_totals(df, ["k"], ["v"]).where("row_kind = 'total'"), "k", "v")
    assert rows == [("a", 3), ("b", 5)]


def test_keys(spark):
    rows = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "num string")
    known = spark.createDataFrame([("2", "t"), ("3", "u")], "num string, guid string")
    assert values(keys.not_yet_entered(rows, known, "num")) == [("1",), (None,)]
    assert values(keys.existing_records(known, rows, "num")) == [("2", "t")]


@pytest.mark.parametrize("text_date,expected", [("2020-01-02", "2020-01-02 00:00:00"), ("2020-01-02 03:04:05.678", "2020-01-02 03:04:05"), ("soon", None)])
def test_post_date_text(spark, text_date, expected):
    from acreledger.sources.ledger import normalise_post_date

    df = spark.createDataFrame([(text_date,)], "post_date string")
    assert normalise_post_date(df).collect()[0][0] == expected


def test_rational_is_exact_for_fine_denominators(spark):
    rows = [(1, 1000000), (1, 10**9), (9007199254740993, 100), (-5, 10**6), (9223372036854775807, 1), (7, 0)]
    df = spark.createDataFrame(rows, "n long, d long")
    from decimal import Decimal

    got = [r[0] for r in df.select(expr.rational("n", "d")).collect()]
    assert got == [None if d == 0 else Decimal(n) / Decimal(d) for n, d in rows]


def test_subtotals_from_one_pass(spark):
    rows = [("a", "x", 1), ("a", "x", 1), ("a", None, None), (None, "y", 5), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, t string, v bigint")
    both = reshape.detail_with_totals(df, ["k"], ["v"])
    assert values(both.where("row_kind = 'detail'"), "k", "t", "v") == sorted(rows, key=lambda t: [(v is None, str(v)) for v in t])
    totals = [("a", None, 2), ("b", None, 0), (None, None, 5)]
    assert values(both.where("row_kind = 'total'"), "k", "t", "v") == sorted(totals, key=lambda t: [(v is None, str(v)) for v in t])
    assert reshape.detail_with_totals(df.limit(0), ["k"], ["v"]).count() == 0
    plan = reshape.detail_with_totals(spark.range(9).selectExpr("id % 2 AS k", "id AS v"), ["k"], ["v"])
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and "Union" not in plan
