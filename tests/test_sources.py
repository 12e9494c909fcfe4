import pytest

from acreledger import load_ledger, write_ledger
from acreledger.session import cut_lineage, new_work_dir, shared_dir
from acreledger.sources import ledger as src
from acreledger.sources.files import read_machine_yield, read_statement_lines

from .conftest import values
from .test_splits import ACCOUNTS, SPLITS, TX


def test_ledger_round_trip_and_year_pruning(spark, ledger_of, tmp_path):
    write_ledger(ledger_of(accounts=ACCOUNTS, splits=SPLITS, transactions=TX), f"{tmp_path}/books")
    back = load_ledger(spark, f"{tmp_path}/books")
    assert back.splits.count() == len(SPLITS) and back.transactions.count() == len(TX)
    assert back.splits is back.splits
    assert (tmp_path / "books/transactions/post_year=2020").exists()
    with pytest.raises(AttributeError):
        back.nothing


def test_guid_ranges_cover_every_guid():
    parts = src.guid_ranges("guid", 16)
    assert len(parts) == 16 and parts[0] == "(guid < '1' or guid is null)" and parts[-1] == "guid >= 'f'"
    assert parts[1] == "(guid >= '1' and guid < '2')" and len(src.guid_ranges("g", 256)) == 256
    with pytest.raises(ValueError):
        src.guid_ranges("guid", 10)


def test_sheets_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("Corn", 1), ("Soybeans", 2)], "Crop string, n int")
    src.write_sheets({"One": df, "Two": df.limit(1)}, f"{tmp_path}/book")
    assert spark.read.parquet(f"{tmp_path}/book/One").count() == 2
    src.write_partitioned(df, f"{tmp_path}/crops", "Crop")
    assert (tmp_path / "crops/Crop=Corn").exists()
    src.write_csv(df, f"{tmp_path}/csv")
    assert values(spark.read.option("header", True).csv(f"{tmp_path}/csv")) == [("Corn", "1"), ("Soybeans", "2")]


def test_small_tables_and_locks(spark, ledger_of):
    assert values(src.discount_table(spark, {"Cash": 70, "Grain": 80})) == [("Cash", 70.0), ("Grain", 80.0)]
    assert not src.is_locked(ledger_of().locks) and src.is_locked(ledger_of(locks=[{"hostname": "h"}]).locks)


def test_text_and_machine_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b\nc,d\n")
    assert values(read_statement_lines(spark, f"{tmp_path}/s.csv")) == [("a,b",), ("c,d",)]
    (tmp_path / "m.csv").write_text("h1,h2,h3,h4,h5,h6,h7\nF,Corn,v,15.1,2.5,100,2024-10-01 10:00:00\n")
    assert values(read_machine_yield(spark, f"{tmp_path}/m.csv"), "farms", "area_harvested") == [("F", 2.5)]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert new_work_dir(spark, "x") != new_work_dir(spark, "x")
    assert cut_lineage(spark.range(3)).count() == 3


def test_bucketed_splits_are_not_shuffled_again(spark, ledger_of, tmp_path):
    from acreledger.operators.splits import counter_flows, source_counts
    from acreledger.plans.chart import CASH_TYPES

    books = ledger_of(accounts=ACCOUNTS, splits=SPLITS, transactions=TX)
    src.write_bucketed(books, f"{tmp_path}/b", 4, "bucketed")
    back = src.load_bucketed(spark, f"{tmp_path}/b", "bucketed")
    assert values(counter_flows(back, CASH_TYPES), "split_guid", "amt") == values(counter_flows(books, CASH_TYPES), "split_guid", "amt")
    plan = source_counts(back, CASH_TYPES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    spark.sql("drop table bucketed_splits")
    spark.sql("drop table bucketed_transactions")


def test_declared_types_of_text_tables(spark):
    rows = spark.createDataFrame(
        [("g1", "2020-01-05 10:59:00", "7"), ("g2", "no time", "x"), ("g3", None, None)], "guid string, post_date string, num string"
    )
    got = src.declared(rows, "guid string, post_date timestamp, num bigint, description string", "America/Chicago").collect()
    assert [str(r["post_date"]) for r in got] == ["2020-01-05 16:59:00", "None", "None"]
    assert [r["num"] for r in got] == [7, None, None] and all(r["description"] is None for r in got)


def test_changed_star_tables_are_seen(spark, tmp_path):
    import shutil

    from acreledger.operators.tree import with_paths
    from acreledger.sources.star import star_ledger

    folder = tmp_path / "star"
    folder.mkdir()
    for name in "region nation customer supplier part".split():
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", folder)
    ledger = star_ledger(spark, str(folder))
    tops = lambda books: {r[0] for r in with_paths(books.accounts).where("guid LIKE 'n%'").select("parent_accounts").collect()}
    before = tops(ledger)
    assert star_ledger(spark, str(folder)) is ledger
    region = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    spark.createDataFrame([(r[0], r[1] + " NEW", *r[2:]) for r in region.collect()], region.schema).coalesce(1).write.parquet(str(tmp_path / "new"))
    (folder / "region.parquet").unlink()
    shutil.copytree(tmp_path / "new", folder / "region.parquet")
    assert tops(star_ledger(spark, str(folder))) == {p.replace(">", " NEW>") for p in before}
    ledger.forget()
