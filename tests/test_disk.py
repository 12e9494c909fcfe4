"""What large ledgers leave on disk and on the heap: shuffles that go, bytes for guids, state on disk."""

import datetime as dt
import glob
import os
import time

import pytest

from acreledger.functions import expr
from acreledger.operators import splits, sums
from acreledger.plans import closing, position
from acreledger.plans.chart import CASH_TYPES
from acreledger.session import cut_lineage
from acreledger.sources import files
from acreledger.sources.ledger import load_ledger, write_ledger
from acreledger.sources.star import star_ledger
from acreledger.streaming import ingest
from checks.queries import REGISTRY

from .conftest import values

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def left_by(spark, work):
    """Shuffle files of a piece of work that are still there after it."""
    before = shuffle_files(spark)
    kept = work()  # noqa: F841  what still refers to a shuffle keeps its files
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return set()
        time.sleep(0.1)
    return shuffle_files(spark) - before


TEXTS = [None, "", "a", "00", "0123456789abcdef", "fifteen letters", "sixteen letters!", "0" * 31, "0123456789abcdef" * 2,
         "0123456789ABCDEF" * 2, "g123456789abcdef" * 2, "0123456789abcdef" * 3, "äöü" * 6, "a\0", "é" * 8]


def test_texts_come_back_from_bytes(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").withColumn("b", expr.packed("t"))
    rows = df.withColumn("back", expr.unpacked("b")).collect()
    assert [r["back"] for r in rows] == TEXTS
    assert len({r["b"] for r in rows}) == len(TEXTS)
    assert [len(r["b"]) for r in rows if r["t"] == "0123456789abcdef" * 2] == [16]


def test_freed_checkpoint_leaves_no_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    assert left_by(spark, lambda: cut_lineage(df, free=True)) == set()
    assert values(cut_lineage(df, free=True)) == values(df)


# --- streams -----------------------------------------------------------------


def test_state_of_the_ingest_is_on_disk(spark, tmp_path, ledger_of):
    os.makedirs(f"{tmp_path}/in")
    with open(f"{tmp_path}/in/LOADS1.csv", "w") as f:
        f.write("Ticket Number, Tare Time Stamp, Gross Time Stamp, Crop Description, Net Units\n7, 10/05/24 08:00:00, 10/05/24 08:00:00, CORN, 5\n")
    bids = spark.createDataFrame([("c1", "Corn", "USD", 4.0)], "commodity_guid string, crop string, currency_guid string, cash double")
    posting = spark.createDataFrame([("c1", "from1", "to1")], "commodity_guid string, from_guid string, to_guid string")
    target = ingest.IngestTarget(f"{tmp_path}/ledger")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    stream = files.stream_load_files(spark, f"{tmp_path}/in", "LOADS")
    ingest.start_ingest(stream, target, f"{tmp_path}/cp", bids, posting, ledger_of().notes, "Coop", "app://", available_now=True).awaitTermination()
    assert spark.conf.get(key, None) == before
    assert "RocksDBStateStoreProvider" in open(f"{tmp_path}/cp/offsets/0").read()
    assert glob.glob(f"{tmp_path}/cp/state/0/*/*.zip") or glob.glob(f"{tmp_path}/cp/state/0/*/*.changelog")
    assert len(values(target.read(spark, "splits"), "guid")) == 2


def test_lines_of_a_load_file_are_taken_from_its_text(spark, tmp_path):
    """No list of all lines is made beside the text, filtered or carried: such lists took a file's size several times."""
    path = f"{tmp_path}/LOADS1.csv"
    with open(path, "w") as f:
        f.write("Net Units, Ticket Number,Tare Time Stamp,Gross Time Stamp,Crop Description\n")
        f.write("".join(f'{i}, {i}, 10/05/24 08:00:00, 10/05/24 08:00:00, "CORN\n{i}"\n\n' for i in range(300)))
    rows = files.read_whole_load_files(spark, [path])
    assert values(rows, "ticket_number", "net_units") == sorted([(i, float(i)) for i in range(300)], key=str)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan and "filter(" not in plan


# --- reports -----------------------------------------------------------------


@needs_tables
def test_nearest_moments_frees_its_first_half_and_carries_bytes(spark):
    assert left_by(spark, lambda: REGISTRY["nearest_moments"](spark, FOLDER)) == set()
    plan = REGISTRY["nearest_moments"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(" in plan


@needs_tables
def test_closing_positions_leave_no_shuffle(spark):
    assert left_by(spark, lambda: REGISTRY["closing_positions"](spark, FOLDER)) == set()


def test_sums_of_year_folders_equal_those_of_the_whole(spark, ledger_of, tmp_path):
    day = lambda year: dt.datetime(year, 5, 1)
    accounts = [{"guid": g, "name": g, "account_type": t} for g, t in (("bank", "BANK"), ("due", "PAYABLE"), ("fuel", "EXPENSE"))]
    # "b" comes twice with two years; all its splits lie in one folder and count in both years
    tx = [{"guid": g, "post_date": day(y)} for g, y in (("a", 2019), ("b", 2020), ("b", 2021), ("c", 2021))] + [{"guid": "d"}]
    legs = [(g, a, v, n) for g in "abcd" for a, v, n in (("bank", -10, 3), ("fuel", 6, 3), ("fuel", 4, 7), ("due", 1, 100))]
    rows = [{"guid": f"s{i}", "tx_guid": g, "account_guid": a, "value_num": v, "value_denom": n, "quantity_num": v, "quantity_denom": n} for i, (g, a, v, n) in enumerate(legs)]
    write_ledger(ledger_of(accounts=accounts, splits=rows, transactions=tx), f"{tmp_path}/books", ["accounts", "transactions", "splits"])
    assert closing.renew_closings(spark, f"{tmp_path}/books", f"{tmp_path}/sums") == [2019, 2020, 2021, None]
    books = load_ledger(spark, f"{tmp_path}/books")
    whole = values(position.category_positions(books), "category", "year", "amt", "qty")
    assert values(closing.stored_positions(spark, f"{tmp_path}/sums"), "category", "year", "amt", "qty") == whole
    assert {r[1] for r in whole} == {2019, 2020, 2021, None}


@needs_tables
def test_guids_are_bytes_and_keys_numbers_in_the_shuffles_of_all_transactions(spark):
    plan = splits.all_transactions(star_ledger(spark, FOLDER))._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().split("\n")
    joins = [i for i, line in enumerate(lines) if "Join Inner" in line]
    assert any("unhex(" in line for line in lines[joins[0] :])
    scans = [i for i, line in enumerate(lines) if "l_extendedprice" in line and "Project" in line]
    assert scans and not any("concat_ws" in lines[i] for i in scans), "texts of a line are made after its join"


@needs_tables
def test_counter_splits_of_parts_sum_to_those_of_the_whole(spark):
    ledger = star_ledger(spark, FOLDER)
    rows = lambda books: splits.counter_splits(books, CASH_TYPES, pairs=True)
    total = lambda df: sums.exact_totals(df, ["src_guid", "account_type"], splits.AMOUNTS, {"n": splits.F.lit(1)})
    whole = values(total(rows(ledger)))
    assert values(total([rows(part) for part in splits.in_parts(ledger, 3)])) == whole and len(whole) > 100
    listed = [r for part in splits.in_parts(ledger, 3) for r in values(rows(part), "split_guid", "src_guid")]
    assert sorted(listed) == values(rows(ledger), "split_guid", "src_guid")
    assert left_by(spark, lambda: REGISTRY["counter_splits"](spark, FOLDER)) == set()
