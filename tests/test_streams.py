import datetime as dt
import os

import pytest

from acreledger.operators.entries import unbalanced
from acreledger.plans import loads
from acreledger.sources import files
from acreledger.streaming import ingest, windows

from .conftest import values

HEADER = "Ticket Number, Tare Time Stamp, Gross Time Stamp, Crop Description, Net Units\n"


def put(folder, name, *rows):
    """Write aside, then move in one step, as the file source expects."""
    os.makedirs(folder, exist_ok=True)
    hidden = f"{folder}/.{name}"
    with open(hidden, "w") as f:
        f.write(HEADER + "".join(f"{t}, {when}, {when}, {crop}, {units}\n" for t, when, crop, units in rows))
    os.rename(hidden, f"{folder}/{name}")


@pytest.fixture
def world(spark, ledger_of, tmp_path):
    bids = spark.createDataFrame([("c1", "Corn", "USD", 4.005), ("c2", "Soybeans", "USD", 10.0)], "commodity_guid string, crop string, currency_guid string, cash double")
    posting = spark.createDataFrame([("c1", "from1", "to1"), ("c2", "from2", None)], "commodity_guid string, from_guid string, to_guid string")
    notes = ledger_of(notes=[{"id": "n7", "title": "Scale Ticket 7"}]).notes
    target = ingest.IngestTarget(f"{tmp_path}/ledger")

    def run(checkpoint="one", locks=None, **options):
        stream = files.stream_load_files(spark, f"{tmp_path}/in", "LOADS", **options)
        query = ingest.start_ingest(stream, target, f"{tmp_path}/{checkpoint}", bids, posting, notes, "Coop", "app://",
                                    locks=locks, available_now=True)
        query.awaitTermination()
        return target

    return f"{tmp_path}/in", run, target


def test_ingest_writes_balanced_entries_once(spark, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (7, "10/05/24 08:00:00", "CORN YEL", 100.5), (7, "10/05/24 08:00:00", "CORN YEL", 50), (8, "10/05/24 09:00:00", "CORN", 10))
    put(folder, "other.csv", (99, "10/05/24 08:00:00", "CORN", 1))
    run()
    assert values(target.read(spark, "transactions"), "num", "post_date", "description") == [
        ("7", dt.datetime(2024, 10, 5, 8), "Coop"), ("8", dt.datetime(2024, 10, 5, 9), "Coop")]
    legs = values(target.read(spark, "splits"), "account_guid", "action", "value_num", "quantity_num")
    assert set(legs) == {("from1", "Sell", -60275, -15050), ("from1", "Sell", -4005, -1000), ("to1", "Buy", 4005, 1000), ("to1", "Buy", 60275, 15050)}
    assert len(legs) == 4
    assert unbalanced(target.read(spark, "splits")).isEmpty()
    assert values(target.read(spark, "slots"), "name", "string_val") == [("assoc_uri", "app://n7")]
    before = {t: values(target.read(spark, t), "guid") for t in ("transactions", "splits")}
    put(folder, "LOADS2.csv", (8, "10/05/24 09:00:00", "CORN", 10), (9, "10/06/24 09:00:00", "CORN", 1))
    run()
    assert len(values(target.read(spark, "transactions"), "num")) == 3
    run("lost-checkpoint")
    assert len(values(target.read(spark, "transactions"), "num")) == 3, "files offered again change nothing"
    assert len(values(target.read(spark, "splits"), "guid")) == 6
    assert set(before["splits"]) <= set(values(target.read(spark, "splits"), "guid"))


def test_two_files_same_ticket_in_separate_batches(spark, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (1, "10/05/24 08:00:00", "CORN", 10))
    put(folder, "LOADS2.csv", (1, "10/05/24 08:00:00", "CORN", 10), (2, "10/05/24 08:00:00", "CORN", 5))
    run(files_per_trigger=1)
    assert values(target.read(spark, "transactions"), "num") == [("1",), ("2",)]


def test_partial_write_is_completed(spark, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (7, "10/05/24 08:00:00", "CORN", 10))
    run("first")
    splits = target.read(spark, "splits").collect()
    other = ingest.IngestTarget(target.path + "-broken")
    other.append(spark.createDataFrame(splits[:1], target.read(spark, "splits").schema), "splits")
    bids = spark.createDataFrame([("c1", "Corn", "USD", 4.005)], "commodity_guid string, crop string, currency_guid string, cash double")
    posting = spark.createDataFrame([("c1", "from1", "to1")], "commodity_guid string, from_guid string, to_guid string")
    batch = files.read_load_file(spark, f"{folder}/LOADS1.csv")
    for _ in range(2):
        ingest.append_batch(spark, batch, other, bids, posting, spark.createDataFrame([], "id string, title string"), "Coop", "app://")
    assert len(values(other.read(spark, "splits"), "guid")) == 2
    assert len(values(other.read(spark, "transactions"), "guid")) == 1


def test_unpostable_loads_are_kept_aside(spark, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (1, "10/05/24 08:00:00", "OATS", 10), (2, "10/05/24 08:00:00", "BEANS", 5), (3, "10/05/24 08:00:00", "CORN", 5))
    run()
    assert values(target.read(spark, "transactions"), "num") == [("3",)]
    assert values(spark.read.parquet(f"{target.path}/rejected"), "num") == [("1",), ("2",)]


def test_locked_ledger_is_not_written(spark, ledger_of, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (1, "10/05/24 08:00:00", "CORN", 10))
    locks = ledger_of(locks=[{"hostname": "pc", "pid": 1}]).locks
    with pytest.raises(Exception, match="locked"):
        run(locks=lambda: locks)
    assert target.read(spark, "transactions").isEmpty()
    run(locks=lambda: ledger_of().locks)
    assert target.read(spark, "transactions").count() == 1


def test_one_batch_equals_one_file_per_batch(spark, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (1, "10/05/24 08:00:00", "CORN", 10), (1, "10/05/24 08:00:00", "CORN", 10))
    put(folder, "LOADS2.csv", (1, "10/05/24 08:00:00", "CORN", 10), (2, "10/05/24 08:00:00", "CORN", 5))
    os.utime(f"{folder}/LOADS1.csv", (1_000_000_000, 1_000_000_000))
    run()
    assert values(target.read(spark, "splits").where("action = 'Buy'"), "quantity_num") == [(2000,), (500,)]


def test_stream_finds_columns_by_name(spark, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (1, "10/05/24 08:00:00", "CORN", 10))
    lines = open(f"{folder}/LOADS1.csv").read().splitlines()
    turned = [",".join(['"x, y"', *reversed(line.split(","))]) for line in lines]
    with open(f"{folder}/LOADS2.csv", "w") as f:
        f.write("\r\n".join(turned).replace("1", "2", 0).replace('"x, y"', "Extra", 1).replace("CORN", "CORN YEL") + "\r\n")
    names = values(files.read_load_file(spark, f"{folder}/LOADS2.csv"), "ticket_number", "net_units")
    stream = files.stream_load_files(spark, folder, "LOADS2")
    query = stream.writeStream.format("parquet").option("path", f"{target.path}-out").option("checkpointLocation", f"{target.path}-cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert values(spark.read.parquet(f"{target.path}-out"), "ticket_number", "net_units") == names == [(1, 10.0)]


def test_rejected_once_and_posted_later(spark, world):
    folder, run, target = world
    put(folder, "LOADS1.csv", (1, "10/05/24 08:00:00", "OATS", 10), (2, "10/05/24 08:00:00", "BEANS", 5))
    run()
    run("lost-checkpoint")
    assert values(spark.read.parquet(f"{target.path}/rejected"), "num") == [("1",), ("2",)]
    bids = spark.createDataFrame([("c2", "Beans", "USD", 10.0)], "commodity_guid string, crop string, currency_guid string, cash double")
    posting = spark.createDataFrame([("c2", "from2", "to2")], "commodity_guid string, from_guid string, to_guid string")
    crops = spark.createDataFrame([("2", "Beans"), ("1", None)], "num string, crop string")
    notes = spark.createDataFrame([], "id string, title string")
    for _ in range(2):
        ingest.retry_rejected(spark, target, bids, posting, notes, crops, "app://")
    assert values(target.read(spark, "transactions"), "num") == [("2",)]
    assert values(target.read(spark, "splits"), "account_guid", "value_num") == [("from2", -5000), ("to2", 5000)]


def test_batch_reader_trims_headers(spark, tmp_path):
    put(f"{tmp_path}", "LOADS1.csv", (1, "10/05/24 08:00:00", "CORN", 10), (2, "bad", "CORN", 10))
    got = values(files.read_load_file(spark, f"{tmp_path}/LOADS1.csv"), "ticket_number", "tare_time", "net_units")
    assert got == [(1, dt.datetime(2024, 10, 5, 8), 10.0), (2, None, 10.0)]
    assert loads.tickets(files.read_load_file(spark, f"{tmp_path}/LOADS1.csv")).count() == 1


def test_window_totals_match_calendar(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, 12), d) for d in (1, 1, 7, 8, 15)]
    spark.createDataFrame(rows, "ts timestamp, v bigint").write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema("ts timestamp, v bigint").parquet(f"{tmp_path}/in")
    for unit, want in (("day", 4), ("week", 3)):
        totals = windows.windowed_totals(source, "ts", "v", unit)
        windows.start_totals(totals, f"{tmp_path}/{unit}", f"{tmp_path}/cp-{unit}", available_now=True).awaitTermination()
        got = values(windows.read_totals(spark, f"{tmp_path}/{unit}"), "bucket", "total")
        assert len(got) == want
    assert got == [(dt.date(2024, 1, 7), 9), (dt.date(2024, 1, 14), 8), (dt.date(2024, 1, 21), 15)]


def test_late_rows_and_old_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(windows, "COMPACT_EVERY", 2)
    for k, day in enumerate((1, 1, 20, 1, 20, 21)):
        rows = spark.createDataFrame([(dt.datetime(2024, 1, day, 12), 10**k)], "ts timestamp, v bigint").coalesce(1)
        rows.write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema("ts timestamp, v bigint").parquet(f"{tmp_path}/in")
        totals = windows.windowed_totals(source, "ts", "v", "day")
        windows.start_totals(totals, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True).awaitTermination()
    got = values(windows.read_totals(spark, f"{tmp_path}/out"), "bucket", "total")
    assert got == [(dt.date(2024, 1, 1), 11), (dt.date(2024, 1, 20), 10100), (dt.date(2024, 1, 21), 100000)]  # 1000 came too late
    assert len([x for x in os.listdir(f"{tmp_path}/out") if x.startswith("batch=")]) <= 3


def test_document_stream(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    for name in ("SCAN_0012.pdf", "SCAN_0300.pdf", "note.pdf"):
        with open(f"{tmp_path}/in/{name}", "wb") as f:
            f.write(b"%PDF")
    query = windows.stream_documents(spark, f"{tmp_path}/in", "SCAN_").writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert values(spark.read.parquet(f"{tmp_path}/out"), "title") == [("Scale Ticket 12.pdf",), ("Scale Ticket 300.pdf",)]
