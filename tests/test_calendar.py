import datetime as dt

import pytest

from acreledger.operators import calendar
from acreledger.plans import notes

from .conftest import values

D = dt.date


@pytest.fixture
def counts(spark):
    days = [("2024-01-29", 5), ("2024-01-29", 7), ("2024-01-31", 1), ("2024-02-04", 10), ("2024-02-05", 3),
            ("2024-02-20", 4), ("2024-04-01", 2)]
    rows = [(dt.datetime.fromisoformat(d + "T10:00:00"), v) for d, v in days] + [(None, 9)]
    return spark.createDataFrame(rows, "t timestamp, v bigint")


def test_daily_sum_fills_gaps(counts):
    got = {r["bucket"]: r["v"] for r in calendar.resample(counts, "t", "v").collect()}
    assert len(got) == 64 and got[D(2024, 1, 29)] == 12 and got[D(2024, 1, 30)] == 0 and got[D(2024, 4, 1)] == 2


def test_weeks_end_on_sunday(counts):
    got = {r["bucket"]: r["v"] for r in calendar.resample(counts, "t", "v", "week").collect()}
    assert got[D(2024, 2, 4)] == 23 and got[D(2024, 2, 11)] == 3 and got[D(2024, 2, 18)] == 0
    assert max(got) == D(2024, 4, 7) and len(got) == 10
    mean = {r["bucket"]: r["v"] for r in calendar.resample(counts, "t", "v", "week", "mean").collect()}
    assert mean[D(2024, 2, 4)] == 23 / 4 and mean[D(2024, 2, 18)] is None


def test_month_end_mean(counts):
    got = {r["bucket"]: r["v"] for r in calendar.resample(counts, "t", "v", "month", "mean").collect()}
    assert got == {D(2024, 1, 31): 13 / 3, D(2024, 2, 29): 17 / 3, D(2024, 3, 31): None, D(2024, 4, 30): 2.0}


def test_groups_have_their_own_calendar(spark):
    rows = [("a", dt.datetime(2024, 1, 1), 1), ("a", dt.datetime(2024, 1, 3), 1), ("b", dt.datetime(2024, 5, 1), 1)]
    df = spark.createDataFrame(rows, "g string, t timestamp, v int")
    assert calendar.resample(df, "t", "v", "day", "sum", ["g"]).count() == 4


def test_statistics(counts):
    row = calendar.summary_statistics(counts.where("t is not null"), "v").collect()[0].asDict()
    assert row == {"count": 7, "mean": 32 / 7, "min": 1, "max": 10, "median": 4.0, "sum": 32}


def test_note_counters(ledger_of):
    ms = lambda t: int(dt.datetime.fromisoformat(t + "+00:00").timestamp() * 1000)
    rows = [("Push-ups am", "20", "2024-01-01T23:30:00"), ("PUSH-UPS", "x", "2024-01-02T10:00:00"), ("push-ups", "5", "2024-01-03T01:00:00"),
            ("Weigh-in", "80.5", "2024-01-03T01:00:00")]
    ledger = ledger_of(notes=[{"id": str(i), "title": t, "body": b, "user_created_time": ms(w) + 999, "user_updated_time": ms(w)} for i, (t, b, w) in enumerate(rows)])
    assert values(notes.counter(ledger.notes, "push-ups%")) == [(D(2024, 1, 1), 20), (D(2024, 1, 2), 0), (D(2024, 1, 3), 5)]
    chicago = values(notes.counter(ledger.notes, "push-ups%", zone="America/Chicago"))
    assert chicago == [(D(2024, 1, 1), 20), (D(2024, 1, 2), 5)]
    created = notes.note_rows(ledger.notes).where("note_id = '0'").collect()[0]["created_date"]
    assert created == dt.datetime(2024, 1, 1, 23, 30)


def test_median_without_holding_a_group(spark):
    import random
    import statistics

    rng = random.Random(6)
    rows = [("even", float(i)) for i in range(10)] + [("odd", float(i * i)) for i in range(11)] + [("one", 4.0), ("none", None), (None, 2.0), (None, 5.0)]
    rows += [("hot", 7.0)] * 3000 + [("hot", rng.uniform(-5, 5)) for _ in range(2500)]
    rows += [("far", 1e300), ("far", -1e300)] + [("far", rng.gauss(0, 1e-6)) for _ in range(999)]
    rows += [("ties", float(rng.randrange(3))) for _ in range(1000)]
    want = {}
    for k, v in rows:
        want.setdefault(k, []).append(v)
    want = {k: statistics.median(x) for k, vs in want.items() if (x := [v for v in vs if v is not None])}
    df = spark.createDataFrame(rows, "k string, v double")
    for buckets in (4, 4096):
        found = {r["k"]: r["median"] for r in calendar.exact_median(df, "v", ["k"], buckets=buckets).collect()}
        assert found == want
    stats = {r["k"]: r for r in calendar.summary_statistics(df, "v", ["k"]).collect()}
    assert stats["none"]["median"] is None and stats["none"]["count"] == 0 and stats["hot"]["median"] == 7.0 and stats[None]["median"] == 3.5
    whole = calendar.summary_statistics(spark.createDataFrame([], "v int"), "v").collect()
    assert len(whole) == 1 and whole[0]["median"] is None and whole[0]["count"] == 0


def test_median_reads_no_group_into_one_task(spark):
    df = spark.range(0, 400_000, 1, 8).selectExpr("CAST(id % 1000 AS INT) AS v", "'all' AS k")
    plan = calendar.exact_median(df, "v", ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "median" not in plan.lower().replace("as median", "") and "percentile" not in plan and "collect" not in plan
    assert calendar.exact_median(df, "v", ["k"]).collect()[0]["median"] == 499.5
