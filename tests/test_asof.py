import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from acreledger.operators.asof import nearest
from acreledger.plans import prices

from .conftest import values

BASE = dt.datetime(2024, 1, 1)


def brute(facts, points):
    out = []
    for fid, key, when in facts:
        near = [p for p in points if p[0] == key and p[1] is not None] if when else []
        best = min(near, key=lambda p: (abs(p[1] - when), p[1], p[3]), default=None)
        out.append((fid, best[1] if best else None, best[2] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,step", [(1, 3600), (2, 86400), (3, 60)])
def test_nearest_equals_brute_force(spark, seed, step):
    rng = random.Random(seed)
    when = lambda: BASE + dt.timedelta(seconds=step * rng.randint(0, 60))
    keys = ["hot"] * 6 + ["b", "c"]
    facts = [(i, rng.choice(keys + ["none"]), when()) for i in range(300)] + [(900, "hot", None), (901, None, BASE)]
    points = [(rng.choice(keys), when(), rng.randint(1, 9), f"g{i:03}") for i in range(120)]
    f = spark.createDataFrame(facts, "id int, k string, t timestamp")
    p = spark.createDataFrame(points, "k string, t timestamp, v int, g string")
    got = [tuple(r) for r in nearest(f, p, "k", "t", "v", "g").select("id", "near_time", "near_v").collect()]
    assert sorted(got, key=str) == brute(facts, points)
    hourly = nearest(f, p, "k", "t", "v", "g", bucket=F.date_trunc("hour", "t"))
    assert sorted([tuple(r) for r in hourly.select("id", "near_time", "near_v").collect()], key=str) == sorted(got, key=str)


def test_tie_takes_the_earlier(spark):
    f = spark.createDataFrame([(1, "k", BASE + dt.timedelta(days=5))], "id int, k string, t timestamp")
    p = spark.createDataFrame([("k", BASE, 1, "a"), ("k", BASE + dt.timedelta(days=10), 2, "b")], "k string, t timestamp, v int, g string")
    assert [tuple(r)[-1] for r in nearest(f, p, "k", "t", "v", "g").collect()] == [1]


COMMODITIES = [{"guid": "g1", "fullname": "Corn", "namespace": "CROP"}, {"guid": "g2", "fullname": "Soybeans", "namespace": "CROP"},
               {"guid": "corn", "fullname": "Oats", "namespace": "CROP"}]


def price(guid, commodity, day, cents, kind="bid", denom=100):
    return {"guid": guid, "commodity_guid": commodity, "currency_guid": "USD", "date": BASE + dt.timedelta(days=day),
            "type": kind, "value_num": cents, "value_denom": denom}


PRICES = [price("p1", "g1", 0, 400), price("p2", "g1", 10, 500), price("p3", "g1", 10, 505), price("p4", "g1", 4, 900, "ask"),
          price("p5", "g2", 3, 1000), price("p6", "corn", 5, 222), price("p7", "g1", 20, 5, denom=0), price("p8", "g2", 400, 1200, "bid size")]


def test_bids_mean_last_and_year(ledger_of):
    ledger = ledger_of(prices=PRICES, commodities=COMMODITIES)
    mean = {r[0]: r[1] for r in values(prices.commodity_bids(ledger, "mean", 2024), "crop", "cash")}
    assert mean["Corn"] == pytest.approx((4 + 5 + 5.05) / 3) and mean["Soybeans"] == 10.0
    last = {r[0]: r[1] for r in values(prices.commodity_bids(ledger, "last", 2024), "crop", "cash")}
    assert last == {"Corn": 5.05, "Soybeans": 10.0, "Oats": 2.22}
    every = prices.commodity_bids(ledger, None)
    assert every.count() == 6
    by_year = prices.commodity_bids(ledger, "last", by_year=True)
    assert values(by_year.where("crop = 'Soybeans'"), "year", "cash") == [(2024, 10.0), (2025, 12.0)]
    assert prices.commodity_bids(ledger, "mean", 2024, complete_rows_only=True).count() == 0


def test_single_lookup_prefers_guid(ledger_of):
    ledger = ledger_of(prices=PRICES, commodities=COMMODITIES)
    assert values(prices.nearest_commodity_bid(ledger, "corn", "2024-01-01"), "cash") == [(2.22,)]
    assert values(prices.nearest_commodity_bid(ledger, "soybeans", "2024-01-05"), "cash") == [(10.0,)]
    assert values(prices.nearest_commodity_bid(ledger, "g1", "2024-01-06"), "cash") == [(4.0,)], "tie: earlier"
    assert prices.nearest_commodity_bid(ledger, "rye", "2024-01-06").count() == 0
    assert values(prices.bids_of_commodities(ledger, ["Corn"]), "guid") == [("p1",), ("p2",), ("p3",), ("p7",)]


def test_a_crowded_day_of_one_key_is_spread(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    at = np.sort(rng.choice(86_400_000, 60_000, replace=False))
    asked = rng.integers(0, 86_400_000, 5_000)
    stamp = lambda ms: BASE + dt.timedelta(milliseconds=int(ms))
    points = spark.createDataFrame([("hot", stamp(t), int(t), str(t)) for t in at], "k string, ts timestamp_ntz, v long, tie string")
    facts = spark.createDataFrame([(i, "hot", stamp(t)) for i, t in enumerate(asked)], "id long, k string, ts timestamp_ntz")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = nearest(facts, points, "k", "ts", "v", "tie")
        got = {r["id"]: r["near_v"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    right = np.minimum(np.searchsorted(at, asked), len(at) - 1)
    left = np.maximum(right - 1, 0)
    want = np.where(np.abs(at[left] - asked) <= np.abs(at[right] - asked), at[left], at[right])
    assert all(got[i] == want[i] for i in range(len(asked)))
