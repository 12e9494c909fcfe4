"""Intervals of the account tree against plain recursion."""

import random

from pyspark.sql import functions as F

from acreledger.operators import order, tour, tree

from .conftest import values
from .test_tree import accounts, chain


def brute(rows):
    """Guid -> its ancestors, nearest first; None on or below a cycle."""
    up = {r["guid"]: r["parent_guid"] for r in rows}
    found = {}
    for guid in up:
        path, at = [], up[guid]
        while at in up and len(path) <= len(up):
            path.append(at)
            at = up[at]
        found[guid] = path if len(path) <= len(up) else None
    return found


def forest(n, seed):
    rng = random.Random(seed)
    rows = [{"guid": f"g{i}", "name": f"N{rng.randrange(9)}", "parent_guid": f"g{rng.randrange(i)}" if i and rng.random() < 0.95 else None}
            for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_running_sums_do_not_depend_on_ranges(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    for per_range in (37, 5000):
        got = order.running_total(df, ["k"], F.col("k"), "upto", per_range)
        assert values(got) == sorted(((k, k * (k + 1) // 2) for k in range(1000)), key=str)
    assert order.row_numbers(df.where("k < 0"), ["k"], "n").count() == 0


def test_places_nest_like_the_tree(ledger_of):
    for rows in (accounts(), forest(120, 1)):
        above = brute(rows)
        df = ledger_of(accounts=rows).accounts
        at = {r["guid"]: (r["enter"], r["leave"]) for r in tour.tour(df, per_range=17).collect()}
        parents = {p for path in above.values() if path for p in path}
        assert set(at) == parents, "only inner nodes that a tour reaches"
        assert sorted(p for pair in at.values() for p in pair) == list(range(1, 2 * len(at) + 1))
        for inner in at:
            for outer in at:
                within = at[outer][0] <= at[inner][0] <= at[outer][1]
                assert within == (inner == outer or outer in above[inner])


def test_term_and_totals_of_a_forest(ledger_of, spark):
    for rows in (accounts(), forest(200, 2)):
        above, names = brute(rows), {r["guid"]: r["name"] for r in rows}
        df = ledger_of(accounts=rows).accounts
        hits = {g for g in names if names[g] in ("N3", "Current", "Pong")}
        want = {g for g in names if g in hits or (above[g] and hits & set(above[g]))}
        got = tour.accounts_below(df, F.col("name").isin("N3", "Current", "Pong"), per_range=23)
        assert got.columns == df.columns
        assert {r["guid"] for r in got.collect()} == want and got.count() == len(want)
        amounts = [(g, i * 10**6) for i, g in enumerate(names)] + [(g, 1) for g in names] + [("nobody", 5)]
        own = {g: i * 10**6 + 1 for i, g in enumerate(names)}
        total = dict(own)
        for g, path in above.items():
            for p in path or []:
                total[p] += own[g]
        out = tour.subtree_totals(df, spark.createDataFrame(amounts, "guid string, v bigint"), "v", per_range=23)
        assert {r["guid"]: r["total"] for r in out.collect()} == total


def test_a_deep_chain_and_no_accounts(ledger_of, spark):
    df = ledger_of(accounts=chain(1000)).accounts
    places = tour.tour(df).collect()
    assert len(places) == 999 and {(r["enter"], r["leave"]) for r in places} == {(i, 1999 - i) for i in range(1, 1000)}
    none = ledger_of().accounts
    assert tour.tour(none).count() == 0
    assert tour.accounts_below(none, F.lit(True)).count() == 0
    empty = spark.createDataFrame([], "guid string, v bigint")
    assert tour.subtree_totals(none, empty, "v").count() == 0


def test_a_star_of_a_million_leaves(spark):
    leaves = spark.range(1_000_000).select(F.concat(F.lit("l"), "id").alias("guid"), F.lit("Leaf").alias("name"), F.lit("top").alias("parent_guid"))
    top = spark.createDataFrame([("top", "Top", None)], "guid string, name string, parent_guid string")
    star = leaves.unionByName(top)
    places = tour.tour(star)
    assert values(places) == [("top", 1, 2)]
    assert tour.accounts_below(star, F.col("name") == "Top", places).count() == 1_000_001
    sums = tour.subtree_totals(star, star.select("guid", F.lit(2).alias("v")), "v", places)
    assert sums.where("guid = 'top'").first()["total"] == 2_000_002
    assert sums.where("guid <> 'top' and total = 2").count() == 1_000_000


def test_same_accounts_as_the_path_text(ledger_of):
    df = ledger_of(accounts=accounts()).accounts
    by_text = tree.accounts_matching(tree.with_paths(df), "Harvested|Ping")
    by_place = tour.accounts_below(df, F.col("name").rlike("Harvested|Ping"))
    assert values(by_text, "guid") == [("d",), ("e",), ("f",), ("p",)]
    assert {r["guid"] for r in by_place.collect()} == {"d", "e", "f", "p"}
