import datetime as dt
import random

import pytest

from acreledger.operators.schedule import depreciation_rows
from acreledger.plans import depreciation

COLUMNS = "guid string, Cost double, Sec_179 double, Method string, Years double, Date_in_Service timestamp"


def run(spark, *assets):
    df = spark.createDataFrame([(str(i), *a, dt.datetime(2020, 12, 27)) for i, a in enumerate(assets)], COLUMNS)
    out = {}
    for r in sorted(depreciation_rows(df).collect(), key=lambda r: (r["guid"], r["row_number"])):
        out.setdefault(int(r["guid"]), []).append(r)
    return out


def loop(cost, sec, method, term):
    """Amounts by repeated subtraction."""
    basis = left = cost - sec
    out, k = [], 0
    while left > 0.5:
        k += 1
        if method == "MO S/L":
            amount = basis / (term * 2)
        elif method == "HY 200DB":
            amount = left if k == term else left / term if k == 1 else 2 / term * left
        else:
            amount = round(basis / term, 2)
        out.append(amount)
        left -= amount
    return out


def test_known_schedules(spark):
    got = run(spark, (370.0, 0.0, "MO S/L", 5.0), (100000.0, 0.0, "HY 200DB", 7.0), (100.0, 0.0, "S/L", 3.0))
    assert [round(-r["amt"], 2) for r in got[0]] == [37.0] * 10
    assert [round(-r["amt"], 2) for r in got[1]] == [14285.71, 24489.8, 17492.71, 12494.79, 8924.85, 6374.89, 15937.24]
    assert [round(-r["amt"], 2) for r in got[2]] == [33.33] * 3


def test_dates_follow_chained_months(spark):
    got = run(spark, (370.0, 0.0, "MO S/L", 2.0), (90.0, 0.0, "S/L", 3.0))
    assert [r["post_date"].isoformat() for r in got[0]] == ["2020-12-31", "2021-06-30", "2021-12-30", "2022-06-30"]
    assert [r["post_date"].isoformat() for r in got[1]] == ["2020-12-31", "2021-12-31", "2022-12-31"]


def test_section_179_first(spark):
    got = run(spark, (420.0, 50.0, "MO S/L", 5.0), (50.0, 50.0, "S/L", 5.0))
    assert (got[0][0]["amt"], got[0][0]["depreciation_code"], got[0][0]["description"]) == (-50.0, "801", "Section 179")
    assert len(got[0]) == 11 and len(got[1]) == 1


def test_endless_schedules_are_flagged(spark):
    got = run(spark, (1.0, 0.0, "S/L", 300.0), (10.0, 0.0, "MO S/L", -1.0), (10.0, 1.0, "S/L", 0.0))
    assert all(len(rows) == 1 and rows[0]["endless"] for rows in got.values())
    assert got[0][0]["amt"] is None and got[2][0]["amt"] == -1.0


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_loop(spark, seed):
    rng = random.Random(seed)
    assets = []
    for _ in range(60):
        method = rng.choice(["MO S/L", "HY 200DB", "S/L"])
        term = rng.choice([1.0, 2.0, 3.0, 5.0, 7.0, 15.0, 2.5, 4.5, 1.5])
        assets.append((rng.randint(60, 900000) / 100 + 0.03, float(rng.choice([0, 10])), method, term))
    got = run(spark, *assets)
    for i, (cost, sec, method, term) in enumerate(assets):
        want = loop(cost, sec, method, term)
        amounts = [-r["amt"] for r in got.get(i, []) if r["row_number"] > 0]
        assert amounts == pytest.approx(want, abs=0.011), (cost, sec, method, term)


NOTE = '[Depreciation]\nCost = 420.00\nSec_179 = 50.00\nDepreciation_Type = "Other"\nMethod = "MO S/L"\nYears = 5\nDate_in_Service = 2020-12-31T23:00:00.000000-06:00\n'


def test_transactions_from_notes(ledger_of):
    notes = {"a": NOTE, "b": "[Depreciation\nbroken", "c": "nothing here", "d": '[Depreciation]\nCost = 10\n'}
    ledger = ledger_of(
        accounts=[{"guid": g, "name": f"Asset {g}", "account_type": "ASSET", "code": "15", "description": "machine"} for g in notes],
        slots=[{"obj_guid": g, "name": "notes", "slot_type": 4, "string_val": t} for g, t in notes.items()],
    )
    assets = {r["guid"]: r for r in depreciation.depreciable_assets(ledger).collect()}
    assert set(assets) == {"a", "b", "d"} and assets["b"]["Cost"] is None and assets["d"]["Years"] is None
    assert assets["a"]["Date_in_Service"] == dt.datetime(2020, 12, 31, 23, 0), "wall time as written"
    rows = depreciation.depreciation_transactions(ledger, 2021).collect()
    assert len(rows) == 2 and {r["account_code"] for r in rows} == {"800"}
    assert {(r["src_name"], r["account_desc"], float(r["amt"])) for r in rows} == {("Asset a", "machine", -37.0)}
    again = depreciation.depreciation_transactions(ledger, 2021).collect()
    assert {r["split_guid"] for r in rows} == {r["split_guid"] for r in again}
