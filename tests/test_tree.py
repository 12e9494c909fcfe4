from acreledger.operators import tree

from .conftest import values


def accounts():
    rows = [("root", "Root", None), ("a", "Assets", "root"), ("b", "Current", "a"), ("c", "Grain", "b"),
            ("d", "Harvested", "c"), ("e", "Corn", "d"), ("f", "Soybeans", "d"),
            ("x", "Lost", "nowhere"), ("u", None, "a"), ("v", "Below", "u"),
            ("p", "Ping", "q"), ("q", "Pong", "p"), ("r", "Leaf", "p")]
    return [{"guid": g, "name": n, "parent_guid": p, "account_type": "ASSET", "commodity_guid": "k"} for g, n, p in rows]


def test_paths_levels_and_cycles(ledger_of):
    out = tree.with_paths(ledger_of(accounts=accounts()).accounts, level=4)
    got = {r["guid"]: (r["parent_accounts"], r["finpack_account"], r["path_closed"]) for r in out.collect()}
    assert got["root"] == ("", "Root", True)
    assert got["e"] == ("Harvested>Grain>Current>Assets>Root", "Grain", True)
    assert got["d"] == ("Grain>Current>Assets>Root", "Grain", True)
    assert got["c"] == ("Current>Assets>Root", "Grain", True)
    assert got["x"] == ("", "Lost", True)
    assert got["v"] == ("Assets>Root", "Below", True), "a node without a name is skipped"
    for guid in "pqr":
        assert got[guid][0] is None and got[guid][2] is False
    assert len(got) == 13


def test_crop_of_name_wins(ledger_of):
    ledger = ledger_of(accounts=accounts())
    got = {r["guid"]: r["crop"] for r in tree.all_accounts(ledger, ["Corn", "Harvested"]).collect()}
    assert got["e"] == "Corn" and got["f"] == "Harvested" and got["a"] == "General"
    assert tree.all_accounts(ledger, ["Corn", "Harvested"]) is tree.all_accounts(ledger, ["Corn", "Harvested"])


def test_term_search_is_once_per_account(ledger_of):
    located = tree.with_paths(ledger_of(accounts=accounts()).accounts)
    assert values(tree.accounts_matching(located, "Harvested"), "guid") == [("d",), ("e",), ("f",)]
    one = tree.one_account_per_commodity(tree.accounts_matching(located, "Harvested"), "from_guid")
    assert values(one) == [("k", "d", 3)]


def test_notes_by_attribute(ledger_of):
    ledger = ledger_of(
        accounts=accounts(),
        slots=[{"obj_guid": "e", "name": "notes", "slot_type": 4, "string_val": "hello"},
               {"obj_guid": "f", "name": "notes", "slot_type": 3, "string_val": "wrong kind"}],
    )
    got = {r["guid"]: r["account_notes"] for r in tree.all_accounts(ledger, ["Corn"], with_notes=True).collect()}
    assert got["e"] == "hello" and got["f"] is None and len(got) == 13


def chain(n, top=None):
    return [{"guid": f"n{i}", "name": f"N{i}", "parent_guid": f"n{i - 1}" if i else top} for i in range(n)]


def test_deep_chains_and_a_cycle(ledger_of):
    deep = chain(1000)
    loop = [{"guid": f"c{i}", "name": f"C{i}", "parent_guid": f"c{(i + 1) % 3}"} for i in range(3)]
    under = [{"guid": f"u{i}", "name": f"U{i}", "parent_guid": f"u{i - 1}" if i else "c0"} for i in range(100)]
    out = tree.with_paths(ledger_of(accounts=deep + loop + under).accounts, level=4)
    got = {r["guid"]: (r["parent_accounts"], r["finpack_account"], r["path_closed"]) for r in out.collect()}
    for n in (70, 100, 999):
        assert got[f"n{n}"] == (">".join(f"N{i}" for i in reversed(range(n))), "N3", True)
    assert all(got[g] == (None, g.upper(), False) for g in ["c0", "c2", "u0", "u99"]) and len(got) == 1103
