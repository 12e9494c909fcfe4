import datetime as dt

import pytest

from acreledger.operators.entries import link_slots
from acreledger.plans import cash, invoices, production, tax

from .conftest import values

NOTE = "[Vendor_Details]\nReceive_1099 = true\nCorn = 30\nSoybeans = 40\nMax = 300\nMin = 200\n"
DAY = dt.datetime(2024, 3, 5)
ACCOUNTS = [
    {"guid": "corn", "name": "Corn stock", "account_type": "ASSET", "code": "133a"},
    {"guid": "fee", "name": "Drying", "account_type": "EXPENSE", "code": "520"},
    {"guid": "harvest", "name": "Corn sales", "account_type": "INCOME", "code": "301c"},
    {"guid": "rent", "name": "Corn rent", "account_type": "EXPENSE", "code": "424b"},
    {"guid": "beanrent", "name": "Soybeans rent", "account_type": "EXPENSE", "code": "424c"},
    {"guid": "shed", "name": "Shed", "account_type": "ASSET", "code": "151"},
    {"guid": "bank", "name": "Bank", "account_type": "BANK", "code": "100"},
]


def head(guid, owner, billto=None, when=DAY):
    return {"guid": guid, "id": f"N{guid}", "date_opened": when, "date_posted": when, "owner_guid": owner,
            "billto_guid": billto, "post_txn": f"t{guid}", "post_lot": f"l{guid}"}


def line(guid, head_guid, account, quantity, price, bill=False, action="Material", discount=0):
    side = {"bill": head_guid, "b_acct": account, "b_price_num": price, "b_price_denom": 100, "b_paytype": 1} if bill else {
        "invoice": head_guid, "i_acct": account, "i_price_num": price, "i_price_denom": 100, "i_discount_num": discount, "i_discount_denom": 100}
    return {"guid": guid, "description": guid, "action": action, "quantity_num": quantity * 100, "quantity_denom": 100, **side}


def due(guid):
    return {"obj_guid": f"t{guid}", "name": "trans-date-due", "slot_type": 6, "timespec_val": DAY}


def pay(n, lot, cents):
    return {"guid": f"p{n}", "tx_guid": f"t{lot}", "account_guid": "bank", "action": "Payment", "lot_guid": f"l{lot}",
            "value_num": cents, "value_denom": 100, "quantity_num": cents, "quantity_denom": 100}


@pytest.fixture
def ledger(ledger_of):
    owners = {"jobs": [{"guid": "jc", "id": "op1", "name": "North", "owner_guid": "cust"}, {"guid": "jv", "id": "v1", "name": "Landlord job", "owner_guid": "vend"},
                       {"guid": "jo", "id": "op1", "name": "North", "owner_guid": "cust"}, {"guid": "js", "id": "op2", "name": "South", "owner_guid": "cust"}],
              "vendors": [{"guid": "vend", "id": "7", "name": "Landlord", "notes": NOTE + "# 1099", "addr_addr1": "a", "addr_addr2": "b", "addr_addr3": "c"}],
              "customers": [{"guid": "cust", "name": "Elevator"}]}
    contracts = ["paid", "short2", "short3", "none", "nodue"]
    heads = [head(c, "jc") for c in contracts] + [head("bill", "jv", "jo"), head("bill2", "jv", "js"), head("old", "jc", when=dt.datetime(2023, 1, 1)),
             head("lost", "nobody"), head("yield", "jc"), head("cap", "jc")]
    lines = [line(f"e{c}", c, "corn", 100, 450, discount=500) for c in contracts] + [line("fpaid", "paid", "fee", 1, -2000)]
    lines += [line("r1", "bill", "rent", 10, 20050, True, "Project"), line("r2", "bill", "rent", 3, 100, True, "Hours"),
              line("r3", "bill2", "beanrent", 4, 10000, True, "Project"), line("y1", "yield", "harvest", 1810, 1),
              line("k1", "cap", "shed", 1, 5), line("o1", "old", "corn", 5, 100), line("z1", "lost", "corn", 5, 100)]
    slots = [due(c) for c in contracts if c != "nodue"] + [due("paid"), {"obj_guid": "cap", "name": "assoc_uri", "slot_type": 4, "string_val": "app://id=77"}]
    splits = [pay(1, "paid", -42500), pay(2, "short2", -44498), pay(3, "short3", -44497)]
    prices = [{"guid": "q", "commodity_guid": "c", "currency_guid": "USD", "date": DAY, "type": "bid", "value_num": 500, "value_denom": 100}]
    return ledger_of(accounts=ACCOUNTS, invoices=heads, entries=lines, slots=slots, splits=splits, prices=prices,
                     commodities=[{"guid": "c", "fullname": "Corn"}], **owners)


def test_union_of_bills_and_invoices(ledger):
    lines = invoices.invoice_lines(ledger)
    assert len(lines.columns) == 34
    got = {r["entry_guid"]: r for r in lines.collect()}
    assert "z1" not in got, "no owner, no line"
    assert lines.count() == len(got) == 12, "a repeated due-date slot gives no second row"
    assert (got["r1"]["inv_type"], got["r1"]["operation"], got["r1"]["org_name"]) == ("BILL", "North", "Landlord")
    assert (got["y1"]["inv_type"], got["y1"]["operation_id"], got["y1"]["org_name"]) == ("INVOICE", "op1", "Elevator")
    assert float(got["r1"]["amt"]) == 2005.0 and got["r1"]["paytype"] == "1" and got["y1"]["paytype"] == "0"
    assert invoices.invoice_lines(ledger, 2023).count() == 1


def test_contract_status(ledger):
    status = invoices.contract_status(ledger, 2024)
    got = {r["Contract ID"]: r for r in status.collect()}
    assert set(got) == {"Npaid", "Nshort2", "Nshort3", "Nnone"}, "no due date: dropped"
    assert {k: v["Fulfilled"] for k, v in got.items()} == {"Npaid": True, "Nshort2": True, "Nshort3": False, "Nnone": False}
    assert float(got["Npaid"]["Amount"]) == 445.0 and float(got["Npaid"]["Price"]) == 4.45
    assert values(invoices.open_bushels(status)) == [("Corn", 200.0)]


def test_capital_documents(ledger):
    assert values(invoices.capital_documents(ledger, "app://id=", 2024)) == [("Ncap", "app://id=77", "77")]


def test_rent_yield_and_lease(ledger):
    rent = {r["operation_id"]: r for r in production.rented_acres(ledger, 2024).collect()}
    assert float(rent["op1"]["acres"]) == 10 and float(rent["op1"]["base_rent"]) == 201 and rent["op2"]["crop"] == "Soybeans"
    grown = production.production(ledger, 2024).collect()
    assert [(r["crop"], float(r["total_bushels"]), float(r["bu_per_acre"])) for r in grown] == [("Corn", 1810.0, 181.0)]
    lease = {r["Field"]: r for r in production.flexible_lease(ledger, 2024).collect()}
    north = {k: float(v) for k, v in lease["North"].asDict().items() if k not in ("Crop", "Field", "Owner")}
    assert north["Revenue"] == 905.0 and north["Raw Bonus"] == 905 * 10 * 0.3 - 2010 == 705.0
    assert north["Capped Bonus"] == 3000 - 2010 == 990.0 and north["Bonus"] == 705.0 and north["Adjusted Rent"] == 271.0
    assert lease["South"]["Price"] is None and float(lease["South"]["Bonus"]) == 1200 - 400, "no price: the cap decides"


def test_vendor_1099(ledger):
    got = values(tax.vendor_1099(ledger, 2024), "finpack_account", "vendor_name", "amt")
    assert got == [("Corn rent", "Landlord", 2008.0), ("Soybeans rent", "Landlord", 400.0)]


def test_quantity_joins_in_its_year(ledger_of, ledger):
    base = {k: ledger.table(k) for k in ("invoices", "entries", "jobs", "vendors", "customers", "slots")}
    books = ledger_of(
        accounts=ACCOUNTS,
        transactions=[{"guid": "tyield", "post_date": DAY}, {"guid": "tbill", "post_date": dt.datetime(2025, 1, 1)}],
        splits=[pay(1, "yield", 100) | {"action": ""}, pay(2, "yield", -100) | {"action": "", "account_guid": "harvest"},
                pay(3, "bill", 100) | {"action": ""}, pay(4, "bill", -100) | {"action": "", "account_guid": "rent"}],
    )
    merged = type(books)(lambda n: base[n] if n in base else books.table(n))
    every = {r[0]: r[1] for r in values(cash.cleaned_cash_transactions(merged), "account_guid", "quantity")}
    assert every == {"harvest": 1810.0, "rent": 13.0}
    assert values(cash.cleaned_cash_transactions(merged, [2025]), "account_guid", "quantity") == [("rent", 0.0)]
    assert values(cash.farm_flows(merged, quantity=True), "account_guid", "quantity") == [("rent", 13.0)]


def test_tax_extracts(ledger_of):
    accounts = [{"guid": "phone", "name": "Phone", "account_type": "EXPENSE", "code": "50%"}, {"guid": "loan", "name": "LOAN interest", "account_type": "EXPENSE", "code": "x"},
                {"guid": "wage", "name": "Wages", "account_type": "EXPENSE", "code": "541"}, {"guid": "fed", "name": "Deposit", "account_type": "EXPENSE", "code": "510"}]
    heads = [{"guid": "a", "post_date": DAY, "description": "JANE doe"}, {"guid": "b", "post_date": dt.datetime(2023, 1, 1), "description": "jane doe"}]
    legs = [{"guid": f"{t}{a}", "tx_guid": t, "account_guid": a, "memo": "FICA", "value_num": 1005, "value_denom": 100, "quantity_num": 0, "quantity_denom": 1}
            for t in "ab" for a in ("phone", "loan", "wage", "fed")]
    slots = [{"obj_guid": "phone", "name": "tax-related", "slot_type": 4, "string_val": "true"}, {"obj_guid": "loan", "name": "tax-related", "slot_type": 4, "string_val": "false"}]
    staff = [{"id": "1", "addr_name": "Jane D%", "addr_addr1": "x", "addr_addr2": "y"}]
    ledger = ledger_of(accounts=accounts, transactions=heads, splits=legs, slots=slots, employees=staff)
    assert values(tax.deductible_expenses(ledger, 2024)) == [("Phone", 10.05, 50.0, 5.03)]
    sheets = tax.interest_payments(ledger, 2024)
    assert values(sheets["Totals"]) == [("JANE doe", 10.05)] and sheets["Detail"].count() == 1
    wages = tax.wage_reports(ledger, 2024)
    assert values(wages["Monthly_Withholding"]) == [(3, "FICA", 10.05)]
    assert values(wages["W2_Wage_Totals"], "code", "emp_id", "amt") == [("541", "1", 10.05)]
    assert values(wages["Labor_Deposits"]) == [("Deposit", DAY.date(), 10.05)] and wages["Transactions"].count() == 1


def test_link_slots_need_a_note(spark):
    tx = spark.createDataFrame([("g1", "12"), ("g2", "13"), (None, "14")], "guid string, num string")
    notes = spark.createDataFrame([("n1", "Scale Ticket 12"), ("n2", "Scale Ticket 14"), ("n3", "Other")], "id string, title string")
    assert values(link_slots(tx, notes, "u:"), "obj_guid", "string_val", "slot_type") == [("g1", "u:n1", 4)]


def test_machine_yield(spark):
    rows = [("F", "Corn", "v", "15.0", 10.0, 2000.0, DAY), ("F", "Corn", "w", "17", 5.0, 900.0, DAY), ("F", "Corn", "---", "1", 5.0, 900.0, DAY),
            ("F", "Corn", "v", "---", 5.0, 900.0, DAY), ("G", "Soybeans", "v", "9", 0.0, 1.0, DAY), ("X", "Corn", "v", "9", 1.0, 1.0, DAY)]
    from acreledger.sources.schema import MACHINE_YIELD

    machine = production.machine_yield(spark.createDataFrame(rows, MACHINE_YIELD), ["X"])
    assert values(machine, "Farm", "Harvested", "Dry_Yield", "Moisture") == [("F", 15.0, 2900.0, 16.0), ("G", 0.0, 1.0, 9.0)]
    grown = spark.createDataFrame([("Corn", "F", "1", 2500.0, 20.0)], "crop string, operation string, operation_id string, total_bushels double, acres double")
    both = {r["Farm"]: r for r in production.production_vs_machine(machine, grown).collect()}
    assert both["F"]["New Bushels"] == 400.0 and both["F"]["Bu/Total Acres"] == 125.0
    assert both["G"]["Bushels"] == 0.0 and both["G"]["Bu/Acres Worked"] is None


def test_invoice_report_scans_the_entries_once(spark):
    from acreledger.plans import invoices
    from acreledger.sources.star import star_ledger

    plan = invoices._lines(star_ledger(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
