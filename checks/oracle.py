"""SQL counterparts of the registered queries, over the same given tables.

Each text is one SELECT with the ledger views it needs as common table
expressions.  Money is summed as integer cents, so results are exact.
"""

from __future__ import annotations

import re

from acreledger.functions.text import STATEMENT_REWRITES
from acreledger.plans.chart import CASH_TYPES
from acreledger.sources.star import CROP_WORDS, STAGES, URI_PREFIX

from .queries import DISCOUNTS, DOCUMENT_PREFIX, ENTERED, LEVEL, PRICE_YEAR, SHARES, YEAR, YEARS, statement_shops


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


CASH = in_list(CASH_TYPES)
UNIQUE = "CAST(l_orderkey AS varchar), CAST(l_linenumber AS varchar), CAST(l_partkey AS varchar), CAST(l_suppkey AS varchar), CAST(net_c AS varchar), CAST(qty_c AS varchar)"


def half_up(n: str, d: str, digits: int = 2) -> str:
    """``n/d`` of integers rounded half away from zero to ``digits``; d > 0 or null result."""
    scale = 10**digits
    return (
        f"CAST(sign({n}) * ((2 * abs(CAST({n} AS HUGEINT)) * {scale} + ({d})) // nullif(2 * ({d}), 0)) AS DOUBLE) / {scale}"
    )


def money(total: str, denom: int = 100) -> str:
    return f"CAST(coalesce({total}, 0) AS DOUBLE) / {denom}"


def number_text(value: str) -> str:
    fixed = f"rtrim(CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,12)) AS VARCHAR), '0')"
    return f"CASE WHEN {fixed} LIKE '%.' THEN {fixed} || '0' ELSE {fixed} END"


def crop_case(column: str, otherwise: str) -> str:
    arms = " ".join(f"WHEN {column} LIKE '%{c}%' THEN '{c}'" for c in reversed(CROP_WORDS))
    return f"CASE {arms} ELSE {otherwise} END"


def farm_case(column: str, rules: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {test} THEN '{value}'" for test, value in rules.items())
    return f"CASE {arms} ELSE {column} END"


SHARE_LINES = "\\n".join(f"{c} = {30 + 5 * i}" for i, c in enumerate(CROP_WORDS))

VIEWS: dict[str, str] = {}

VIEWS["l_accounts"] = """
SELECT 'root' AS guid, 'Root Account' AS name, 'ROOT' AS account_type, CAST(NULL AS varchar) AS parent_guid, '' AS code, CAST(NULL AS varchar) AS commodity_guid, CAST(NULL AS varchar) AS description
UNION ALL SELECT 'r' || CAST(r_regionkey AS varchar), r_name, 'ASSET', 'root', '', NULL, NULL FROM region
UNION ALL SELECT 'n' || CAST(n_nationkey AS varchar), n_name, 'ASSET', 'r' || CAST(n_regionkey AS varchar), '', NULL, NULL FROM nation
UNION ALL SELECT 'c' || CAST(c_custkey AS varchar), c_name,
  CASE c_custkey % 5 WHEN 0 THEN 'BANK' WHEN 1 THEN 'CASH' WHEN 2 THEN 'RECEIVABLE' WHEN 3 THEN 'CREDIT' ELSE 'ASSET' END,
  'n' || CAST(c_nationkey AS varchar), '1' || CAST(c_custkey AS varchar), NULL, NULL FROM customer
UNION ALL SELECT 's' || CAST(s_suppkey AS varchar), s_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'PAYABLE' WHEN 1 THEN 'LIABILITY' ELSE 'EXPENSE' END,
  'n' || CAST(s_nationkey AS varchar), '2' || CAST(s_suppkey AS varchar), NULL, NULL FROM supplier
UNION ALL SELECT DISTINCT 'k' || p_type, p_type, 'ASSET', 'root', '', CAST(NULL AS varchar), CAST(NULL AS varchar) FROM part
UNION ALL SELECT 'p' || CAST(p_partkey AS varchar), p_name,
  CASE p_partkey % 3 WHEN 0 THEN 'INCOME' WHEN 1 THEN 'EXPENSE' ELSE 'STOCK' END, 'k' || p_type,
  CASE p_partkey % 8 WHEN 0 THEN '133' WHEN 1 THEN '134' WHEN 2 THEN '146' WHEN 3 THEN '301c' WHEN 4 THEN '303b' WHEN 5 THEN '424b' WHEN 6 THEN '900' ELSE '543' END,
  CASE p_partkey % 5 WHEN 0 THEN 'view' WHEN 1 THEN 'click' WHEN 2 THEN 'purchase' WHEN 3 THEN 'signup' ELSE 'error' END,
  CASE (p_partkey // 3) % 3 WHEN 0 THEN 'Contracted ' WHEN 1 THEN 'Delivered ' ELSE 'Harvested ' END || split_part(p_name, ' ', 2) FROM part"""

VIEWS["l_transactions"] = """
SELECT 't' || CAST(o_orderkey AS varchar) AS guid, CAST(o_orderkey AS varchar) AS num, o_orderdate AS post_date, o_orderpriority AS description FROM orders"""

VIEWS["l_legs"] = """
SELECT l.*, o.o_custkey, CAST(round(l_extendedprice * 100) AS bigint) AS net_c, CAST(round(l_extendedprice * l_tax * 100) AS bigint) AS tax_c, CAST(round(l_quantity * 100) AS bigint) AS qty_c,
  CASE l_returnflag WHEN 'R' THEN 'Payment' WHEN 'A' THEN 'Invoice' ELSE 'Bill' END AS act
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""

VIEWS["l_splits"] = f"""
SELECT md5(concat_ws('|', {UNIQUE}, leg)) AS guid, 't' || CAST(l_orderkey AS varchar) AS tx_guid, account_guid, act AS action,
  'line ' || CAST(l_linenumber AS varchar) AS memo, l_shipdate AS reconcile_date, value_num, quantity_num,
  CASE WHEN l_returnflag = 'R' THEN 'l' || CAST(l_orderkey AS varchar) END AS lot_guid
FROM (SELECT *, 'C' AS leg, 'c' || CAST(o_custkey AS varchar) AS account_guid, net_c + tax_c AS value_num, net_c + tax_c AS quantity_num FROM l_legs
 UNION ALL SELECT *, 'P', 'p' || CAST(l_partkey AS varchar), -net_c, -qty_c FROM l_legs
 UNION ALL SELECT *, 'S', 's' || CAST(l_suppkey AS varchar), -tax_c, -tax_c FROM l_legs) q"""

VIEWS["l_prices"] = """
SELECT 'e' || CAST(event_id AS varchar) AS guid, event_type AS commodity_guid, 'USD' AS currency_guid, ts AS date,
  CASE WHEN user_id % 3 <> 0 THEN 'bid' ELSE 'ask' END AS type, CAST(round(value * 100) AS bigint) AS value_num, 100 AS value_denom FROM events"""

VIEWS["l_commodities"] = """
SELECT DISTINCT event_type AS guid, CASE event_type WHEN 'view' THEN 'ring' WHEN 'click' THEN 'widget' WHEN 'purchase' THEN 'gear' WHEN 'signup' THEN 'bolt' ELSE 'plate' END AS fullname FROM events"""

VIEWS["l_bids"] = f"""
SELECT p.guid, p.commodity_guid, p.currency_guid, p.date, c.fullname AS crop, p.value_num FROM l_prices p JOIN l_commodities c ON c.guid = p.commodity_guid
WHERE p.type = 'bid' AND year(p.date) = {PRICE_YEAR}"""

VIEWS["l_mean_bid"] = """
SELECT commodity_guid, crop, currency_guid, CAST(sum(value_num) AS DOUBLE) / 100 / count(*) AS cash FROM l_bids GROUP BY ALL"""

VIEWS["l_last_bid"] = """
SELECT commodity_guid, crop, currency_guid, value_num AS cash_c FROM l_bids
QUALIFY row_number() OVER (PARTITION BY commodity_guid, crop, currency_guid ORDER BY date DESC, guid DESC) = 1"""

VIEWS["l_jobs"] = """
SELECT 'jc' || CAST(c_custkey AS varchar) AS guid, c_name AS name, CAST(c_custkey AS varchar) AS id, 'c' || CAST(c_custkey AS varchar) AS owner_guid FROM customer
UNION ALL SELECT 'js' || CAST(s_suppkey AS varchar), s_name, CAST(s_suppkey AS varchar), 's' || CAST(s_suppkey AS varchar) FROM supplier"""

VIEWS["l_vendors"] = f"""
SELECT 's' || CAST(s_suppkey AS varchar) AS guid, CAST(s_suppkey AS varchar) AS id, s_name AS name, s_suppkey,
  CASE WHEN s_suppkey % 2 = 0 THEN E'[Vendor_Details]\\n# 1099 wanted\\nReceive_1099 = true\\n{SHARE_LINES}\\nMax = ' || CAST(s_suppkey % 7 * 10000 + 20000 AS varchar) || E'\\nMin = 200\\n' ELSE 'plain vendor' END AS notes,
  'Street ' || CAST(s_suppkey AS varchar) AS addr_addr1, 'Nation ' || CAST(s_nationkey AS varchar) AS addr_addr2,
  CASE WHEN s_suppkey % 5 <> 0 THEN 'USA' END AS addr_addr3 FROM supplier"""

VIEWS["l_employees"] = """
SELECT DISTINCT 'E' || o_orderpriority[1] AS id,
  CASE o_orderpriority[1] WHEN '1' THEN '1-%' WHEN '2' THEN '%HIGH' WHEN '3' THEN '3_med%um' ELSE lower(o_orderpriority) END AS addr_name,
  'Road ' || o_orderpriority[1] AS addr_addr1, CASE WHEN o_orderpriority[1] <> '4' THEN 'Town' END AS addr_addr2 FROM orders"""

VIEWS["l_invoices"] = """
SELECT 'i' || CAST(o_orderkey AS varchar) AS guid, 'N' || CAST(o_orderkey AS varchar) AS id, o_orderdate AS date_opened, o_orderdate + INTERVAL 10 DAY AS date_posted,
  'jc' || CAST(o_custkey AS varchar) AS owner_guid, CAST(NULL AS varchar) AS billto_guid, 't' || CAST(o_orderkey AS varchar) AS post_txn, 'l' || CAST(o_orderkey AS varchar) AS post_lot FROM orders
UNION ALL SELECT DISTINCT 'i' || CAST(o_orderkey AS varchar) || '_' || CAST(l_suppkey AS varchar), 'N' || CAST(o_orderkey AS varchar), o_orderdate, o_orderdate + INTERVAL 10 DAY,
  'js' || CAST(l_suppkey AS varchar), 'jc' || CAST(o_custkey AS varchar), 't' || CAST(o_orderkey AS varchar), 'l' || CAST(o_orderkey AS varchar)
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'"""

VIEWS["l_entries"] = f"""
SELECT md5(concat_ws('|', {UNIQUE})) AS guid, 'line ' || CAST(l_linenumber AS varchar) AS description,
  CASE WHEN l_returnflag <> 'R' THEN 'i' || CAST(l_orderkey AS varchar) END AS invoice, CASE WHEN l_returnflag = 'R' THEN 'i' || CAST(l_orderkey AS varchar) || '_' || CAST(l_suppkey AS varchar) END AS bill,
  'p' || CAST(l_partkey AS varchar) AS acct, CASE l_linenumber % 3 WHEN 0 THEN 'Project' WHEN 1 THEN 'Hours' ELSE 'Material' END AS action,
  qty_c AS quantity_num, CAST(round(net_c / (qty_c / CAST(100 AS double))) AS bigint) AS price_num, CAST(round(l_extendedprice * l_discount * 100) AS bigint) AS discount_num FROM l_legs"""

VIEWS["l_due"] = """
SELECT 't' || CAST(o_orderkey AS varchar) AS obj_guid, o_orderdate + INTERVAL 30 DAY AS due_date FROM orders WHERE o_orderkey % 4 <> 0"""

VIEWS["l_docs"] = f"""
SELECT 'i' || CAST(o_orderkey AS varchar) AS obj_guid, '{URI_PREFIX}' || md5(CAST(o_orderkey AS varchar)) AS linked_document FROM orders WHERE o_orderkey % 3 = 0"""

_LINE = """i.guid AS inv_guid, i.id AS inv_id, i.date_posted, i.date_opened, i.post_txn AS tx_guid, i.post_lot"""
VIEWS["l_lines"] = f"""
SELECT 'BILL' AS inv_type, {_LINE}, bt.id AS operation_id, bt.name AS operation, v.name AS org_name, v.notes AS org_notes,
  a.guid AS account_guid, a.code AS account_code, a.name AS account_name, e.guid AS entry_guid, e.description, e.quantity_num, e.price_num,
  e.action AS quantity_type, '1' AS paytype, '' AS disc_how, '' AS disc_type, 0 AS discount_num, due.due_date, doc.linked_document
FROM l_entries e JOIN l_accounts a ON a.guid = e.acct JOIN l_invoices i ON i.guid = e.bill JOIN l_jobs bt ON bt.guid = i.billto_guid
JOIN l_jobs oj ON oj.guid = i.owner_guid JOIN l_vendors v ON v.guid = oj.owner_guid
LEFT JOIN l_due due ON due.obj_guid = i.post_txn LEFT JOIN l_docs doc ON doc.obj_guid = i.guid
UNION SELECT 'INVOICE', {_LINE}, oj.id, oj.name, c.c_name, CAST(NULL AS varchar),
  a.guid, a.code, a.name, e.guid, e.description, e.quantity_num, e.price_num,
  e.action, '0', 'PRETAX', 'VALUE', e.discount_num, due.due_date, doc.linked_document
FROM l_entries e JOIN l_accounts a ON a.guid = e.acct JOIN l_invoices i ON i.guid = e.invoice
JOIN l_jobs oj ON oj.guid = i.owner_guid JOIN customer c ON 'c' || CAST(c.c_custkey AS varchar) = oj.owner_guid
LEFT JOIN l_due due ON due.obj_guid = i.post_txn LEFT JOIN l_docs doc ON doc.obj_guid = i.guid"""

VIEWS["l_year_lines"] = f"SELECT * FROM l_lines WHERE year(date_posted) = {YEAR}"

VIEWS["l_quantities"] = """
SELECT tx_guid, account_guid, year(date_posted) AS inv_year, sum(quantity_num) AS quantity_c FROM l_lines GROUP BY ALL"""

VIEWS["l_anc"] = """
SELECT guid, parent_guid AS anc, 1 AS depth FROM l_accounts WHERE parent_guid IS NOT NULL
UNION ALL SELECT l.guid, a.parent_guid, depth + 1 FROM l_anc l JOIN l_accounts a ON a.guid = l.anc WHERE a.parent_guid IS NOT NULL"""

VIEWS["l_names"] = "SELECT l.guid, list(p.name ORDER BY l.depth) AS names FROM l_anc l JOIN l_accounts p ON p.guid = l.anc GROUP BY l.guid"

VIEWS["l_paths"] = f"""
SELECT a.guid, a.name, coalesce(array_to_string(n.names, '>'), '') AS parent_accounts,
  CASE WHEN len(n.names) >= {LEVEL} THEN n.names[len(n.names) - {LEVEL} + 1] ELSE a.name END AS finpack_account,
  a.commodity_guid, a.description FROM l_accounts a LEFT JOIN l_names n ON n.guid = a.guid"""

VIEWS["l_crops"] = f"""
SELECT guid, name, parent_accounts, finpack_account, {crop_case("name", crop_case("parent_accounts", "'General'"))} AS crop FROM l_paths"""


def _counter(types: str, inverse: bool) -> str:
    src_where = f"WHERE account_type IN {types}" if inverse else ""
    main_where = "" if inverse else f"AND a.account_type IN {types}"
    sign = "-" if inverse else ""
    return f"""
SELECT s.guid AS split_guid, s.tx_guid, s.account_guid, a.account_type, a.name AS account_name, a.code AS account_code, a.description AS account_desc,
  a.commodity_guid, src.src_guid, src.src_code, src.src_type, src.src_name, t.post_date, t.description, s.memo, s.action, {sign}s.value_num AS amt_c, {sign}s.quantity_num AS qty_c
FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid JOIN l_transactions t ON t.guid = s.tx_guid
JOIN (SELECT DISTINCT tx_guid, x.guid AS src_guid, code AS src_code, account_type AS src_type, name AS src_name FROM l_splits JOIN l_accounts x ON x.guid = account_guid {src_where}) src
  ON src.tx_guid = s.tx_guid AND src.src_guid <> s.account_guid {main_where}"""


VIEWS["l_cash"] = _counter(CASH, True)
VIEWS["l_stock"] = _counter("('STOCK')", False)
VIEWS["l_categories"] = " UNION ALL ".join(
    f"SELECT '{name}' AS category, * FROM ({_counter(in_list(types), True)}) q"
    for name, types in {
        "Assets": ["ASSET"],
        "Cash": ["BANK", "CASH"],
        "Liabilities": ["LIABILITY", "CREDIT", "PAYABLE"],
    }.items()
)
VIEWS["l_clean"] = f"""
SELECT c.*, coalesce(q.quantity_c, 0) AS quantity_c, year(c.post_date) AS year FROM l_cash c
LEFT JOIN l_quantities q ON q.tx_guid = c.tx_guid AND q.account_guid = c.account_guid AND q.inv_year = year(c.post_date)
WHERE c.account_type NOT IN {CASH} AND c.action <> 'Payment'"""

def _farm(clean: str) -> str:
    return f"""
SELECT * EXCLUDE (account_code, account_type, account_name),
  {farm_case("account_code", {"account_code LIKE '133%'": "301c", "account_code LIKE '134%'": "303b"})} AS account_code,
  {farm_case("account_type", {"account_code LIKE '133%' OR account_code LIKE '134%'": "INCOME", "account_code LIKE '146%' OR account_code LIKE '147%'": "EXPENSE", "account_code LIKE '9%'": "NF EXPENSE"})} AS account_type,
  {farm_case("account_name", {"account_code LIKE '133%'": "Corn", "account_code LIKE '134%'": "Soybeans"})} AS account_name
FROM {clean} WHERE account_code NOT IN ('301c', '303b')"""


VIEWS["l_farm"] = _farm("l_clean")
# one year, cut before anything is joined
VIEWS["l_year_cash"] = f"SELECT * FROM l_cash WHERE year(post_date) = {YEAR} AND account_type NOT IN {CASH} AND action <> 'Payment'"
VIEWS["l_year_quantities"] = "SELECT tx_guid, account_guid, sum(quantity_num) AS quantity_c FROM l_year_lines GROUP BY ALL"
VIEWS["l_year_clean"] = """
SELECT c.*, coalesce(q.quantity_c, 0) AS quantity_c FROM l_year_cash c
LEFT JOIN l_year_quantities q ON q.tx_guid = c.tx_guid AND q.account_guid = c.account_guid"""
VIEWS["l_year_farm"] = _farm("l_year_clean")

VIEWS["l_assets"] = """
SELECT 'p' || CAST(p_partkey AS varchar) AS guid, p_name AS name, CAST(round(p_retailprice * 100) AS bigint) AS cost_c,
  CASE WHEN p_partkey % 20 = 0 THEN 5000 ELSE 0 END AS sec_c, CASE p_size % 3 WHEN 0 THEN 'MO S/L' WHEN 1 THEN 'HY 200DB' ELSE 'S/L' END AS method,
  p_size % 5 + 3 AS term, p_size % 6 + 1994 AS year FROM part"""

_STEP = f"""CASE method WHEN 'MO S/L' THEN basis / (term * 2) WHEN 'HY 200DB' THEN
  CASE WHEN k + 1 = term THEN remaining WHEN k = 0 THEN 1.0 / term * remaining ELSE 2.0 / term * remaining END
  ELSE {half_up("basis_c", "term * 100", 2)} END"""

VIEWS["l_fold"] = f"""
SELECT guid, method, term, year, basis_c, basis, 0 AS k, basis AS remaining, CAST(0 AS DOUBLE) AS amount FROM
  (SELECT *, cost_c - sec_c AS basis_c, CAST(cost_c - sec_c AS DOUBLE) / 100 AS basis FROM l_assets)
UNION ALL SELECT guid, method, term, year, basis_c, basis, k + 1, remaining - ({_STEP}), {_STEP} FROM l_fold WHERE remaining > 0.5"""

VIEWS["l_depreciation"] = """
SELECT guid, k AS row_number, CASE WHEN method <> 'MO S/L' OR k = 1 THEN make_date(CASE WHEN method = 'MO S/L' THEN year ELSE year + k - 1 END, 12, 31)
  WHEN k % 2 = 0 THEN make_date(year + k // 2, 6, 30) ELSE make_date(year + k // 2, 12, 30) END AS post_date,
  -amount AS amt, 'Regular Depreciation' AS description, '800' AS depreciation_code FROM l_fold WHERE k > 0
UNION ALL SELECT guid, 0, make_date(year, 12, 31), -CAST(sec_c AS DOUBLE) / 100, 'Section 179', '801' FROM l_assets WHERE sec_c > 0"""

_PATH_JOIN = "LEFT JOIN l_crops p ON p.guid = f.account_guid"

VIEWS["l_rented"] = f"""
SELECT c.crop, l.operation, l.operation_id, l.org_name, sum(quantity_num) AS acres_c, sum(quantity_num * price_num) AS amt_4
FROM l_year_lines l JOIN l_crops c ON c.guid = l.account_guid
WHERE account_code IN ('424b', '424c') AND quantity_type = 'Project' AND org_name IS NOT NULL GROUP BY ALL"""

VIEWS["l_rent"] = f"""
SELECT crop, operation, operation_id, org_name, acres_c, amt_4, {half_up("amt_4", "10000", 2)} AS amt,
  {half_up(f"CAST(round({half_up('amt_4', '10000', 2)} * 100) AS HUGEINT)", "acres_c", 0)} AS base_rent FROM l_rented"""

VIEWS["l_planted"] = "SELECT crop, operation, operation_id, sum(acres_c) AS acres_c FROM l_rented GROUP BY ALL"

VIEWS["l_production"] = f"""
SELECT b.*, p.acres_c, {half_up("b.bushels_c", "p.acres_c", 2)} AS bu_per_acre FROM
 (SELECT c.crop, l.operation, l.operation_id, sum(quantity_num) AS bushels_c FROM l_year_lines l JOIN l_crops c ON c.guid = l.account_guid
  WHERE account_code IN ('301c', '303b') GROUP BY ALL) b
LEFT JOIN l_planted p USING (crop, operation, operation_id)"""

VIEWS["l_terms"] = " UNION ".join(
    f"""SELECT l.operation_id, CAST(v.s_suppkey % 7 * 10000 + 20000 AS DOUBLE) AS max_rent, '{crop}' AS crop, CAST({30 + 5 * i} AS DOUBLE) AS pct
FROM l_year_lines l JOIN l_vendors v ON v.name = l.org_name WHERE l.inv_type = 'BILL' AND v.s_suppkey % 2 = 0"""
    for i, crop in enumerate(CROP_WORDS)
)

VIEWS["l_latest"] = """
SELECT a.description AS account_desc, max(t.post_date) AS post_date FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid
JOIN l_transactions t ON t.guid = s.tx_guid WHERE a.description IS NOT NULL GROUP BY 1"""

VIEWS["l_contracts"] = f"""
WITH lines AS (SELECT *, quantity_num * price_num - discount_num * 100 AS amount_4 FROM l_lines WHERE inv_type = 'INVOICE'),
grain AS (SELECT l.date_opened, l.date_posted, l.due_date, l.inv_id, c.crop, l.account_name, l.account_code, l.org_name, l.post_lot,
   sum(quantity_num) AS quantity_c, sum(amount_4) AS amount_4
  FROM lines l JOIN l_crops c ON c.guid = l.account_guid
  WHERE year(date_posted) = {YEAR} AND (account_code LIKE '133%' OR account_code LIKE '134%') AND due_date IS NOT NULL AND post_lot IS NOT NULL GROUP BY ALL),
disc AS (SELECT inv_id, sum(amount_4) AS discount_4 FROM lines WHERE NOT (account_code LIKE '133%' OR account_code LIKE '134%')
  AND inv_id IN (SELECT inv_id FROM lines WHERE year(date_posted) = {YEAR} AND (account_code LIKE '133%' OR account_code LIKE '134%')) GROUP BY 1),
paid AS (SELECT lot_guid, sum(value_num) AS payment_c FROM l_splits WHERE lot_guid IS NOT NULL AND action = 'Payment' GROUP BY 1)
SELECT g.*, coalesce(abs(amount_4 + coalesce(discount_4, 0) + payment_c * 100) <= 200, false) AS fulfilled
FROM grain g LEFT JOIN disc USING (inv_id) LEFT JOIN paid ON paid.lot_guid = g.post_lot"""

_BILL1099 = f"""
FROM l_invoices i JOIN l_jobs j ON i.owner_guid = j.guid JOIN l_entries e ON i.guid = e.bill JOIN l_vendors v ON v.guid = j.owner_guid
JOIN l_accounts a ON a.guid = e.acct WHERE v.notes LIKE '%1099%' AND year(i.date_posted) = {YEAR}"""

VIEWS["l_wages"] = f"""
SELECT CAST(t.post_date AS date) AS post_date, month(t.post_date) AS month, a.name, a.code, s.memo, s.value_num, e.id AS emp_id, e.addr_name AS emp_name,
  e.addr_addr1 AS emp_addr1, e.addr_addr2 AS emp_addr2
FROM l_transactions t JOIN l_employees e ON t.description ILIKE e.addr_name JOIN l_splits s ON s.tx_guid = t.guid JOIN l_accounts a ON a.guid = s.account_guid
WHERE a.code LIKE '54%' AND year(t.post_date) = {YEAR}"""

VIEWS["l_related"] = """
SELECT 's' || CAST(s_suppkey AS varchar) AS guid FROM supplier WHERE s_suppkey % 3 = 2 AND (s_suppkey % 2 = 0 OR s_suppkey % 4 = 1)"""

VIEWS["l_notes"] = """
SELECT 'n' || CAST(event_id AS varchar) AS id, CASE event_type WHEN 'view' THEN 'Push-ups morning' WHEN 'click' THEN 'push-UPS' WHEN 'purchase' THEN 'Weigh-in' WHEN 'signup' THEN 'Pull-ups' ELSE 'Chinups' END AS title,
  CAST(floor(value) AS bigint) AS body, date_trunc('second', ts) AS created FROM events"""


def _daily(pattern: str) -> str:
    return f"""SELECT d.day, coalesce(sum(n.body), 0) AS body FROM
  (SELECT CAST(unnest(generate_series(min(created)::date::timestamp, max(created)::date::timestamp, INTERVAL 1 DAY)) AS date) AS day FROM l_notes WHERE title ILIKE '{pattern}') d
  LEFT JOIN l_notes n ON n.created::date = d.day AND n.title ILIKE '{pattern}' GROUP BY 1"""


VIEWS["l_daily"] = _daily("push-ups%")

VIEWS["l_tickets"] = """
SELECT CAST(l_orderkey AS varchar) AS num, l_shipdate AS post_date, CASE l_returnflag WHEN 'R' THEN 'CORN YELLOW' WHEN 'A' THEN 'BEANS' ELSE 'OATS' END AS crop_description,
  sum(CAST(l_quantity AS DECIMAL(18,4))) AS net_units, CASE l_returnflag WHEN 'R' THEN 'ring' WHEN 'A' THEN 'widget' END AS crop FROM lineitem GROUP BY ALL"""

VIEWS["l_posting"] = """
SELECT * FROM (SELECT commodity_guid, min(guid) AS from_guid, count(*) AS from_guid_found FROM l_accounts WHERE commodity_guid IS NOT NULL AND description LIKE '%Harvested%' GROUP BY 1) f
FULL JOIN (SELECT commodity_guid, min(guid) AS to_guid, count(*) AS to_guid_found FROM l_accounts WHERE commodity_guid IS NOT NULL AND description LIKE '%Delivered%' GROUP BY 1) t USING (commodity_guid)"""

VIEWS["l_entered"] = """
SELECT t.num, p.from_guid, p.to_guid, CAST(trunc(round(CAST(net_units AS DOUBLE) * b.cash * 100, 2)) AS bigint) AS value_num, CAST(trunc(net_units * 100) AS bigint) AS quantity_num
FROM l_tickets t JOIN l_mean_bid b USING (crop) JOIN l_posting p USING (commodity_guid) WHERE p.from_guid IS NOT NULL AND p.to_guid IS NOT NULL"""

VIEWS["l_machine"] = """
SELECT c_name AS farm, split_part(p_name, ' ', 2) AS crop, l_quantity, l_linenumber, l_shipdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey WHERE p_brand <> 'Brand#1' AND l_linenumber <> 7"""

VIEWS["l_exec"] = """
WITH sums AS (SELECT year, account_type, sum(amt_c) AS amt_c FROM l_farm GROUP BY ALL),
years AS (SELECT DISTINCT year FROM sums),
fixed AS (SELECT year, (SELECT amt_c FROM sums s WHERE s.year = y.year AND account_type = 'INCOME') AS income, (SELECT amt_c FROM sums s WHERE s.year = y.year AND account_type = 'EXPENSE') AS expense FROM years y),
all_rows AS (SELECT year, 'INCOME' AS account, income AS amt_c, 10 AS o FROM fixed UNION ALL SELECT year, 'EXPENSE', expense, 20 FROM fixed
 UNION ALL SELECT year, 'OIBDA', income + expense, 30 FROM fixed
 UNION ALL SELECT year, account_type, amt_c, 100 FROM sums WHERE account_type NOT IN ('INCOME', 'EXPENSE'))
SELECT year, account, amt_c FROM all_rows"""

VIEWS["l_yearly"] = """
SELECT category, year(post_date) AS year, sum(amt_c) AS amt_c, sum(qty_c) AS qty_c FROM l_categories GROUP BY ALL"""

VIEWS["l_grain"] = f"""
SELECT s.commodity_guid, sum(s.qty_c) AS qty_c FROM l_stock s WHERE s.commodity_guid IS NOT NULL AND year(s.post_date) <= {YEAR} GROUP BY 1"""

VIEWS["l_sheet"] = f"""
SELECT category AS balance_sheet_category, sum(amt_c) * 100 AS amt_4, sum(qty_c) AS qty_c FROM l_yearly WHERE year <= {YEAR} GROUP BY 1
UNION ALL SELECT 'Grain', sum(g.qty_c * b.cash_c), sum(g.qty_c) FROM l_grain g LEFT JOIN l_last_bid b USING (commodity_guid)"""

RECURSIVE = {"l_anc", "l_fold"}


def with_views(select: str) -> str:
    """The SELECT preceded by the views it uses, in definition order."""
    needed, todo = set(), [select]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(VIEWS[name])
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    return f"WITH RECURSIVE {ctes}\n{select}" if ctes else select


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    totals = "SELECT s.account_guid, CAST(sum(s.value_num) AS DOUBLE) / 100 AS amt, count(*) AS splits, a.code AS account_code, a.name AS account_name, a.account_type FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid"
    q["account_totals"] = f"{totals} GROUP BY ALL"
    q["account_totals_year"] = f"{totals} JOIN l_transactions t ON t.guid = s.tx_guid WHERE year(t.post_date) = {YEAR} GROUP BY ALL"
    q["account_paths"] = "SELECT guid, name, parent_accounts FROM l_paths"
    q["account_level"] = "SELECT guid, finpack_account FROM l_paths"
    q["account_descriptor"] = """SELECT c.guid, c.crop, CASE WHEN p.p_partkey IS NOT NULL THEN E'[Depreciation]\\nCost = ' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS varchar) || E'\\nSec_179 = ' || CASE WHEN p_partkey % 20 = 0 THEN '50.00' ELSE '0.00' END
 || E'\\nDepreciation_Type = "Other"\\nMethod = "' || CASE p_size % 3 WHEN 0 THEN 'MO S/L' WHEN 1 THEN 'HY 200DB' ELSE 'S/L' END || E'"\\nYears = ' || CAST(p_size % 5 + 3 AS varchar)
 || E'\\nDate_in_Service = ' || CAST(p_size % 6 + 1994 AS varchar) || E'-12-27T08:00:00-06:00\\n' END AS account_notes
FROM l_crops c LEFT JOIN part p ON c.guid = 'p' || CAST(p.p_partkey AS varchar)"""
    q["accounts_by_term"] = "SELECT commodity_guid, guid FROM l_paths WHERE name LIKE '%PROMO%' OR name LIKE '%red%' OR parent_accounts LIKE '%PROMO%' OR parent_accounts LIKE '%red%'"
    q["accounts_below_term"] = q["accounts_by_term"]
    q["subtree_totals"] = """WITH own AS (SELECT account_guid AS guid, sum(value_num) AS v FROM l_splits GROUP BY 1), below AS (SELECT anc, guid FROM l_anc UNION ALL SELECT guid, guid FROM l_accounts)
SELECT b.anc AS guid, CAST(coalesce(sum(o.v), 0) AS bigint) AS total FROM below b LEFT JOIN own o ON o.guid = b.guid GROUP BY 1"""
    q["transactions_by_text"] = f"SELECT s.guid AS split_guid, a.name AS account_name, s.value_num, CAST(t.post_date AS date) AS post_date FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid JOIN l_transactions t ON t.guid = s.tx_guid WHERE year(t.post_date) = {YEAR} AND s.value_num < 0"
    q["accounts_of_type"] = f"SELECT guid FROM l_accounts WHERE account_type IN {CASH}"
    q["all_transactions"] = """SELECT s.guid AS split_guid, s.tx_guid, a.name AS account_name, a.code AS account_code, a.description AS account_desc, t.num AS tx_num, t.description,
 CAST(t.post_date AS date) AS post_date, s.action AS split_action, s.memo, CAST(s.value_num AS DOUBLE) / 100 AS amt, CAST(s.quantity_num AS DOUBLE) / 100 AS qty
FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid JOIN l_transactions t ON t.guid = s.tx_guid"""
    q["counter_splits"] = f"SELECT src_guid, src_name, account_type, {money('sum(amt_c)')} AS amt, {money('sum(qty_c)')} AS qty, count(*) AS row_count FROM l_cash GROUP BY src_guid, src_name, account_type"
    q["counter_splits_direct"] = f"SELECT account_guid, src_type, {money('sum(amt_c)')} AS amt, {money('sum(qty_c)')} AS qty, count(*) AS row_count FROM l_stock GROUP BY account_guid, src_type"
    q["counter_splits_once"] = f"""SELECT src_guid, account_type, {money('sum(amt_c)')} AS amt, count(*) AS row_count FROM
 (SELECT * FROM l_cash QUALIFY row_number() OVER (PARTITION BY split_guid ORDER BY src_guid) = 1) x GROUP BY src_guid, account_type"""
    q["counter_flows"] = f"SELECT account_guid, {money('sum(amt_c)')} AS amt, {money('sum(qty_c)')} AS qty, count(*) AS row_count FROM l_cash WHERE account_type NOT IN {CASH} GROUP BY 1"
    q["cash_clean"] = f"""SELECT f.split_guid, f.src_guid, f.account_code, f.account_type, p.finpack_account, p.parent_accounts, CAST(f.post_date AS date) AS post_date,
 {money('f.amt_c')} AS amt, {money('f.quantity_c')} AS quantity FROM l_clean f {_PATH_JOIN} WHERE f.year = {YEAR}"""
    q["reclassified"] = f"SELECT split_guid, src_guid, account_code, account_type, account_name, {money('amt_c')} AS amt, {money('quantity_c')} AS quantity FROM l_year_farm"
    q["farm_with_depreciation"] = f"""SELECT account_code, finpack_account, CAST(round(sum(amt), 2) AS DOUBLE) AS amt, CAST(sum(quantity) AS DOUBLE) AS quantity, count(*) AS row_count FROM (
 SELECT f.account_code, p.finpack_account, CAST(f.amt_c AS DECIMAL(24,6)) / 100 AS amt0, CAST(CAST(f.amt_c AS DECIMAL(20,2)) * 0.01 AS DECIMAL(24,6)) AS amt, CAST(f.quantity_c AS DECIMAL(20,2)) * 0.01 AS quantity FROM l_farm f {_PATH_JOIN} WHERE f.year = {YEAR}
 UNION ALL SELECT '800', p.finpack_account, 0, CAST(d.amt AS DECIMAL(24,6)), 1 FROM l_depreciation d JOIN l_crops p ON p.guid = d.guid WHERE year(d.post_date) = {YEAR}) x GROUP BY 1, 2"""
    q["exec_summary"] = f"SELECT account AS \"Account\", CAST(amt_c AS DOUBLE) / 100 AS \"Amount\" FROM l_exec WHERE year = {YEAR}"
    q["exec_summary_depreciation"] = f"""WITH s AS (SELECT account_type, CAST(sum(amt_c) AS DECIMAL(30,2)) * 0.01 AS amt FROM l_farm WHERE year = {YEAR} GROUP BY 1),
 d AS (SELECT sum(CAST(amt AS DECIMAL(24,6))) AS amt FROM l_depreciation WHERE year(post_date) = {YEAR}),
 i AS (SELECT (SELECT amt FROM s WHERE account_type = 'INCOME') AS inc, (SELECT amt FROM s WHERE account_type = 'EXPENSE') AS exp, (SELECT amt FROM d) AS dep)
SELECT a AS "Account", CAST(round(CAST(v AS DECIMAL(38,6)), 2) AS DOUBLE) AS "Amount" FROM (SELECT 'INCOME' AS a, inc AS v FROM i UNION ALL SELECT 'EXPENSE', exp FROM i UNION ALL SELECT 'OIBDA', inc + exp FROM i
 UNION ALL SELECT 'DEPRECIATION', dep FROM i UNION ALL SELECT 'NET INCOME', inc + exp + dep FROM i
 UNION ALL SELECT account_type, amt FROM s WHERE account_type NOT IN ('INCOME', 'EXPENSE', 'DEPRECIATION')) x"""
    q["exec_by_year"] = 'SELECT year, account AS "Account", CAST(amt_c AS DOUBLE) / 100 AS "Amount" FROM l_exec'
    q["summary_by_account"] = f"SELECT account_code AS \"Code\", account_name AS \"Account\", {money('sum(quantity_c)')} AS \"Quantity\", {money('sum(amt_c)')} AS \"Amount\" FROM l_farm WHERE year = {YEAR} GROUP BY account_code, account_name"
    q["summary_by_ancestor"] = f"SELECT f.account_type AS \"Type\", p.finpack_account AS \"Account\", {money('sum(f.quantity_c)')} AS \"Quantity\", {money('sum(f.amt_c)')} AS \"Amount\" FROM l_farm f {_PATH_JOIN} WHERE f.year = {YEAR} GROUP BY 1, 2"
    cell = lambda y: f"coalesce(CAST(sum(CASE WHEN year = {y} THEN amt_c END) AS DOUBLE) / 100, 0)"
    q["trend_pivot"] = "SELECT account_code AS \"Code\", account_name AS \"Account\", " + ", ".join(f"{cell(y)} AS y{y}" for y in YEARS) + " FROM l_farm GROUP BY 1, 2"
    trend = " || ' ' || ".join(number_text(cell(y)) for y in YEARS)
    q["trend_string"] = f"""SELECT "Code", "Account", "Amount", "Trend" FROM (SELECT account_code AS "Code", account_name AS "Account", CAST(sum(CASE WHEN year = {max(YEARS)} THEN amt_c END) AS DOUBLE) / 100 AS "Amount",
 {trend} AS "Trend", bool_or(year = {max(YEARS)}) AS shown FROM l_farm GROUP BY 1, 2) x WHERE shown"""
    q["exec_trend"] = f"""SELECT "Account", "Amount", "Trend", lower("Account") || '.png' AS icon FROM (SELECT account AS "Account", CAST(sum(CASE WHEN year = {max(YEARS)} THEN amt_c END) AS DOUBLE) / 100 AS "Amount",
 {trend} AS "Trend", bool_or(year = {max(YEARS)}) AS shown FROM l_exec GROUP BY 1) x WHERE shown"""
    q["detail_with_totals"] = f"""SELECT account_code, account_name || ' (' || account_code || ')' AS display, year, src_code AS "Src", CAST(post_date AS date) AS "Date", description AS "Description", memo AS "Memo", CAST(amt_c AS DOUBLE) / 100 AS "Amount", 'detail' AS row_kind FROM l_farm WHERE year = {YEAR}
UNION ALL SELECT account_code, NULL, year, 'Total', make_date({YEAR}, 12, 31), NULL, NULL, CAST(sum(amt_c) AS DOUBLE) / 100, 'total' FROM l_farm WHERE year = {YEAR} GROUP BY account_code, year"""
    run = lambda c: f"CAST(sum({c}) OVER (PARTITION BY category ORDER BY year) AS DOUBLE) / 100"
    q["running_position"] = f"SELECT category, year, CAST(amt_c AS DOUBLE) / 100 AS amt, CAST(qty_c AS DOUBLE) / 100 AS qty, {run('amt_c')} AS closing_amt, {run('qty_c')} AS closing_qty FROM l_yearly"
    q["closing_positions"] = q["running_position"]
    q["balance_details"] = f"SELECT category AS balance_sheet_category, account_guid, {money('sum(amt_c)')} AS amt, {money('sum(qty_c)')} AS qty, count(*) AS row_count FROM l_categories WHERE year(post_date) <= {YEAR} GROUP BY 1, 2"
    q["balance_sheet"] = "SELECT balance_sheet_category, CAST(amt_4 AS DOUBLE) / 10000 AS amt, CAST(qty_c AS DOUBLE) / 100 AS qty FROM l_sheet"
    pct = " ".join(f"WHEN '{k}' THEN {v}" for k, v in DISCOUNTS.items())
    q["share_value"] = f"""WITH v AS (SELECT balance_sheet_category, CAST(amt_4 AS DOUBLE) / 10000 AS amt, amt_4, CAST(CASE balance_sheet_category {pct} END AS DOUBLE) / 100 * (CAST(amt_4 AS DOUBLE) / 10000) / {SHARES} AS share_val FROM l_sheet)
SELECT balance_sheet_category, amt, round(share_val, 6) AS share_val FROM v UNION ALL SELECT 'Total', CAST(sum(amt_4) AS DOUBLE) / 10000, round(sum(share_val), 6) FROM v"""
    src = lambda types, cmp: f"(SELECT coalesce(sum(amt_c), 0) FROM l_cash WHERE src_type IN {types} AND year(post_date) {cmp} {YEAR})"
    money_types, ar_ap = "('BANK', 'CREDIT', 'CASH')", "('RECEIVABLE', 'PAYABLE')"
    q["identity_check"] = f"""WITH f AS (SELECT {src(money_types, '<')} AS oc, {src(ar_ap, '<')} AS oa, {src(money_types, '<=')} AS cc, {src(ar_ap, '<=')} AS ca, (SELECT coalesce(sum(amt_c), 0) FROM l_farm WHERE year = {YEAR}) AS net)
SELECT CAST(oc AS DOUBLE) / 100 AS opening_cash, CAST(oa AS DOUBLE) / 100 AS opening_ar_ap, CAST(cc AS DOUBLE) / 100 AS closing_cash, CAST(ca AS DOUBLE) / 100 AS closing_ar_ap, CAST(net AS DOUBLE) / 100 AS net_cash_flow,
 CAST(net + oa + oc - ca AS DOUBLE) / 100 AS explained_cash, CAST(net + oa + oc - ca - cc AS DOUBLE) / 100 AS difference, net + oa + oc - ca = cc AS balanced FROM f"""
    q["cash_by_source"] = f"SELECT src_code, src_name, {money('sum(amt_c)')} AS amt, {money('sum(qty_c)')} AS qty FROM l_cash WHERE src_type IN {money_types} AND year(post_date) <= {YEAR} GROUP BY 1, 2"
    q["stock_value"] = "SELECT g.commodity_guid, CAST(g.qty_c AS DOUBLE) / 100 AS qty, b.crop AS bid_crop, b.currency_guid, 'Grain' AS balance_sheet_category, CAST(g.qty_c * b.cash_c AS DOUBLE) / 10000 AS amt FROM l_grain g LEFT JOIN l_last_bid b USING (commodity_guid)"
    q["stock_value_detail"] = """SELECT s.account_name, s.account_desc, s.commodity_guid, CAST(sum(s.qty_c) AS DOUBLE) / 100 AS qty, b.crop AS bid_crop, b.currency_guid, 'Grain' AS balance_sheet_category, CAST(sum(s.qty_c) * b.cash_c AS DOUBLE) / 10000 AS amt
FROM l_stock s LEFT JOIN l_last_bid b USING (commodity_guid) GROUP BY s.account_name, s.account_desc, s.commodity_guid, b.crop, b.currency_guid, b.cash_c"""
    text = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
    q["price_list"] = f"SELECT p.guid, p.commodity_guid, c.fullname, {text('p.date')} AS date, p.type, p.value_num, CAST(p.value_denom AS bigint) AS value_denom FROM l_prices p JOIN l_commodities c ON c.guid = p.commodity_guid WHERE year(p.date) = {PRICE_YEAR}"
    q["price_series"] = f"SELECT crop, {text('date')} AS date, CAST(value_num AS DOUBLE) / 100 AS cash FROM l_bids"
    q["price_mean"] = "SELECT commodity_guid, crop, currency_guid, round(cash, 6) AS cash FROM l_mean_bid"
    q["price_last"] = "SELECT commodity_guid, crop, currency_guid, CAST(cash_c AS DOUBLE) / 100 AS cash FROM l_last_bid"
    q["price_nearest"] = f"""SELECT a.guid, a.commodity_guid, {text('b.date')} AS near_time, CAST(b.value_num AS DOUBLE) / 100 AS near_cash FROM l_prices a LEFT JOIN l_bids b ON b.commodity_guid = a.commodity_guid WHERE a.type = 'ask'
QUALIFY row_number() OVER (PARTITION BY a.guid ORDER BY abs(epoch_us(b.date) - epoch_us(a.date)), b.date, b.guid) = 1"""
    q["price_nearest_one"] = f"SELECT {text('date')} AS near_time, CAST(value_num AS DOUBLE) / 100 AS cash FROM l_bids WHERE commodity_guid = 'click' ORDER BY abs(epoch_us(date) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')), date, guid LIMIT 1"
    q["price_named"] = "SELECT p.guid, c.fullname, p.value_num FROM l_prices p JOIN l_commodities c ON c.guid = p.commodity_guid WHERE c.fullname IN ('ring', 'gear') AND p.type = 'bid'"
    q["invoice_lines"] = """SELECT inv_type, inv_guid, inv_id, CAST(date_posted AS date) AS date_posted, tx_guid, post_lot, operation_id, operation, org_name, org_notes, account_guid, account_code, account_name, entry_guid, description,
 CAST(quantity_num AS DOUBLE) / 100 AS quantity, CAST(price_num AS DOUBLE) / 100 AS price, CAST(quantity_num * price_num AS DOUBLE) / 10000 AS amt, quantity_type, paytype, disc_how, disc_type, CAST(discount_num AS DOUBLE) / 100 AS disc_amt,
 CAST(due_date AS date) AS due_date, linked_document FROM l_year_lines"""
    q["slot_lookup"] = f"""SELECT i.guid AS inv_guid, CASE WHEN i.billto_guid IS NULL THEN 'INVOICE' ELSE 'BILL' END AS inv_type, CAST(due.due_date AS date) AS due_date, doc.linked_document
FROM l_invoices i LEFT JOIN l_due due ON due.obj_guid = i.post_txn LEFT JOIN l_docs doc ON doc.obj_guid = i.guid WHERE year(i.date_posted) = {YEAR}"""
    q["invoice_quantities"] = "SELECT tx_guid, account_guid, inv_year, CAST(quantity_c AS DOUBLE) / 100 AS quantity FROM l_quantities"
    q["lot_payments"] = "SELECT lot_guid, CAST(sum(value_num) AS DOUBLE) / 100 AS payment_amt FROM l_splits WHERE lot_guid IS NOT NULL AND action = 'Payment' GROUP BY 1"
    q["contract_status"] = f"""SELECT CAST(date_opened AS date) AS "Contract Date", CAST(date_posted AS date) AS "Delivery Start", CAST(due_date AS date) AS "Delivery End", inv_id AS "Contract ID", crop AS "Crop", account_name AS "Post Acct", org_name AS "Elevator",
 CAST(quantity_c AS DOUBLE) / 100 AS "Bushels", CAST(amount_4 AS DOUBLE) / 10000 AS "Amount", {half_up("amount_4", "quantity_c * 100", 2)} AS "Price", fulfilled AS "Fulfilled" FROM l_contracts"""
    q["open_contracts"] = 'SELECT crop AS "Crop", CAST(sum(quantity_c) AS DOUBLE) / 100 AS "Bushels" FROM l_contracts WHERE NOT fulfilled GROUP BY 1'
    grain = "(account_code LIKE '133%' OR account_code LIKE '134%')"
    q["sibling_discounts"] = f"""SELECT inv_id, CAST(sum(quantity_num * price_num - discount_num * 100) AS DOUBLE) / 10000 AS discount_amt FROM l_lines WHERE inv_type = 'INVOICE' AND NOT {grain}
 AND inv_id IN (SELECT inv_id FROM l_lines WHERE inv_type = 'INVOICE' AND {grain} AND year(date_posted) = {YEAR}) GROUP BY 1"""
    q["capital_documents"] = f"SELECT DISTINCT inv_id, linked_document, replace(linked_document, '{URI_PREFIX}', '') AS note_id FROM l_year_lines WHERE account_code LIKE '133%'"
    q["vendor_1099"] = f"""SELECT p.finpack_account, v.name AS vendor_name, v.id AS vendor_id, v.addr_addr1, v.addr_addr2, v.addr_addr3, {half_up("sum(e.quantity_num * e.price_num)", "10000", 2)} AS amt
{_BILL1099.replace("WHERE", "JOIN l_crops p ON p.guid = a.guid WHERE")} AND v.addr_addr3 IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6"""
    q["vendor_1099_lines"] = f"""SELECT e.acct AS acct_guid, CAST(e.quantity_num * e.price_num AS DOUBLE) / 10000 AS amt, CAST(i.date_posted AS date) AS post_date, v.name AS vendor_name, v.id AS vendor_id, v.addr_addr1, v.addr_addr2, v.addr_addr3, '' AS addr_addr4, '' AS phone, a.name AS acct_name {_BILL1099}"""
    q["deductible_expense"] = f"""SELECT "Acct", CAST(sum(value_num) AS DOUBLE) / 100 AS "Amt", CAST(sum(pct) AS DOUBLE) AS "Deduct_Percentage", CAST(sum(CAST(round(ded * 100) AS bigint)) AS DOUBLE) / 100 AS "Deduct_Total" FROM
 (SELECT a.name AS "Acct", s.value_num, CAST(a.code AS bigint) AS pct, {half_up("s.value_num * CAST(a.code AS bigint)", "10000", 2)} AS ded FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid JOIN l_transactions t ON t.guid = s.tx_guid JOIN l_related r ON r.guid = a.guid
 WHERE a.account_type = 'EXPENSE' AND year(t.post_date) = {YEAR}) x GROUP BY 1"""
    interest = f"FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid JOIN l_transactions t ON t.guid = s.tx_guid WHERE a.name ILIKE '%red%' AND a.account_type = 'EXPENSE' AND year(t.post_date) = {YEAR}"
    q["interest_by_payee"] = f"SELECT t.description, CAST(sum(s.value_num) AS DOUBLE) / 100 AS amt {interest} GROUP BY 1"
    q["interest_detail"] = f"SELECT a.name, t.description, CAST(t.post_date AS date) AS post_date, CAST(s.value_num AS DOUBLE) / 100 AS amt {interest}"
    q["pattern_join"] = "SELECT post_date, month, name, code, memo, CAST(value_num AS DOUBLE) / 100 AS amt, emp_id, emp_name, emp_addr1, emp_addr2 FROM l_wages"
    q["wages_monthly"] = "SELECT month, memo, CAST(sum(value_num) AS DOUBLE) / 100 AS amt FROM l_wages GROUP BY 1, 2"
    q["wages_totals"] = "SELECT code, emp_id, emp_name, emp_addr1, emp_addr2, memo, CAST(sum(value_num) AS DOUBLE) / 100 AS amt FROM l_wages WHERE emp_addr2 IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6"
    q["labor_deposits"] = f"SELECT a.name, CAST(t.post_date AS date) AS post_date, CAST(sum(s.value_num) AS DOUBLE) / 100 AS amt FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid JOIN l_transactions t ON t.guid = s.tx_guid WHERE a.code = '146' AND year(t.post_date) = {YEAR} GROUP BY a.name, t.post_date"
    q["depreciation_rows"] = "SELECT guid, row_number, post_date, round(amt, 6) AS amt, description, depreciation_code FROM l_depreciation"
    q["depreciation_year"] = f"SELECT '800' AS account_code, 'DEPRECIATION' AS account_type, d.guid AS src_guid, p.name AS src_name, p.finpack_account, d.post_date, round(d.amt, 6) AS amt, CAST(1 AS DOUBLE) AS quantity FROM l_depreciation d JOIN l_crops p ON p.guid = d.guid WHERE year(d.post_date) = {YEAR}"
    q["rented_acres"] = "SELECT crop, operation, operation_id, org_name, CAST(acres_c AS DOUBLE) / 100 AS acres, amt, base_rent FROM l_rent"
    q["planted_acres"] = "SELECT crop, operation, operation_id, CAST(acres_c AS DOUBLE) / 100 AS acres FROM l_planted"
    q["rent_and_yield"] = "SELECT crop, operation, operation_id, CAST(bushels_c AS DOUBLE) / 100 AS total_bushels, CAST(acres_c AS DOUBLE) / 100 AS acres, bu_per_acre FROM l_production"
    q["melt_terms"] = 'SELECT operation_id, max_rent AS "Max", crop, pct AS "Percentage" FROM l_terms'
    raw = half_up("rev_c * acres_c * CAST(pct AS bigint) - base * acres_c * 10000", "1000000", 2)
    q["flex_lease"] = f"""WITH base AS (SELECT r.crop, r.operation, r.operation_id, r.org_name, r.acres_c, r.amt, CAST(r.base_rent AS bigint) AS base, g.bushels_c, g.bu_per_acre, b.cash AS price, t.max_rent, t.pct,
  CAST(round(g.bu_per_acre * b.cash * 100) AS bigint) AS rev_c FROM l_rent r LEFT JOIN l_production g USING (crop, operation, operation_id) LEFT JOIN l_mean_bid b ON b.crop = r.crop JOIN l_terms t ON t.operation_id = r.operation_id AND t.crop = r.crop),
 s AS (SELECT *, max_rent * acres_c / 100 AS capped_total, (CAST(max_rent AS bigint) - base) * CAST(acres_c AS DOUBLE) / 100 AS capped_bonus, {raw} AS raw_bonus FROM base),
 u AS (SELECT *, least(raw_bonus, capped_bonus) AS bonus FROM s)
SELECT crop AS "Crop", operation AS "Field", org_name AS "Owner", CAST(acres_c AS DOUBLE) / 100 AS "Acres", CAST(base AS DOUBLE) AS "Base Rent", CAST(bushels_c AS DOUBLE) / 100 AS "Total Bushels", bu_per_acre AS "Bu/Acre", round(price, 2) AS "Price", max_rent AS "Rent Cap", pct / 100 AS "Revenue %",
 CAST(rev_c AS DOUBLE) / 100 AS "Revenue", capped_total AS "Capped Total", capped_bonus AS "Capped Bonus", raw_bonus AS "Raw Bonus", bonus AS "Bonus", {half_up("CAST(round((bonus + amt) * 100) AS HUGEINT)", "acres_c", 2)} AS "Adjusted Rent" FROM u"""
    stage = lambda s: " + ".join(["CAST(0 AS DOUBLE)"] + [f"coalesce(max(CASE WHEN account_desc = '{s} {c}' THEN mean_qty END), 0)" for c in CROP_WORDS])
    st = {s: stage(s) for s in STAGES}
    q["progress"] = f"""WITH g AS (SELECT account_name, account_desc, commodity_guid, abs(sum(qty_c)) AS qty_c FROM l_stock WHERE account_desc IS NOT NULL AND commodity_guid IS NOT NULL GROUP BY 1, 2, 3),
 m AS (SELECT account_name, account_desc, CAST(sum(qty_c) AS DOUBLE) / 100 / count(*) AS mean_qty FROM g GROUP BY 1, 2),
 w AS (SELECT account_name, {st['Contracted']} AS c, {st['Delivered']} AS d, {st['Harvested']} AS h FROM m GROUP BY 1)
SELECT account_name, c AS "Contracted", d AS "Delivered", h AS "Harvested", d + h AS "Total", round(d / nullif(c, 0), 6) AS pct, lower(account_name) || '.png' AS icon, round(CASE WHEN d / nullif(c, 0) > 1 THEN 1.0 ELSE d / nullif(c, 0) END, 6) AS progress FROM w"""
    q["latest_posting"] = "SELECT account_desc, CAST(post_date AS date) AS post_date FROM l_latest"
    q["last_delivery"] = "SELECT CAST(max(post_date) AS date) AS last_delivery FROM l_latest WHERE account_desc LIKE 'Delivered%'"
    machine = 'farm AS "Farm", crop AS "Crop", sum(l_quantity) AS "Harvested", sum(l_quantity * 3) AS "Dry_Yield", CAST(sum(l_linenumber + 10) AS DOUBLE) / count(*) AS "Moisture", CAST(max(l_shipdate) AS date) AS "Date"'
    q["multi_agg"] = f"SELECT {machine} FROM l_machine WHERE farm <> 'Customer#000000001' GROUP BY 1, 2"
    q["production_vs_machine"] = f"""WITH m AS (SELECT {machine} FROM l_machine GROUP BY 1, 2), g AS (SELECT operation, crop, CAST(sum(bushels_c) AS DOUBLE) / 100 AS bushels, CAST(sum(acres_c) AS DOUBLE) / 100 AS acres FROM l_production GROUP BY 1, 2),
 j AS (SELECT m.*, coalesce(g.bushels, 0) AS b, coalesce(g.acres, 0) AS a FROM m LEFT JOIN g ON g.operation = m."Farm" AND g.crop = m."Crop")
SELECT "Farm", "Crop", lower("Crop") || '.png' AS icon, "Harvested" AS "Acres Worked", "Dry_Yield", "Moisture", "Date", b AS "Bushels", a AS "Total Acres", "Dry_Yield" - b AS "New Bushels", round(b / nullif("Harvested", 0), 6) AS "Bu/Acres Worked", round(b / nullif(a, 0), 6) AS "Bu/Total Acres" FROM j"""
    q["note_rows"] = f"SELECT id AS note_id, title, CAST(body AS varchar) AS body, {text('created')} AS created_date FROM l_notes WHERE title ILIKE 'push-ups%' AND CAST(body AS varchar) <> '50'"
    q["daily_sum"] = "SELECT day AS bucket, CAST(body AS bigint) AS body FROM l_daily"
    sunday = lambda c: f"CAST(date_trunc('week', {c}) AS date) + 6"
    q["weekly_sum"] = f"SELECT {sunday('day')} AS bucket, CAST(sum(body) AS bigint) AS body FROM ({_daily('pull-ups%')}) d GROUP BY 1"
    q["weekly_mean"] = f"SELECT {sunday('day')} AS bucket, round(CAST(sum(body) AS DOUBLE) / count(*), 6) AS body FROM l_daily GROUP BY 1"
    q["monthly_mean"] = "SELECT last_day(CAST(created AS date)) AS bucket, round(CAST(sum(body) AS DOUBLE) / count(*), 6) AS body FROM l_notes WHERE title ILIKE 'weigh-in%' AND created > TIMESTAMP '2024-01-02' GROUP BY 1"
    q["daily_orders"] = """WITH f AS (SELECT s.action AS split_action, CAST(t.post_date AS date) AS day, sum(s.value_num) AS c FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid JOIN l_transactions t ON t.guid = s.tx_guid WHERE s.value_num > 0 GROUP BY 1, 2),
 d AS (SELECT split_action, CAST(unnest(generate_series(min(day)::timestamp, max(day)::timestamp, INTERVAL 1 DAY)) AS date) AS bucket FROM f GROUP BY 1)
SELECT d.split_action, d.bucket, CAST(coalesce(f.c, 0) AS DOUBLE) / 100 AS amt FROM d LEFT JOIN f ON f.split_action = d.split_action AND f.day = d.bucket"""
    q["daily_stats"] = "SELECT count(*) AS count_value, round(CAST(sum(body) AS DOUBLE) / count(*), 6) AS mean_value, CAST(min(body) AS bigint) AS min_value, CAST(max(body) AS bigint) AS max_value, CAST(median(CAST(body AS bigint)) AS DOUBLE) AS median_value, CAST(sum(body) AS bigint) AS sum_value FROM l_daily"
    q["posting_accounts"] = "SELECT commodity_guid, from_guid, from_guid_found, to_guid, to_guid_found FROM l_posting"
    q["load_tickets"] = "SELECT num, CAST(post_date AS date) AS post_date, crop_description, CAST(net_units AS DOUBLE) AS net_units, crop FROM l_tickets"
    legs = "SELECT {t}_guid AS account_guid, '{a}' AS action, {s}value_num AS value_num, {s}quantity_num AS quantity_num"
    buy, sell = legs.format(t="to", a="Buy", s=""), legs.format(t="from", a="Sell", s="-")
    rest = ", CAST(100 AS bigint) AS value_denom, 'imported from CSV' AS memo, 'n' AS reconcile_state"
    q["double_entry"] = f"{buy}{rest} FROM l_entered UNION ALL {sell}{rest} FROM l_entered"
    q["stream_ingest"] = f"{buy} FROM l_entered UNION ALL {sell} FROM l_entered"
    q["link_slots"] = f"SELECT 't' || CAST(o_orderkey AS varchar) AS obj_guid, 'assoc_uri' AS name, 4 AS slot_type, '{URI_PREFIX}n' || CAST(event_id AS varchar) AS string_val FROM orders JOIN events ON event_id = o_orderkey"
    q["ticket_notes"] = "SELECT CAST(o_orderkey AS varchar) AS num, 'n' || CAST(event_id AS varchar) AS note_id FROM orders JOIN events ON event_id = o_orderkey"
    q["anti_existing"] = f"SELECT num, crop, CAST(net_units AS DOUBLE) AS net_units FROM l_tickets WHERE num NOT IN (SELECT num FROM l_transactions WHERE year(post_date) = {YEAR})"
    q["semi_existing"] = "SELECT num, guid, description FROM l_transactions WHERE num IN (SELECT num FROM l_tickets WHERE crop = 'ring')"
    shops = statement_shops()
    arms = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(shops))
    line = "regexp_replace(regexp_replace(line, '(Amazon.com\\*)[^,\\n]*,', '\\1,', 'g'), '(AMZN Mktp US\\*)[^,\\n]*,', '\\1,', 'g')"
    for find, put in [(step.find, step.put) for step in STATEMENT_REWRITES if not step.regex]:
        line = f"replace({line}, '{find}', '{put}')"
    q["scrub_text"] = f"""SELECT line_id, md5({line}) AS line_md5 FROM (SELECT 'o' || CAST(o_orderkey AS varchar) AS line_id, CAST(o_orderkey AS varchar) || ',' || CASE o_orderkey % {len(shops)} {arms} END || 'Sale' AS line FROM orders
 UNION ALL SELECT 'd' || CAST(doc_id AS varchar), text FROM documents) x"""
    q["statement_file"] = f"SELECT md5({line}) AS line_md5 FROM (SELECT CAST(o_orderkey AS varchar) || ',' || CASE o_orderkey % {len(shops)} {arms} END || 'Sale' AS line FROM orders) x"
    q["sink_csv"] = q["cash_by_source"]
    q["sink_sheets"] = f"SELECT 'Totals' AS sheet, NULL AS name, description, NULL AS post_date, amt FROM ({q['interest_by_payee']}) t UNION ALL SELECT 'Detail', name, description, post_date, amt FROM ({q['interest_detail']}) d"
    q["written_ledger"] = q["account_totals_year"]
    q["entered_loads"] = f"SELECT num, 'Farmers Coop' AS description, '{ENTERED}.000000' AS enter_date FROM l_entered"
    q["sink_by_crop"] = q["rent_and_yield"]
    q["second_ledger"] = "SELECT 'business' AS books, * FROM (" + totals + " GROUP BY ALL) a UNION ALL SELECT 'personal', * FROM (" + totals + " JOIN l_transactions t ON t.guid = s.tx_guid WHERE t.num LIKE '%7' GROUP BY ALL) b"
    q["machine_file"] = f"SELECT {machine} FROM l_machine GROUP BY 1, 2"
    q["detail_ordered"] = q["detail_with_totals"]
    name = f"'{DOCUMENT_PREFIX}' || lpad(CAST(doc_id AS varchar), 9, '0') || '.pdf'"
    ticket = "ltrim(lpad(CAST(doc_id AS varchar), 9, '0') || '.pdf', '0')"
    q["document_tickets"] = f"SELECT '/in/box/' || {name} AS path, {ticket} AS ticket, 'Scale Ticket ' || {ticket} AS title FROM documents"
    q["post_date_text"] = "SELECT guid, CASE WHEN num NOT LIKE '%7' THEN strftime(CAST(post_date AS date), '%Y-%m-%d 00:00:00') END AS post_date FROM l_transactions"
    q["post_date_update"] = f"SELECT guid, CASE WHEN num NOT LIKE '%7' OR year(post_date) <> {YEAR} THEN strftime(CAST(post_date AS date), '%Y-%m-%d 00:00:00') END AS post_date, CAST(year(post_date) AS integer) AS post_year FROM l_transactions"
    q["nearest_moments"] = """WITH legs AS (SELECT s.guid, a.account_type, s.reconcile_date AS moment, t.post_date, s.value_num FROM l_splits s JOIN l_accounts a ON a.guid = s.account_guid AND a.guid LIKE 'c%' JOIN l_transactions t ON t.guid = s.tx_guid),
 pts AS (SELECT account_type, post_date AS moment, max(value_num) AS largest FROM legs GROUP BY 1, 2),
 f AS (SELECT guid, account_type, moment FROM legs),
 b AS (SELECT f.guid, f.moment AS fat, p.moment, p.largest FROM f ASOF LEFT JOIN pts p ON p.account_type = f.account_type AND p.moment <= f.moment),
 n AS (SELECT f.guid, f.moment AS fat, p.moment, p.largest FROM f ASOF LEFT JOIN pts p ON p.account_type = f.account_type AND p.moment >= f.moment)
SELECT b.guid, CAST(CASE WHEN pick THEN b.moment ELSE n.moment END AS date) AS near_time, CASE WHEN pick THEN b.largest ELSE n.largest END AS near_largest
FROM b JOIN n USING (guid), LATERAL (SELECT n.moment IS NULL OR (b.moment IS NOT NULL AND b.fat - b.moment <= n.moment - n.fat) AS pick) z"""
    for unit, label in (("daily", "CAST(ts AS date)"), ("weekly", sunday("ts"))):
        q[f"stream_{unit}"] = f"SELECT {label} AS bucket, CAST(sum(CAST(round(value * 100) AS bigint)) AS bigint) AS total, count(*) AS rows FROM events GROUP BY 1"
    q["reshape_total"] = "SELECT commodity_guid, CAST(sum(value_num) AS bigint) AS value_num, count(*) AS row_count FROM l_prices GROUP BY 1 UNION ALL SELECT 'Total', CAST(sum(value_num) AS bigint), count(*) FROM l_prices"
    return {name: with_views(text) if not text.startswith("WITH") else _merge(text) for name, text in q.items()}


def _merge(text: str) -> str:
    """Views first, then the query's own common table expressions."""
    full = with_views(text)
    if full == text:
        return text
    head, own = full[: -len(text)].rstrip(), text[len("WITH ") :]
    return f"{head},\n{own}"
