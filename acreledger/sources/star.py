"""The ledger tables as views over star-schema tables (orders, line items, parts, events).

Used by the registered queries and the benchmark: every ledger table is derived
from the given tables by Spark, so its size follows theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ledger import Ledger
from .store import listing

CROP_WORDS = ["ring", "widget", "gear", "bolt", "plate"]
URI_PREFIX = "notes://open?id="
STAGES = ["Contracted", "Delivered", "Harvested"]


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _key(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), _text(column))


def _choose(number: Column, options: list[str], default: str) -> Column:
    """Option picked by a small number, else the default."""
    out = F.lit(default)
    for i, option in reversed(list(enumerate(options))):
        out = F.when(number == i, F.lit(option)).otherwise(out)
    return out


class StarLedger:
    """Builds each ledger table on demand from ``<folder>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._star: dict[str, DataFrame] = {}

    def star(self, name: str) -> DataFrame:
        if name not in self._star:
            self._star[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._star[name]

    def __call__(self, name: str) -> DataFrame:
        build = getattr(self, f"_{name}", None)
        if build is None:
            raise KeyError(name)
        return build()

    def _accounts(self) -> DataFrame:
        null = F.lit(None).cast("string")

        def rows(df: DataFrame, guid, name, kind, parent, code, commodity=null, description=null) -> DataFrame:
            return df.select(
                guid.alias("guid"),
                name.alias("name"),
                kind.alias("account_type"),
                commodity.alias("commodity_guid"),
                parent.alias("parent_guid"),
                code.alias("code"),
                description.alias("description"),
            )

        asset, empty = F.lit("ASSET"), F.lit("")
        top = self.spark.sql("select * from values ('root', 'Root Account') as top(guid, name)")
        root = rows(top, F.col("guid"), F.col("name"), F.lit("ROOT"), null, empty)
        region = rows(self.star("region"), _key("r", "r_regionkey"), F.col("r_name"), asset, F.lit("root"), empty)
        nation = rows(
            self.star("nation"), _key("n", "n_nationkey"), F.col("n_name"), asset, _key("r", "n_regionkey"), empty
        )
        customer = rows(
            self.star("customer"),
            _key("c", "c_custkey"),
            F.col("c_name"),
            _choose(F.col("c_custkey") % 5, ["BANK", "CASH", "RECEIVABLE", "CREDIT"], "ASSET"),
            _key("n", "c_nationkey"),
            _key("1", "c_custkey"),
        )
        supplier = rows(
            self.star("supplier"),
            _key("s", "s_suppkey"),
            F.col("s_name"),
            _choose(F.col("s_suppkey") % 3, ["PAYABLE", "LIABILITY"], "EXPENSE"),
            _key("n", "s_nationkey"),
            _key("2", "s_suppkey"),
        )
        part = self.star("part")
        kinds = rows(
            part.select("p_type").distinct(), _key("k", "p_type"), F.col("p_type"), asset, F.lit("root"), empty
        )
        parts = rows(
            part,
            _key("p", "p_partkey"),
            F.col("p_name"),
            _choose(F.col("p_partkey") % 3, ["INCOME", "EXPENSE"], "STOCK"),
            _key("k", "p_type"),
            _choose(F.col("p_partkey") % 8, ["133", "134", "146", "301c", "303b", "424b", "900"], "543"),
            _choose(F.col("p_partkey") % 5, ["view", "click", "purchase", "signup"], "error"),
            F.concat(
                _choose(F.floor(F.col("p_partkey") / 3) % 3, STAGES[:2], STAGES[2]),
                F.lit(" "),
                F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)),
            ),
        )
        out = root
        for df in (region, nation, customer, supplier, kinds, parts):
            out = out.unionByName(df)
        return out

    def _transactions(self) -> DataFrame:
        return self.star("orders").select(
            _key("t", "o_orderkey").alias("guid"),
            F.lit("USD").alias("currency_guid"),
            _text("o_orderkey").alias("num"),
            F.col("o_orderdate").alias("post_date"),
            F.col("o_orderdate").alias("enter_date"),
            F.col("o_orderpriority").alias("description"),
        )

    def _lines(self) -> DataFrame:
        """Line items with the amounts in cents; the key repeats what makes a line unique."""
        return self._keyed(self.star("lineitem").select("*", *self._cents()))

    def _cents(self) -> list[Column]:
        cents = lambda c: F.round(c * 100).cast("bigint")
        return [cents(F.col("l_extendedprice")).alias("net_c"), cents(F.col("l_quantity")).alias("qty_c")]

    def _keyed(self, line: DataFrame) -> DataFrame:
        act = (
            F.when(F.col("l_returnflag") == "R", "Payment")
            .when(F.col("l_returnflag") == "A", "Invoice")
            .otherwise("Bill")
        )
        unique = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "net_c", "qty_c"]
        return line.withColumns({"act": act, "line_key": F.concat_ws("|", *[_text(c) for c in unique])})

    def _splits(self) -> DataFrame:
        # joined on the transaction guid: the legs come out partitioned by it, so later
        # joins on the transaction find them in place; texts are made after the join, which
        # moves only what they are made from
        orders = self.star("orders").select(_key("t", "o_orderkey").alias("tx_guid"), "o_custkey")
        tax = F.round(F.col("l_extendedprice") * F.col("l_tax") * 100).cast("bigint")
        raw = self.star("lineitem").select(
            _key("t", "l_orderkey").alias("tx_guid"), "l_linenumber", "l_partkey", "l_suppkey",
            "l_returnflag", "l_linestatus", "l_shipdate", *self._cents(), tax.alias("tax_c"),
        )
        lines = raw.join(orders, "tx_guid")
        # a line without an order's key has no order, so here the guid holds the key
        lines = self._keyed(lines.withColumn("l_orderkey", F.substring("tx_guid", 2, 2**31 - 1)))

        def leg(name: str, account: Column, value: Column, quantity: Column) -> Column:
            return F.struct(
                F.lit(name).alias("leg"),
                account.alias("account_guid"),
                value.alias("value_num"),
                quantity.alias("quantity_num"),
            )

        net, tax, qty = F.col("net_c"), F.col("tax_c"), F.col("qty_c")
        legs = F.array(
            leg("C", _key("c", "o_custkey"), net + tax, net + tax),
            leg("P", _key("p", "l_partkey"), -net, -qty),
            leg("S", _key("s", "l_suppkey"), -tax, -tax),
        )
        hundred = F.lit(100).cast("bigint")
        return lines.withColumn("leg", F.explode(legs)).select(
            F.md5(F.concat_ws("|", "line_key", "leg.leg")).alias("guid"),
            "tx_guid",
            "leg.account_guid",
            F.concat(F.lit("line "), _text("l_linenumber")).alias("memo"),
            F.col("act").alias("action"),
            F.col("l_linestatus").alias("reconcile_state"),
            F.col("l_shipdate").alias("reconcile_date"),
            "leg.value_num",
            hundred.alias("value_denom"),
            "leg.quantity_num",
            hundred.alias("quantity_denom"),
            F.when(F.col("l_returnflag") == "R", _key("l", "l_orderkey")).alias("lot_guid"),
        )

    def _prices(self) -> DataFrame:
        return self.star("events").select(
            _key("e", "event_id").alias("guid"),
            F.col("event_type").alias("commodity_guid"),
            F.lit("USD").alias("currency_guid"),
            F.col("ts").alias("date"),
            F.lit("events").alias("source"),
            F.when(F.col("user_id") % 3 != 0, "bid").otherwise("ask").alias("type"),
            F.round(F.col("value") * 100).cast("bigint").alias("value_num"),
            F.lit(100).cast("bigint").alias("value_denom"),
        )

    def _commodities(self) -> DataFrame:
        kinds = self.star("events").select("event_type").distinct()
        order = {"view": "ring", "click": "widget", "purchase": "gear", "signup": "bolt"}
        name = F.lit("plate")
        for kind, crop in order.items():
            name = F.when(F.col("event_type") == kind, F.lit(crop)).otherwise(name)
        return kinds.select(
            F.col("event_type").alias("guid"),
            F.lit("EVENTS").alias("namespace"),
            name.alias("fullname"),
            F.lit(None).cast("string").alias("cusip"),
            F.lit(100).cast("bigint").alias("fraction"),
        )

    def _jobs(self) -> DataFrame:
        customers = self.star("customer").select(
            _key("jc", "c_custkey").alias("guid"),
            _text("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            _key("c", "c_custkey").alias("owner_guid"),
        )
        return customers.unionByName(
            self.star("supplier").select(
                _key("js", "s_suppkey").alias("guid"),
                _text("s_suppkey").alias("id"),
                F.col("s_name").alias("name"),
                _key("s", "s_suppkey").alias("owner_guid"),
            )
        )

    def _vendors(self) -> DataFrame:
        shares = "\n".join(f"{crop} = {30 + 5 * i}" for i, crop in enumerate(CROP_WORDS))
        terms = F.concat(
            F.lit(f"[Vendor_Details]\n# 1099 wanted\nReceive_1099 = true\n{shares}\nMax = "),
            (F.col("s_suppkey") % 7 * 10000 + 20000).cast("string"),
            F.lit("\nMin = 200\n"),
        )
        return self.star("supplier").select(
            _key("s", "s_suppkey").alias("guid"),
            _text("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.when(F.col("s_suppkey") % 2 == 0, terms).otherwise("plain vendor").alias("notes"),
            _key("Street ", "s_suppkey").alias("addr_addr1"),
            _key("Nation ", "s_nationkey").alias("addr_addr2"),
            F.when(F.col("s_suppkey") % 5 != 0, F.lit("USA")).alias("addr_addr3"),
            F.lit("").alias("addr_addr4"),
            F.lit("").alias("addr_phone"),
        )

    def _customers(self) -> DataFrame:
        return self.star("customer").select(
            _key("c", "c_custkey").alias("guid"),
            F.col("c_name").alias("name"),
            F.lit(None).cast("string").alias("notes"),
        )

    def _employees(self) -> DataFrame:
        kinds = self.star("orders").select("o_orderpriority").distinct()
        first = F.substring("o_orderpriority", 1, 1)
        pattern = (
            F.when(first == "1", "1-%").when(first == "2", "%HIGH").when(first == "3", "3_med%um")
        ).otherwise(F.lower("o_orderpriority"))
        return kinds.select(
            F.concat(F.lit("E"), first).alias("id"),
            pattern.alias("addr_name"),
            F.concat(F.lit("Road "), first).alias("addr_addr1"),
            F.when(first != "4", F.lit("Town")).alias("addr_addr2"),
        )

    def _invoices(self) -> DataFrame:
        """One invoice per order; one bill per order and supplier of returned lines."""
        orders = self.star("orders")
        posted = F.expr("o_orderdate + interval 10 days")

        def rows(df: DataFrame, guid: Column, owner: Column, billto: Column) -> DataFrame:
            return df.select(
                guid.alias("guid"),
                F.concat(F.lit("N"), _text("o_orderkey")).alias("id"),
                F.col("o_orderdate").alias("date_opened"),
                posted.alias("date_posted"),
                F.lit(None).cast("string").alias("notes"),
                F.lit("").alias("billing_id"),
                owner.alias("owner_guid"),
                billto.alias("billto_guid"),
                _key("t", "o_orderkey").alias("post_txn"),
                _key("l", "o_orderkey").alias("post_lot"),
            )

        invoices = rows(orders, _key("i", "o_orderkey"), _key("jc", "o_custkey"), F.lit(None).cast("string"))
        billed = (
            self.star("lineitem")
            .where(F.col("l_returnflag") == "R")
            .select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
            .distinct()
            .join(orders, "o_orderkey")
        )
        bill = F.concat(_key("i", "o_orderkey"), F.lit("_"), _text("l_suppkey"))
        return invoices.unionByName(rows(billed, bill, _key("js", "l_suppkey"), _key("jc", "o_custkey")))

    def _entries(self) -> DataFrame:
        bill = F.col("l_returnflag") == "R"
        account = _key("p", "l_partkey")
        price = F.round(F.col("net_c") / (F.col("qty_c") / F.lit(100.0))).cast("bigint")
        discount = F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("bigint")
        hundred = F.lit(100).cast("bigint")
        null_int, null_text = F.lit(None).cast("int"), F.lit(None).cast("string")
        only_bill = lambda c: F.when(bill, c)
        only_invoice = lambda c: F.when(~bill, c)
        return self._lines().select(
            F.md5("line_key").alias("guid"),
            F.col("l_shipdate").alias("date"),
            _key("line ", "l_linenumber").alias("description"),
            _choose(F.col("l_linenumber") % 3, ["Project", "Hours"], "Material").alias("action"),
            F.col("qty_c").alias("quantity_num"),
            hundred.alias("quantity_denom"),
            only_invoice(account).alias("i_acct"),
            only_invoice(price).alias("i_price_num"),
            only_invoice(hundred).alias("i_price_denom"),
            only_invoice(discount).alias("i_discount_num"),
            only_invoice(hundred).alias("i_discount_denom"),
            only_invoice(F.lit("VALUE")).alias("i_disc_type"),
            only_invoice(F.lit("PRETAX")).alias("i_disc_how"),
            null_int.alias("i_taxable"),
            null_int.alias("i_taxincluded"),
            null_text.alias("i_taxtable"),
            only_invoice(_key("i", "l_orderkey")).alias("invoice"),
            only_bill(account).alias("b_acct"),
            only_bill(price).alias("b_price_num"),
            only_bill(hundred).alias("b_price_denom"),
            only_bill(F.lit(1)).alias("b_paytype"),
            null_int.alias("b_taxable"),
            null_int.alias("b_taxincluded"),
            null_text.alias("b_taxtable"),
            only_bill(F.concat(_key("i", "l_orderkey"), F.lit("_"), _text("l_suppkey"))).alias("bill"),
        )

    def _slots(self) -> DataFrame:
        null = F.lit(None).cast("string")

        def rows(df: DataFrame, guid: Column, name: str, kind: Column, text: Column, when: Column) -> DataFrame:
            return df.select(
                guid.alias("obj_guid"),
                F.lit(name).alias("name"),
                kind.cast("int").alias("slot_type"),
                text.alias("string_val"),
                when.alias("timespec_val"),
            )

        never = F.lit(None).cast("timestamp_ntz")
        method = _choose(F.col("p_size") % 3, ["MO S/L", "HY 200DB"], "S/L")
        asset_note = F.concat(
            F.lit("[Depreciation]\nCost = "),
            F.col("p_retailprice").cast("decimal(12,2)").cast("string"),
            F.lit("\nSec_179 = "),
            F.when(F.col("p_partkey") % 20 == 0, "50.00").otherwise("0.00"),
            F.lit('\nDepreciation_Type = "Other"\nMethod = "'),
            method,
            F.lit('"\nYears = '),
            (F.col("p_size") % 5 + 3).cast("string"),
            F.lit("\nDate_in_Service = "),
            (F.col("p_size") % 6 + 1994).cast("string"),
            F.lit("-12-27T08:00:00-06:00\n"),
        )
        orders = self.star("orders")
        notes = rows(
            self.star("part"),
            _key("p", "p_partkey"), "notes", F.lit(4), asset_note, never,
        )
        due = rows(
            orders.where(F.col("o_orderkey") % 4 != 0),
            _key("t", "o_orderkey"), "trans-date-due", F.lit(6), null,
            F.expr("o_orderdate + interval 30 days"),
        )
        document = rows(
            orders.where(F.col("o_orderkey") % 3 == 0),
            _key("i", "o_orderkey"), "assoc_uri", F.lit(4),
            F.concat(F.lit(URI_PREFIX), F.md5(_text("o_orderkey"))), never,
        )
        related = rows(
            self.star("supplier").where(F.col("s_suppkey") % 3 == 2),
            _key("s", "s_suppkey"), "tax-related",
            F.when(F.col("s_suppkey") % 2 == 0, 1).otherwise(4),
            F.when(F.col("s_suppkey") % 4 == 1, "true").otherwise("false"), never,
        )
        return notes.unionByName(due).unionByName(document).unionByName(related)

    def _notes(self) -> DataFrame:
        titles = {"view": "Push-ups morning", "click": "push-UPS", "purchase": "Weigh-in", "signup": "Pull-ups"}
        title = F.lit("Chinups")
        for kind, text in titles.items():
            title = F.when(F.col("event_type") == kind, F.lit(text)).otherwise(title)
        millis = F.unix_millis(F.col("ts").cast("timestamp"))
        return self.star("events").select(
            _key("n", "event_id").alias("id"),
            F.lit("").alias("parent_id"),
            title.alias("title"),
            F.floor("value").cast("string").alias("body"),
            F.lit("app").alias("source"),
            F.lit("events").alias("source_application"),
            millis.alias("user_updated_time"),
            millis.alias("user_created_time"),
        )

    def _loads(self) -> DataFrame:
        """Load file rows: each line item is a weighing of its order's ticket."""
        return self.star("lineitem").select(
            F.col("l_orderkey").alias("ticket_number"),
            F.col("l_shipdate").cast("timestamp").alias("tare_time"),
            F.col("l_shipdate").cast("timestamp").alias("gross_time"),
            F.when(F.col("l_returnflag") == "R", "CORN YELLOW")
            .when(F.col("l_returnflag") == "A", "BEANS")
            .otherwise("OATS")
            .alias("crop_description"),
            F.col("l_quantity").alias("net_units"),
        )

    def _machine(self) -> DataFrame:
        """Machine yield rows: each line item is a pass over a customer's field."""
        orders = self.star("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        customer = self.star("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
        part = self.star("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
        crop = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
        return (
            self.star("lineitem")
            .join(orders, "l_orderkey")
            .join(customer, "o_custkey")
            .join(part, "l_partkey")
            .select(
                F.col("c_name").alias("farms"),
                crop.alias("crop_type"),
                F.when(F.col("p_brand") == "Brand#1", "---").otherwise(F.col("p_brand")).alias("varieties"),
                F.when(F.col("l_linenumber") == 7, "---")
                .otherwise((F.col("l_linenumber") + 10).cast("string"))
                .alias("moisture"),
                F.col("l_quantity").alias("area_harvested"),
                (F.col("l_quantity") * 3).alias("total_dry_yield"),
                F.col("l_shipdate").alias("last_harvested"),
            )
        )


_OPEN: dict[tuple[str, str], tuple[str, Ledger]] = {}


def star_ledger(spark: SparkSession, folder: str) -> Ledger:
    """A lazy :class:`Ledger` over the star tables in ``folder``.

    Kept per application and folder, so schemas are read and the account tree is
    walked once, however many reports run.  The tree is a checkpoint of the accounts as
    they were, so it counts only for the files it was made from: a folder whose files have
    other names, sizes or times is opened anew.
    """
    key, files = (spark.sparkContext.applicationId, folder), listing(spark, folder)
    if key not in _OPEN or _OPEN[key][0] != files:
        _OPEN[key] = files, Ledger(StarLedger(spark, folder))
    return _OPEN[key][1]
