"""Bills and invoices: lines, contracts, linked documents (U-1, J3, J4, J12, R18, R25, R30, R31)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import MONEY, in_year, in_years, matches, product, ratio, rational, sum0
from ..functions.text import link_id
from ..operators.splits import AMOUNTS
from ..operators.sums import exact_totals
from ..operators.tree import all_accounts
from .chart import CAPITAL_PREFIX, CROPS, GRAIN_CODES, PAID_TOLERANCE


def slot_values(slots: DataFrame, name: str, value: str, alias: str) -> DataFrame:
    """Distinct ``(obj_guid, value)`` of one attribute of the key/value table."""
    return slots.where(F.col("name") == name).select("obj_guid", F.col(value).alias(alias)).distinct()


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _lines(ledger) -> DataFrame:
    """Entries as bill and invoice lines under common names, from one pass over them.

    The kind is settled first; each column is then picked from its side, so columns that a report
    does not name are neither read nor computed.  An entry that is on a bill and on an invoice gives a line of each.
    """
    bill, invoice = F.col("bill").isNotNull(), F.col("invoice").isNotNull()
    kinds = F.when(bill & invoice, F.array(F.lit("BILL"), F.lit("INVOICE"))).when(bill, F.array(F.lit("BILL")))
    lines = ledger.entries.where(bill | invoice).withColumn(
        "inv_type", F.explode(kinds.otherwise(F.array(F.lit("INVOICE"))))
    )
    billed = F.col("inv_type") == "BILL"
    side = lambda on_bill, on_invoice: F.when(billed, on_bill).otherwise(on_invoice)
    price = [side(F.col(f"b_price_{part}"), F.col(f"i_price_{part}")) for part in ("num", "denom")]
    picked = {
        "inv_guid": side(F.col("bill"), F.col("invoice")),
        "account_guid": side(F.col("b_acct"), F.col("i_acct")),
        "entry_guid": F.col("guid"),
        "description": F.col("description"),
        "quantity": rational("quantity_num", "quantity_denom"),
        "price": rational(*price),
        "amt": product("quantity_num", "quantity_denom", *price),
        "quantity_type": F.col("action"),
        "paytype": side(_text("b_paytype"), F.lit("0")),
        "disc_how": side(F.lit(""), F.col("i_disc_how")),
        "disc_type": side(F.lit(""), F.col("i_disc_type")),
        "disc_amt": side(F.lit(0).cast(MONEY), rational("i_discount_num", "i_discount_denom")),
        "taxable": side(_text("b_taxable"), _text("i_taxable")),
        "taxincluded": side(_text("b_taxincluded"), _text("i_taxincluded")),
        "taxtable": side(F.col("b_taxtable"), F.col("i_taxtable")),
        "entry_date": F.col("date"),
    }
    return lines.select("inv_type", *[value.alias(name) for name, value in picked.items()])


def _parties(ledger) -> DataFrame:
    """Jobs with the name and notes of the vendor and of the customer that own them."""
    vendors = ledger.vendors.select(
        F.col("guid").alias("owner_guid"),
        F.lit("BILL").alias("inv_type"),
        F.col("name").alias("org_name"),
        F.col("notes").alias("org_notes"),
    )
    customers = ledger.customers.select(
        F.col("guid").alias("owner_guid"),
        F.lit("INVOICE").alias("inv_type"),
        F.col("name").alias("org_name"),
        F.col("notes").alias("org_notes"),
    )
    jobs = ledger.jobs.select(F.col("guid").alias("job_guid"), "id", "name", "owner_guid")
    return jobs.join(vendors.unionByName(customers), "owner_guid").drop("owner_guid")


def invoice_heads(ledger, years: int | Sequence[int] | None = None) -> DataFrame:
    """One row per bill or invoice head with parties, due date and linked document.

    Everything that hangs on the head is joined here, before the lines, so each
    attribute is joined once per head and not once per line.  Bills take the
    operation from the billed job, invoices from the owner job.
    """
    heads = ledger.invoices.where(in_years("date_posted", years)).select(
        F.col("guid").alias("inv_guid"),
        F.col("id").alias("inv_id"),
        "date_posted",
        "date_opened",
        "billing_id",
        "notes",
        "post_txn",
        "post_lot",
        F.col("owner_guid").alias("job_guid"),
        "billto_guid",
    )
    billed = ledger.jobs.select(
        F.col("guid").alias("billto_guid"),
        F.col("id").alias("bill_id"),
        F.col("name").alias("bill_name"),
        F.lit(True).alias("billed"),
    )
    due = slot_values(ledger.slots, "trans-date-due", "timespec_val", "due_date").withColumnRenamed(
        "obj_guid", "post_txn"
    )
    document = slot_values(ledger.slots, "assoc_uri", "string_val", "linked_document").withColumnRenamed(
        "obj_guid", "inv_guid"
    )
    is_bill = F.col("inv_type") == "BILL"
    return (
        heads.join(_parties(ledger), "job_guid")
        .join(billed, "billto_guid", "left")
        .where(~is_bill | F.col("billed").isNotNull())
        .withColumn("operation_id", F.when(is_bill, F.col("bill_id")).otherwise(F.col("id")))
        .withColumn("operation", F.when(is_bill, F.col("bill_name")).otherwise(F.col("name")))
        .drop("job_guid", "billto_guid", "bill_id", "bill_name", "billed", "id", "name")
        .join(due, "post_txn", "left")
        .join(document, "inv_guid", "left")
    )


def invoice_lines(
    ledger, years: int | Sequence[int] | None = None, heads: DataFrame | None = None
) -> DataFrame:
    """U-1/R18: all bill and invoice lines, 34 columns, ``post_txn`` as ``tx_guid``.

    ``heads`` limits the lines to some rows of :func:`invoice_heads`.
    The union of bills and invoices is distinct without a shuffle: entry guids are
    primary keys, the kind separates both halves, and the attributes joined in are
    distinct per head.
    """
    lines = _lines(ledger)
    accounts = ledger.accounts.select(
        F.col("guid").alias("account_guid"), F.col("code").alias("account_code"), F.col("name").alias("account_name")
    )
    return (
        lines.join(invoice_heads(ledger, years) if heads is None else heads, ["inv_guid", "inv_type"])
        .join(accounts, "account_guid")
        .withColumn("inv_acct", F.col("account_guid"))
        .withColumn("entry_type", F.col("quantity_type"))
        .withColumnRenamed("post_txn", "tx_guid")
    )


def invoice_quantities(ledger, years: int | Sequence[int] | None = None) -> DataFrame:
    """J7 right side: quantity per (transaction, account, year posted)."""
    return (
        invoice_lines(ledger, years)
        .where(F.col("tx_guid").isNotNull())
        .groupBy("tx_guid", "account_guid", F.year("date_posted").alias("inv_year"))
        .agg(sum0("quantity").alias("quantity"))
    )


def payments(splits: DataFrame) -> DataFrame:
    """Paid amount per lot."""
    paid = splits.where(F.col("lot_guid").isNotNull() & (F.col("action") == "Payment"))
    return exact_totals(paid, ["lot_guid"], {"payment_amt": AMOUNTS["amt"]})


def sibling_discounts(lines: DataFrame, grain_codes: str = GRAIN_CODES) -> DataFrame:
    """Amounts of the other lines of those invoices that have a grain line.

    One conditional aggregate per invoice id instead of a semi join back.
    ``lines`` holds invoice lines with ``amount`` and a flag ``in_year``.
    """
    grain = matches("account_code", grain_codes)
    return (
        lines.groupBy("inv_id")
        .agg(
            F.max(grain & F.col("in_year")).alias("has_grain"),
            F.sum(F.when(~grain, F.col("amount"))).alias("discount_amt"),
        )
        .where(F.col("has_grain") & F.col("discount_amt").isNotNull())
        .select("inv_id", "discount_amt")
    )


def contract_status(
    ledger,
    year: int,
    crops: list[str] | None = None,
    grain_codes: str = GRAIN_CODES,
    tolerance: str = PAID_TOLERANCE,
) -> DataFrame:
    """Grain invoices with unit price and whether payment and discounts settle them.

    Invoices without a due date or a lot drop out, as null group keys do.  An
    invoice without payment is not fulfilled.
    """
    # only invoice ids with a head in the year matter, whatever year their other heads have
    heads = invoice_heads(ledger).where(F.col("inv_type") == "INVOICE")
    wanted = ledger.invoices.where(in_year("date_posted", year)).select(F.col("id").alias("inv_id"))
    lines = (
        invoice_lines(ledger, heads=heads.join(wanted.distinct(), "inv_id", "left_semi"))
        .withColumn("amount", F.col("amt").cast("decimal(37,18)") - F.col("disc_amt"))
        .withColumn("in_year", F.coalesce(in_year("date_posted", year), F.lit(False)))
    )
    crop = all_accounts(ledger, crops or CROPS).select(F.col("guid").alias("account_guid"), "crop")
    keys = [
        "date_opened", "date_posted", "due_date", "inv_id", "crop",
        "account_name", "account_code", "org_name", "post_lot",
    ]
    grain = lines.where(F.col("in_year") & matches("account_code", grain_codes)).join(crop, "account_guid")
    grain = grain.na.drop("any", subset=keys).groupBy(*keys).agg(
        sum0("quantity").alias("quantity"), sum0("amount").alias("amount")
    )
    settled = (
        grain.join(sibling_discounts(lines, grain_codes), "inv_id", "left")
        .join(payments(ledger.splits).withColumnRenamed("lot_guid", "post_lot"), "post_lot", "left")
        .withColumn("discount_amt", F.coalesce("discount_amt", F.lit(0)))
    )
    parts = [F.col(c).cast("decimal(34,18)") for c in ("amount", "discount_amt", "payment_amt")]
    rest = F.abs(parts[0] + parts[1] + parts[2])
    # The labels of the report
    return settled.select(
        F.col("date_opened").alias("Contract Date"),
        F.col("date_posted").alias("Delivery Start"),
        F.col("due_date").alias("Delivery End"),
        F.col("inv_id").alias("Contract ID"),
        F.col("crop").alias("Crop"),
        F.col("account_name").alias("Post Acct"),
        F.col("org_name").alias("Elevator"),
        F.col("quantity").alias("Bushels"),
        F.col("amount").alias("Amount"),
        ratio("amount", "quantity", 2).alias("Price"),
        F.coalesce(rest <= F.lit(tolerance).cast("decimal(4,2)"), F.lit(False)).alias("Fulfilled"),
    )


def open_contracts(status: DataFrame) -> DataFrame:
    """contracts not fulfilled yet."""
    return status.where(~F.col("Fulfilled"))


def open_bushels(status: DataFrame) -> DataFrame:
    """Open bushels per crop."""
    return open_contracts(status).groupBy("Crop").agg(sum0("Bushels").alias("Bushels"))


def capital_documents(
    ledger, uri_prefix: str, year: int | None = None, code_prefix: str = CAPITAL_PREFIX
) -> DataFrame:
    """Distinct documents linked to invoices on capital accounts, with the note id."""
    lines = invoice_lines(ledger, year).where(F.col("account_code").startswith(code_prefix))
    return (
        lines.select("inv_id", "linked_document")
        .distinct()
        .withColumn("note_id", link_id(uri_prefix, "linked_document"))
    )
