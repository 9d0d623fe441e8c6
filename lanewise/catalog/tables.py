"""The star-schema tables seen as delivery lines, typed and as raw text.

One order line is one delivery. Gaps, sentinels and unreadable cells are placed by key
arithmetic, so that the same rows can be written down in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.functions.parsing import MONTH_NAME_DATE, SLASH_DATE
from lanewise.operators.features import (
    SEGMENTS,
    calendar,
    cycle_features,
    delay_features,
    unit_freight,
)
from lanewise.operators.sharing import new_folder
from lanewise.schema import RAW_COLUMNS, Columns

ROLES = Columns(
    row_id="id", shipment="asn", vendor="vendor", country="country", mode="mode",
    terms="terms", product="product", subclass="subclass",
)
# The fixture's unit freights stay far below the default threshold.
EXTREME_UNIT_FREIGHT = 1000

_ORDER, _PART, _SUPPLIER, _CUSTOMER = "orders", "part", "supplier", "customer"
_NEEDS = {
    "vendor": {_SUPPLIER},
    "country": {_ORDER, _CUSTOMER},
    "mode": {_ORDER},
    "product": {_PART},
    "subclass": {_PART},
    "item": {_PART},
    "scheduled_date": {_ORDER},
    "pq_date": {_ORDER},
    "po_date": {_ORDER},
    "delay_days": {_ORDER},
    "ot_bool": {_ORDER},
    "early_bool": {_ORDER},
    "c1_pq2po": {_ORDER},
    "c2_po2sched": {_ORDER},
    "c3_sched2deliv": {_ORDER},
    "c_total": {_ORDER},
    "flag_negative_cycle": {_ORDER},
}


#: Most rows of a side of few narrow columns that is broadcast, about 100 bytes each in memory.
NARROW_ROWS = 1 << 19


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; Spark reads one footer for its schema."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _star(spark: SparkSession, folder: str, tables: set[str]) -> DataFrame:
    """Order lines with only the tables the caller needs; every key has its match.

    Orders meet their customers first, so the many lines are not shuffled for that. Lines meet
    parts before orders: where these joins shuffle, lines of an order come out together, and most
    columns of wide rows repeat from line to line, which keeps their files small. Suppliers'
    names are broadcast up to ``NARROW_ROWS``. Days and terms are made of the lines and orders
    before they are shuffled, as they are narrower than what they are made of.
    """
    df = table(spark, folder, "lineitem").withColumns({
        "l_shipdate": F.to_date("l_shipdate"), "l_terms": F.concat("l_returnflag", "l_linestatus"),
    })
    if _PART in tables:
        df = df.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if _ORDER in tables:
        orders = table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
        if _CUSTOMER in tables:
            customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
            homes = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
            homes = homes.select("c_custkey", "n_name")
            orders = orders.join(homes, orders["o_custkey"] == homes["c_custkey"])
        df = df.join(orders, df["l_orderkey"] == orders["o_orderkey"])
    if _SUPPLIER in tables:
        names = table(spark, folder, "supplier").select("s_suppkey", "s_name")
        if names.count() <= NARROW_ROWS:
            names = F.broadcast(names)
        df = df.join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    return df


def _every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


def _first(*cases: tuple[Column, object], other) -> Column:
    """The value of the first case that holds."""
    out = other if isinstance(other, Column) else F.lit(other)
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def _price() -> Column:
    return F.col("l_extendedprice")


def _quantity() -> Column:
    return F.col("l_quantity")


def _unit_price() -> Column:
    return _price() / _quantity()


def _no_delivery() -> Column:
    return _every("l_orderkey", 41)


def _bad_delivery() -> Column:
    return _every("l_orderkey", 67)


def _quoted_on() -> Column:
    return F.date_sub(F.col("o_orderdate"), (F.col("l_partkey") % 90 + 30).cast("int"))


def _ordered_on() -> Column:
    return F.date_sub(F.col("o_orderdate"), (F.col("l_suppkey") % 100).cast("int"))


def _pq_flag() -> Column:
    return _first((_every("l_orderkey", 11), "pre_pq"), (_every("l_orderkey", 13), "not_captured"),
                  other="date")


def _po_flag() -> Column:
    return _first((_every("l_suppkey", 7), "from_rdc"), (_every("l_partkey", 17), "not_captured"),
                  other="date")


def _freight_flag() -> Column:
    return _first((_every("l_orderkey", 7), "included"), (_every("l_partkey", 23), "invoiced"),
                  (_every("l_suppkey", 5), "reference"), other="numeric")


def _mode() -> Column:
    return _first((_every("l_partkey", 31), None), (_every("l_partkey", 37), "N/A"),
                  other=F.col("o_orderpriority"))


def _line_value() -> Column:
    return _first((_every("l_partkey", 43), None), (_every("l_partkey", 47), 0.0),
                  (_every("l_partkey", 53), -_price()), other=_price())


def delivery_lines(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Typed delivery lines with the asked columns, joining only what they need."""
    needed: set[str] = set()
    for name in columns:
        needed |= _NEEDS.get(name, set())
    df = _star(spark, folder, needed)
    unread = _every("l_partkey", 61) | _every("l_partkey", 59)
    no_weight = (_every("l_partkey", 19) | _every("l_partkey", 21)
                 | _every("l_partkey", 25) | _every("l_partkey", 27))
    base = {
        "id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "asn": F.concat(F.lit("ASN-"), "l_orderkey"),
        "terms": F.col("l_terms"),
        "pq_flag": _pq_flag(),
        "po_flag": _po_flag(),
        "delivered_date": F.when(~(_no_delivery() | _bad_delivery()), F.col("l_shipdate")),
        "freight_flag": _freight_flag(),
        "freight_numeric": F.when(
            (_freight_flag() == "numeric") & ~_every("l_orderkey", 29), _price() * F.col("l_tax")
        ),
        "weight_numeric": F.when(~no_weight, _quantity()),
        "qty": _quantity(),
        "line_value": _line_value(),
        "unit_price": _unit_price(),
        "insurance": F.when(~_every("l_orderkey", 59), _price() * F.col("l_discount")),
    }
    if _ORDER in needed:
        base |= {
            "mode": _mode(),
            "scheduled_date": F.col("o_orderdate"),
            "pq_date": F.when((_pq_flag() == "date") & ~unread, _quoted_on()),
            "po_date": F.when(_po_flag() == "date", _ordered_on()),
        }
    if _CUSTOMER in needed:
        base["country"] = F.col("n_name")
    if _PART in needed:
        base |= {"product": F.col("p_type"), "subclass": F.col("p_brand"),
                 "item": F.col("p_name")}
    if _SUPPLIER in needed:
        base["vendor"] = F.col("s_name")
    df = df.select(*[c.alias(name) for name, c in base.items()])
    derived = {
        ("delay_days", "ot_bool", "early_bool"): delay_features,
        (*SEGMENTS, "flag_negative_cycle"): cycle_features,
        ("delivery_year", "delivery_month"): calendar,
        ("unit_freight", "flag_unit_freight_extreme"):
            lambda rows: unit_freight(rows, extreme=EXTREME_UNIT_FREIGHT),
    }
    for names, derive in derived.items():
        if not set(names).isdisjoint(columns):
            df = derive(df)
    return df.select(*columns)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same deliveries as 33 text columns, some rows twice."""
    df = _star(spark, folder, {_ORDER, _PART, _SUPPLIER, _CUSTOMER})

    def text(number: Column) -> Column:
        return number.cast("string")

    def key(prefix: str, name: str) -> Column:
        return F.concat(F.lit(prefix), name)

    scheduled = F.date_format(F.col("o_orderdate"), MONTH_NAME_DATE)
    shipped = F.col("l_shipdate")
    cells = {
        "ID": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "Project Code": key("PC-", "o_custkey"),
        "PQ #": key("PQ-", "l_partkey"),
        "PO / SO #": key("PO-", "l_orderkey"),
        "ASN/DN #": key("ASN-", "l_orderkey"),
        "Country": F.col("n_name"),
        "Managed By": F.lit("Central Office"),
        "Fulfill Via": F.when(_every("l_suppkey", 7), "From RDC").otherwise("Direct Drop"),
        "Vendor INCO Term": F.col("l_terms"),
        "Shipment Mode": _mode(),
        "PQ First Sent to Client Date": _first(
            (_every("l_orderkey", 11), "Pre-PQ Process"),
            (_every("l_orderkey", 13), "Date Not Captured"),
            (_every("l_partkey", 61), "13/45/99"),
            (_every("l_partkey", 59), None),
            other=F.date_format(_quoted_on(), SLASH_DATE),
        ),
        "PO Sent to Vendor Date": _first(
            (_every("l_suppkey", 7), "N/A - From RDC"),
            (_every("l_partkey", 17), "Date Not Captured"),
            other=F.date_format(_ordered_on(), "MM/dd/yy"),
        ),
        "Scheduled Delivery Date": F.when(
            _every("l_linenumber", 2), F.upper(scheduled)
        ).otherwise(scheduled),
        "Delivered to Client Date": _first(
            (_no_delivery(), None), (_bad_delivery(), "31-Jun-06"),
            other=F.date_format(shipped, MONTH_NAME_DATE),
        ),
        "Delivery Recorded Date": F.when(~_no_delivery(), F.date_format(
            F.date_add(shipped, F.col("l_linenumber")), MONTH_NAME_DATE
        )),
        "Product Group": F.col("p_type"),
        "Sub Classification": F.col("p_brand"),
        "Vendor": F.col("s_name"),
        "Item Description": F.col("p_name"),
        "Molecule/Test Type": F.col("p_name"),
        "Brand": F.col("p_brand"),
        "Dosage": F.when(_every("l_partkey", 3), "N/A"),
        "Dosage Form": F.lit("Tablet"),
        "Unit of Measure (Per Pack)": text(F.col("l_linenumber") * 10),
        "Line Item Quantity": text(_quantity()),
        "Line Item Value": text(_line_value()),
        "Pack Price": _first(
            (_every("l_partkey", 33), "n/a"), (_every("l_partkey", 35), "1.5d"),
            other=text(_unit_price() * F.col("l_linenumber")),
        ),
        "Unit Price": text(_unit_price()),
        "Manufacturing Site": F.col("s_name"),
        "First Line Designation": F.when(_every("l_linenumber", 3), "No").otherwise("Yes"),
        "Weight (Kilograms)": _first(
            (_every("l_partkey", 19), key("See DN-", "l_orderkey")),
            (_every("l_partkey", 21), "0"),
            (_every("l_partkey", 25), "-5"),
            (_every("l_partkey", 27), "Weight Captured Separately"),
            other=text(_quantity()),
        ),
        "Freight Cost (USD)": _first(
            (_every("l_orderkey", 7), "Freight Included in Commodity Cost"),
            (_every("l_partkey", 23), "Invoiced Separately"),
            (_every("l_suppkey", 5), key("See ASN-", "l_orderkey")),
            (_every("l_orderkey", 29), None),
            other=text(_price() * F.col("l_tax")),
        ),
        "Line Item Insurance (USD)": F.when(
            ~_every("l_orderkey", 59), text(_price() * F.col("l_discount"))
        ),
    }
    copies = F.when(_every("l_orderkey", 97), 2).otherwise(1)
    df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return df.select(*[cells[name].alias(name) for name in RAW_COLUMNS])


def scratch_folder(spark: SparkSession) -> str:
    """A new folder next to the session's checkpoints, on storage all executors share."""
    return new_folder(spark, "tables")
