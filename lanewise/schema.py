"""Raw and cleaned layouts, and the roles operators look columns up by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The raw layout's 33 column names, in file order.
RAW_COLUMNS = [
    "ID", "Project Code", "PQ #", "PO / SO #", "ASN/DN #", "Country",
    "Managed By", "Fulfill Via", "Vendor INCO Term", "Shipment Mode",
    "PQ First Sent to Client Date", "PO Sent to Vendor Date",
    "Scheduled Delivery Date", "Delivered to Client Date",
    "Delivery Recorded Date", "Product Group", "Sub Classification",
    "Vendor", "Item Description", "Molecule/Test Type", "Brand", "Dosage",
    "Dosage Form", "Unit of Measure (Per Pack)", "Line Item Quantity",
    "Line Item Value", "Pack Price", "Unit Price", "Manufacturing Site",
    "First Line Designation", "Weight (Kilograms)", "Freight Cost (USD)",
    "Line Item Insurance (USD)",
]

# The columns that get Tukey-fence outlier flags, in layout order.
OUTLIER_COLUMNS = [
    "qty", "line_value", "pack_price", "unit_price",
    "weight_numeric", "freight_numeric", "insurance",
]

_DERIVED = (
    [(name, T.DateType()) for name in (
        "pq_date", "po_date", "scheduled_date", "delivered_date", "recorded_date")]
    + [(name, T.StringType()) for name in ("pq_flag", "po_flag", "freight_flag")]
    + [(name, T.DoubleType()) for name in ("freight_numeric", "weight_numeric")]
    + [("flag_weight_reference", T.BooleanType())]
    + [(name, T.DoubleType()) for name in (
        "qty", "line_value", "pack_price", "unit_price", "insurance", "uom")]
    + [("flag_zero_value", T.BooleanType())]
    + [(f"flag_{name}_outlier", T.BooleanType()) for name in OUTLIER_COLUMNS]
    + [("delay_days", T.IntegerType()), ("ot_bool", T.BooleanType()),
       ("early_bool", T.BooleanType())]
    + [(name, T.IntegerType()) for name in (
        "c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total")]
    + [("flag_negative_cycle", T.BooleanType()), ("unit_freight", T.DoubleType()),
       ("flag_unit_freight_extreme", T.BooleanType()),
       ("delivery_year", T.IntegerType()), ("delivery_month", T.StringType())]
)

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])
CLEANED = T.StructType(
    list(RAW.fields) + [T.StructField(name, kind) for name, kind in _DERIVED]
)


@dataclass(frozen=True)
class Columns:
    """Column name of each role. The defaults are the cleaned layout's names."""

    row_id: str = "ID"
    shipment: str = "ASN/DN #"
    vendor: str = "Vendor"
    country: str = "Country"
    mode: str = "Shipment Mode"
    terms: str = "Vendor INCO Term"
    product: str = "Product Group"
    subclass: str = "Sub Classification"
    delay: str = "delay_days"
    value: str = "line_value"
    weight: str = "weight_numeric"
    freight: str = "freight_numeric"
    freight_flag: str = "freight_flag"
    insurance: str = "insurance"
    unit_freight: str = "unit_freight"
    year: str = "delivery_year"
    delivered: str = "delivered_date"
