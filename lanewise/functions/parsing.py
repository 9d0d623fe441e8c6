"""Text to typed columns: sentinels, short dates, numbers mixed with text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanewise.functions.expressions import flag

# Fixed values of the raw layout.
PQ_SENTINELS = {"Pre-PQ Process": "pre_pq", "Date Not Captured": "not_captured"}
PO_SENTINELS = {"N/A - From RDC": "from_rdc", "Date Not Captured": "not_captured"}
FREIGHT_SENTINELS = {
    "Freight Included in Commodity Cost": "included",
    "Invoiced Separately": "invoiced",
}
REFERENCE_PREFIX = "See "
SLASH_DATE = "M/d/yy"
MONTH_NAME_DATE = "d-MMM-yy"

# Spark reads "1.5d" and "1f" as numbers; the cast is guarded by this pattern.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def sentinel_flag(text: Column, states: Mapping[str, str], default: str = "date") -> Column:
    """State name for exact sentinel texts; everything else, null included, is ``default``."""
    state = F.lit(default)
    for sentinel, name in states.items():
        state = F.when(text == sentinel, name).otherwise(state)
    return state


def parse_date_lenient(text: Column, pattern: str) -> Column:
    """Date by pattern, null where the text does not fit.

    Two-digit years 69-99 belong to 19xx; Spark reads all of them as 20xx.
    """
    parsed = F.try_to_date(text, pattern)
    return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)


def to_number(text: Column) -> Column:
    """Double for plain numeric text (or infinity), null for anything else."""
    readable = text.rlike(_NUMBER) | text.rlike(_INFINITE)
    return F.when(readable, F.trim(text).try_cast("double"))


def is_reference(text: Column) -> Column:
    return flag(text.startswith(REFERENCE_PREFIX))


def text_number_flag(text: Column, states: Mapping[str, str] = FREIGHT_SENTINELS) -> Column:
    """Kind of a numeric-or-text cell: numeric, a named state, or a reference."""
    return F.when(is_reference(text), "reference").otherwise(
        sentinel_flag(text, states, default="numeric")
    )
