"""Derived columns: delays, cycle segments, unit freight, ratios, rare-category pooling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.functions.expressions import flag, log1p_floor0, log_floor, positive_part
from lanewise.operators.sharing import kept

SEGMENTS = ("c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total")


def delay_features(
    df: DataFrame, scheduled: str = "scheduled_date", delivered: str = "delivered_date"
) -> DataFrame:
    """``delay_days``, and the two-valued ``ot_bool`` (<= 0) and ``early_bool`` (< 0)."""
    days = F.datediff(delivered, scheduled)
    return df.withColumns({
        "delay_days": days, "ot_bool": flag(days <= 0), "early_bool": flag(days < 0),
    })


def cycle_features(
    df: DataFrame,
    quoted: str = "pq_date",
    ordered: str = "po_date",
    scheduled: str = "scheduled_date",
    delivered: str = "delivered_date",
) -> DataFrame:
    """Days of the three segments and of the whole cycle.

    The negative flag looks at c1, c2 and the total: an early delivery (negative c3) is
    no defect.
    """
    segments = {
        "c1_pq2po": F.datediff(ordered, quoted),
        "c2_po2sched": F.datediff(scheduled, ordered),
        "c3_sched2deliv": F.datediff(delivered, scheduled),
        "c_total": F.datediff(delivered, quoted),
    }
    negative = F.lit(False)
    for name in ("c1_pq2po", "c2_po2sched", "c_total"):
        negative = negative | flag(segments[name] < 0)
    return df.withColumns({**segments, "flag_negative_cycle": negative})


def unit_freight(
    df: DataFrame,
    freight: str = "freight_numeric",
    weight: str = "weight_numeric",
    extreme: float = 10_000,
) -> DataFrame:
    unit = F.try_divide(F.col(freight), F.col(weight))
    return df.withColumns({"unit_freight": unit, "flag_unit_freight_extreme": flag(unit > extreme)})


def calendar(df: DataFrame, date: str = "delivered_date") -> DataFrame:
    """Year and ``yyyy-MM`` month; both null for a missing date."""
    return df.withColumns({
        "delivery_year": F.year(date),
        "delivery_month": F.date_format(date, "yyyy-MM"),
    })


def month_start(month: str = "delivery_month") -> Column:
    """First day of a ``yyyy-MM`` month."""
    return F.try_to_date(F.col(month), "yyyy-MM")


def late_delay(df: DataFrame, delay: str = "delay_days", out: str = "late_delay") -> DataFrame:
    return df.withColumn(out, positive_part(F.col(delay)))


def log_features(
    df: DataFrame,
    unit: str = "unit_freight",
    weight: str = "weight_numeric",
    value: str = "line_value",
    year: str = "delivery_year",
    base_year: int = 2006,
) -> DataFrame:
    return df.withColumns({
        "log_uf": F.log1p(unit),
        "log_weight": log_floor(F.col(weight)),
        "log_value": log1p_floor0(F.col(value)),
        "year_c": F.col(year) - base_year,
    })


def insurance_rate(value: str = "line_value", insurance: str = "insurance") -> Column:
    """Insurance over value, where the value is above zero."""
    return F.when(F.col(value) > 0, F.try_divide(F.col(insurance), F.col(value)))


def freight_share(
    value: str = "line_value",
    freight: str = "freight_numeric",
    insurance: str | None = "insurance",
) -> Column:
    """Freight over value + freight (+ insurance); null where the sum is zero.

    With and without insurance are two different measures; pass ``insurance=None`` for
    the second.
    """
    whole = F.col(value) + F.col(freight)
    if insurance is not None:
        whole = whole + F.col(insurance)
    return F.try_divide(F.col(freight), whole)


def with_numeric_freight(
    df: DataFrame,
    value: str = "line_value",
    freight: str = "freight_numeric",
    insurance: str | None = "insurance",
    freight_flag: str = "freight_flag",
) -> DataFrame:
    """Rows the freight share is defined on: numeric freight, all parts known, value >= 0."""
    kept = df.where(F.col(freight_flag) == "numeric").where(F.col(value) >= 0)
    for part in [freight] + ([insurance] if insurance else []):
        kept = kept.where(F.col(part).isNotNull())
    return kept


def collapse_rare(
    df: DataFrame,
    category: str,
    min_n: int = 30,
    weight: str | None = None,
    label: str | None = None,
) -> DataFrame:
    """Pool categories with fewer than ``min_n`` rows under one label.

    ``weight`` is the number of rows one row stands for. The list of frequent categories is
    kept, so its size is known and Spark broadcasts it if small; the rows then stay where
    they are.
    """
    count = F.sum(weight) if weight else F.count(F.lit(1))
    frequent = (
        df.where(F.col(category).isNotNull()).groupBy(category).agg(count.alias("_rows"))
        .where(F.col("_rows") >= min_n).select(category, F.lit(True).alias("_frequent"))
    )
    pooled = F.lit(label or f"Other (<{min_n})")
    named = F.when(F.col("_frequent") | F.col(category).isNull(), F.col(category)).otherwise(pooled)
    return (
        df.join(kept(frequent), category, "left")
        .withColumn(category, named).select(*df.columns)
    )
