"""Grouped measures of timeliness and cost.

Whole-day columns are first counted per (group, day), with a partial count in each task, and
percentiles are taken of these counts; the calendar bounds their number. With a ``weight`` the
rows given are counts themselves (``cube.DayCube.rows``). Money and ratios use ``value_summary``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.functions.expressions import (
    exact_sum,
    flag,
    fraction_true,
    percentile_weighted,
    positive_part,
    row_count,
)
from lanewise.operators.features import (
    SEGMENTS,
    collapse_rare,
    freight_share,
    insurance_rate,
    with_numeric_freight,
)
from lanewise.operators.ordering import BUCKETS, value_summary
from lanewise.operators.sharing import kept

MAX_CYCLE_DAYS = 2000


def per_day(
    df: DataFrame, days: str, *keys: str | Column, weight: str | None = None
) -> DataFrame:
    """``(keys, days, _n)``: how many rows each combination stands for, unknown days too."""
    return df.groupBy(*keys, days).agg(row_count(weight).alias("_n"))


def _rows(where: Column | None = None) -> Column:
    """Aggregate over counts: the rows they stand for, or those where a condition holds."""
    if where is None:
        return F.sum("_n")
    return F.coalesce(F.sum(F.when(where, F.col("_n"))), F.lit(0))


def _percent(where: Column) -> Column:
    return 100 * (_rows(where) / _rows())


def _mean(days: str) -> Column:
    known = F.col(days).isNotNull()
    return F.try_divide(F.sum(F.col(days) * F.col("_n")), F.sum(F.when(known, F.col("_n"))))


def _days(days: str, share: float) -> Column:
    return percentile_weighted(days, share, "_n")


def delay_overview(
    df: DataFrame, delay: str = "delay_days", weight: str | None = None
) -> DataFrame:
    """One row: on-time share of all rows, centre, early share, lateness of late rows."""
    days = F.col(delay)
    counts = per_day(df, delay, weight=weight).withColumn("_late", positive_part(days))
    return counts.agg(
        F.coalesce(_rows(), F.lit(0)).alias("n"),
        _rows(days.isNotNull()).alias("delay_n"),
        _rows(days <= 0).alias("on_time_n"),
        _percent(days <= 0).alias("otd_pct"),
        _mean(delay).alias("mean_delay"),
        _days(delay, 0.5).alias("median_delay"),
        _rows(days < 0).alias("early_n"),
        _percent(days < 0).alias("early_pct"),
        _rows(F.col("_late").isNotNull()).alias("late_n"),
        _days("_late", 0.5).alias("late_median"),
        _days("_late", 0.95).alias("late_p95"),
        _days("_late", 0.99).alias("late_p99"),
    )


def day_counts(
    df: DataFrame, group: str, delay: str = "delay_days", weight: str | None = None
) -> DataFrame:
    """``(group, delay, n)``: the only shuffle over rows that group tests and tables need."""
    known = df.where(F.col(group).isNotNull() & F.col(delay).isNotNull())
    return known.groupBy(group, delay).agg(row_count(weight).alias("n"))


def all_day_counts(
    df: DataFrame, groups: Sequence[str], delay: str = "delay_days"
) -> dict[str, DataFrame]:
    """``day_counts`` of several groupings from one pass: each row is listed once per grouping
    and counted in its task, so only counts per (grouping, group, day) are shuffled and kept."""
    types = dict(df.dtypes)
    listed = F.array(*[
        F.struct(F.lit(g).alias("grouping"), F.col(g).cast("string").alias("grp")) for g in groups
    ])
    counts = kept(
        df.where(F.col(delay).isNotNull()).select(F.inline(listed), delay)
        .where(F.col("grp").isNotNull())
        .groupBy("grouping", "grp", delay).agg(F.count(F.lit(1)).alias("n"))
    )
    return {
        group: counts.where(F.col("grouping") == group)
        .select(F.col("grp").cast(types[group]).alias(group), delay, "n")
        for group in groups
    }


def delay_by_group(
    df: DataFrame,
    group: str,
    delay: str = "delay_days",
    min_n: int = 30,
    collapse: bool = True,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Delay table over rows with a known delay; small groups pooled; best on-time first.

    Pass ``counts`` if ``day_counts`` of the same columns is at hand.
    """
    if counts is None:
        counts = day_counts(df, group, delay)
        counts = kept(counts) if collapse else counts
    if collapse:
        counts = collapse_rare(counts, group, min_n, weight="n")
    n, days = F.col("n"), F.col(delay)
    table = counts.groupBy(group).agg(
        F.sum(n).alias("n_rows"),
        percentile_weighted(delay, 0.5, "n").alias("median"),
        (F.sum(days * n) / F.sum(n)).alias("mean"),
        percentile_weighted(delay, 0.25, "n").alias("p25"),
        percentile_weighted(delay, 0.75, "n").alias("p75"),
        (100 * F.sum(F.when(days <= 0, n).otherwise(0)) / F.sum(n)).alias("otd_pct"),
    )
    return table.withColumnRenamed("n_rows", "n").orderBy(F.col("otd_pct").desc(), group)


def late_by_vendor(
    df: DataFrame,
    vendor: str = "Vendor",
    delay: str = "delay_days",
    min_n: int = 30,
    top: int = 10,
    weight: str | None = None,
) -> DataFrame:
    """Vendors with at least ``min_n`` late rows, most late rows first."""
    late = df.where((F.col(delay) > 0) & F.col(vendor).isNotNull())
    return (
        per_day(late, delay, vendor, weight=weight).groupBy(vendor)
        .agg(
            _rows().alias("late_n"),
            _days(delay, 0.5).alias("late_median"),
            _days(delay, 0.9).alias("late_p90"),
        )
        .where(F.col("late_n") >= min_n)
        .orderBy(F.col("late_n").desc(), vendor)
        .limit(top)
    )


def monthly_trend(
    df: DataFrame,
    delivered: str = "delivered_date",
    delay: str = "delay_days",
    weight: str | None = None,
) -> DataFrame:
    known = df.where(F.col(delay).isNotNull() & F.col(delivered).isNotNull())
    return (
        per_day(known, delay, F.trunc(delivered, "MM").alias("month"), weight=weight)
        .groupBy("month")
        .agg(
            _rows().alias("n"),
            _percent(F.col(delay) <= 0).alias("otd_pct"),
            _days(delay, 0.5).alias("median"),
        )
        .orderBy("month")
    )


def segment_rows(
    df: DataFrame,
    segments: Sequence[str] = SEGMENTS,
    max_days: int = MAX_CYCLE_DAYS,
    keep: Column | None = None,
) -> DataFrame:
    """Segments stacked as ``(segment, days)`` from one scan, 0 <= days < ``max_days``."""
    if keep is not None:
        df = df.where(keep)
    stacked = df.select(*segments).unpivot([], list(segments), "segment", "days")
    return in_cycle(stacked, max_days)


def in_cycle(stacked: DataFrame, max_days: int = MAX_CYCLE_DAYS) -> DataFrame:
    return stacked.where((F.col("days") >= 0) & (F.col("days") < max_days))


def cycle_segments(
    df: DataFrame,
    segments: Sequence[str] = SEGMENTS,
    max_days: int = MAX_CYCLE_DAYS,
    keep: Column | None = None,
) -> DataFrame:
    """Per segment: n, median, mean, quartiles. ``keep`` optionally restricts the rows."""
    return segment_table(segment_rows(df, segments, max_days, keep))


def segment_table(stacked: DataFrame, weight: str | None = None) -> DataFrame:
    """``cycle_segments`` of segments that are stacked already."""
    counts = per_day(stacked, "days", "segment", weight=weight)
    return counts.groupBy("segment").agg(
        _rows().alias("n"),
        _days("days", 0.5).alias("median"),
        _mean("days").alias("mean"),
        _days("days", 0.25).alias("p25"),
        _days("days", 0.75).alias("p75"),
    )


def freight_overview(
    df: DataFrame,
    freight: str = "freight_numeric",
    outlier: str = "flag_freight_numeric_outlier",
    buckets: int = BUCKETS,
) -> DataFrame:
    outliers = flag(F.col(outlier)).cast("long")
    return value_summary(
        df, freight, {"median": 0.5, "p95": 0.95}, sums={"outlier_n": outliers}, buckets=buckets
    ).select("n", "median", "mean", "p95", "max", "outlier_n")


def unit_freight_by(
    df: DataFrame, group: str, unit: str = "unit_freight", buckets: int = BUCKETS
) -> DataFrame:
    table = value_summary(df, unit, {"median": 0.5, "p90": 0.9}, [group], buckets=buckets)
    return table.select(group, "n", "median", "mean", "p90").orderBy("median", group)


def insurance_summary(
    df: DataFrame,
    value: str = "line_value",
    insurance: str = "insurance",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Over rows with a value above zero: insured and uninsured rows, median rate."""
    kept = df.where((F.col(value) > 0) & F.col(insurance).isNotNull())
    return value_summary(
        kept.withColumn("_rate", insurance_rate(value, insurance)), "_rate",
        {"median_rate": 0.5},
        sums={
            "nonzero_n": (F.col(insurance) > 0).cast("long"),
            "zero_n": (F.col(insurance) == 0).cast("long"),
        },
        buckets=buckets,
    ).select("nonzero_n", "zero_n", "median_rate")


def freight_share_by_mode(
    df: DataFrame,
    mode: str = "Shipment Mode",
    value: str = "line_value",
    freight: str = "freight_numeric",
    insurance: str = "insurance",
    freight_flag: str = "freight_flag",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Freight share with insurance: one row per mode, and one over all rows (null mode).

    ``n`` counts the rows of the measure, ``median`` and ``mean`` skip undefined shares.
    Both levels come out of the same pass: every row is listed under its mode and in total.
    """
    kept = with_numeric_freight(df, value, freight, insurance, freight_flag)
    share = freight_share(value, freight, insurance)
    levels = F.array(
        F.struct(F.lit(True).alias("overall"), F.lit("").alias("level")),
        F.struct(F.lit(False).alias("overall"), F.col(mode).alias("level")),
    )
    listed = kept.select(share.alias("_share"), F.inline(levels)).where(
        F.col("level").isNotNull()
    )
    keys = ["overall", "level"]
    sizes = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    table = value_summary(listed, "_share", {"median": 0.5}, keys, buckets=buckets)
    named = F.when(~F.col("overall"), F.col("level")).alias(mode)
    return (
        sizes.join(table, keys, "left")
        .select(named, F.col("rows").alias("n"), "median", "mean")
        .orderBy(F.col("median").asc_nulls_last(), mode)
    )


def yearly_cost_composition(
    df: DataFrame,
    year: str = "delivery_year",
    value: str = "line_value",
    freight: str = "freight_numeric",
    insurance: str = "insurance",
    freight_flag: str = "freight_flag",
) -> DataFrame:
    kept = with_numeric_freight(df, value, freight, insurance, freight_flag)
    return (
        kept.where(F.col(year).isNotNull())
        .groupBy(year)
        .agg(
            exact_sum(F.col(value)).alias("commodity"),
            exact_sum(F.col(freight)).alias("freight"),
            exact_sum(F.col(insurance)).alias("insurance"),
        )
        .orderBy(year)
    )


def vendor_metrics(
    df: DataFrame,
    vendor: str = "Vendor",
    shipment: str = "ASN/DN #",
    delay: str = "delay_days",
    value: str = "line_value",
    shipment_error: float | None = None,
) -> DataFrame:
    """Per vendor: rows, shipments, on-time share of all rows, mean lateness, late rows, value.

    With a ``shipment_error`` (a relative standard deviation such as 0.02) shipments are counted
    approximately, by sketches that merge per vendor without a shuffle of shipments. Else the
    distinct count is taken in two steps - rows are first merged per vendor and
    shipment - so a vendor with a large part of the rows is spread over its shipments.
    """
    days, late = F.col(delay), positive_part(F.col(delay))
    rows = df.where(F.col(vendor).isNotNull())
    if shipment_error is None:
        by_shipment, shipments = rows.groupBy(vendor, shipment), F.count(shipment)
    else:
        sketched = rows.groupBy(vendor).agg(
            F.approx_count_distinct(shipment, shipment_error).alias("_shipments"))
        by_shipment = rows.groupBy(vendor)
        shipments = F.first("_shipments")
    by_shipment = by_shipment.agg(
        F.count(F.lit(1)).alias("_lines"),
        F.count_if(days <= 0).alias("_on_time"),
        F.sum(late).alias("_late_days"),
        F.count(late).alias("_late_n"),
        F.sum(F.col(value).cast("decimal(28,6)")).alias("_value"),
    )
    if shipment_error is not None:
        by_shipment = by_shipment.join(sketched, vendor)
    totals = by_shipment.groupBy(vendor).agg(
        F.sum("_lines").alias("lines"),
        shipments.alias("asn"),
        F.sum("_on_time").alias("_on_time"),
        F.sum("_late_days").alias("_late_days"),
        F.sum("_late_n").alias("late_n"),
        F.coalesce(F.sum("_value").cast("double"), F.lit(0.0)).alias("value"),
    )
    return totals.select(
        vendor, "lines", "asn",
        (100 * F.col("_on_time") / F.col("lines")).alias("otd"),
        F.coalesce(F.try_divide("_late_days", "late_n"), F.lit(0.0)).alias("avg_late"),
        "late_n", "value",
    )


def score_split(metrics: DataFrame, min_lines: int = 10) -> tuple[DataFrame, DataFrame]:
    """Vendors with enough rows to be scored, and the watch list."""
    return metrics.where(F.col("lines") >= min_lines), metrics.where(F.col("lines") < min_lines)


def otd_by(
    df: DataFrame,
    group: str,
    delay: str = "delay_days",
    min_n: int = 0,
    with_mean: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Summary pivot: n counts all rows of the group, also those without a delay."""
    measures = [
        _rows().alias("n"),
        _percent(F.col(delay) <= 0).alias("otd_pct"),
        _days(delay, 0.5).alias("median_delay"),
    ]
    if with_mean:
        measures.append(_mean(delay).alias("mean_delay"))
    counts = per_day(df.where(F.col(group).isNotNull()), delay, group, weight=weight)
    table = counts.groupBy(group).agg(*measures)
    return table.where(F.col("n") >= min_n).orderBy(F.col("otd_pct").desc(), group)


def unit_freight_pivot(
    df: DataFrame, mode: str = "Shipment Mode", unit: str = "unit_freight", buckets: int = BUCKETS
) -> DataFrame:
    table = value_summary(df, unit, {"median_usd_kg": 0.5, "p90_usd_kg": 0.9}, [mode],
                          buckets=buckets)
    return table.select(mode, "n", "median_usd_kg", "p90_usd_kg")


def cycle_pivot(df: DataFrame, segments: Sequence[str] = SEGMENTS) -> DataFrame:
    return segment_pivot(segment_rows(df, segments))


def segment_pivot(stacked: DataFrame, weight: str | None = None) -> DataFrame:
    return segment_table(stacked, weight).select("segment", "n", "median", "mean")


def supplier_summary(
    df: DataFrame,
    vendor: str = "Vendor",
    delay: str = "delay_days",
    value: str = "line_value",
    min_lines: int = 10,
) -> DataFrame:
    """Vendors by value; unlike the scorecard, never-late vendors keep a null lateness."""
    days = F.col(delay)
    table = df.where(F.col(vendor).isNotNull()).groupBy(vendor).agg(
        F.count(F.lit(1)).alias("lines"),
        (100 * fraction_true(days <= 0)).alias("otd_pct"),
        F.avg(positive_part(days)).alias("avg_late_days"),
        exact_sum(F.col(value)).alias("value"),
    )
    return table.where(F.col("lines") >= min_lines).orderBy(F.col("value").desc(), vendor)


def freight_share_pivot(
    df: DataFrame,
    mode: str = "Shipment Mode",
    value: str = "line_value",
    freight: str = "freight_numeric",
    freight_flag: str = "freight_flag",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Freight share without insurance, in percent."""
    kept = with_numeric_freight(df, value, freight, None, freight_flag)
    kept = kept.where(F.col(mode).isNotNull())
    sizes = kept.groupBy(mode).agg(F.count(F.lit(1)).alias("rows"))
    shares = kept.withColumn("_pct", 100 * freight_share(value, freight, None))
    table = value_summary(shares, "_pct", {"median_pct": 0.5}, [mode], buckets=buckets)
    return sizes.join(table, mode, "left").select(
        mode, F.col("rows").alias("n"), "median_pct"
    )
