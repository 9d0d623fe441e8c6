"""Vendor scorecard: normalisation, weighted score, rank, ABC classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.operators.crosstab import abc_lookup
from lanewise.operators.metrics import score_split, vendor_metrics
from lanewise.operators.ordering import row_position, running_share
from lanewise.operators.sharing import kept

# Fixed values of the score: weights of its parts, and cumulative shares that end classes.
WEIGHTS = {"otd": 0.40, "delay": 0.30, "value": 0.20, "freq": 0.10}
ABC_LIMITS = {"A": 0.70, "B": 0.90}


def minmax(df: DataFrame, columns: Mapping[str, str], inverted: Sequence[str] = ()) -> DataFrame:
    """Scale columns to 0-100; a constant column gives 100.

    ``columns`` maps each column to its output. For ``inverted`` ones the smallest value
    gets 100. The ends of all columns come from one aggregate.
    """
    ends = df.agg(F.struct(*[
        end(name).alias(f"{label}_{i}")
        for i, name in enumerate(columns) for label, end in (("low", F.min), ("high", F.max))
    ]).alias("ends")).scalar()
    scaled = {}
    for i, (name, out) in enumerate(columns.items()):
        low, high = ends[f"low_{i}"], ends[f"high_{i}"]
        offset = high - F.col(name) if name in inverted else F.col(name) - low
        scaled[out] = F.when(high > low, F.try_divide(offset, high - low) * 100).otherwise(100.0)
    return df.withColumns(scaled)


def score_parts(metrics: DataFrame) -> DataFrame:
    """The four parts of the score; on-time share enters as it is."""
    return minmax(
        metrics.withColumn("s_otd", F.col("otd")),
        {"avg_late": "s_delay", "value": "s_value", "lines": "s_freq"},
        inverted=["avg_late"],
    )


def weighted_score(parts: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    score = F.lit(0.0)
    for name, weight in weights.items():
        score = score + F.lit(float(weight)) * F.col(f"s_{name}")
    return parts.withColumn("score", score)


def score_rank(scored: DataFrame, vendor: str = "Vendor") -> DataFrame:
    """Row number by score, best first, ties by vendor."""
    return row_position(scored, [F.col("score").desc(), F.col(vendor)], "rank")


def abc_class(
    metrics: DataFrame, vendor: str = "Vendor", limits: Mapping[str, float] = ABC_LIMITS
) -> DataFrame:
    """Pareto classes over all vendors by cumulative value share, own value included."""
    ranked = running_share(metrics, "value", vendor, "cum_share")
    label = F.lit("C")
    for name, limit in reversed(list(limits.items())):
        label = F.when(F.col("cum_share") <= limit, name).otherwise(label)
    return ranked.withColumn("ABC", label)


def abc_summary(classes: DataFrame) -> DataFrame:
    """Per class: vendors, value, rows, share of the whole value."""
    value = F.col("value").cast("decimal(28,6)")
    total = classes.agg(F.sum(value).cast("double").alias("total")).scalar()
    table = classes.groupBy("ABC").agg(
        F.count(F.lit(1)).alias("vendors"),
        F.sum(value).cast("double").alias("value"),
        F.sum("lines").alias("lines"),
    )
    return table.withColumn("value_share", F.try_divide("value", total)).orderBy("ABC")


def scorecard(
    df: DataFrame,
    vendor: str = "Vendor",
    shipment: str = "ASN/DN #",
    delay: str = "delay_days",
    value: str = "line_value",
    min_lines: int = 10,
    weights: Mapping[str, float] = WEIGHTS,
    limits: Mapping[str, float] = ABC_LIMITS,
) -> dict[str, DataFrame]:
    """Scored vendors (14 columns), watch list (7 columns) and the ABC classes.

    The rows are read once: the vendor table is kept, everything after it is vendor-sized.
    """
    metrics = kept(vendor_metrics(df, vendor, shipment, delay, value))
    classes = abc_class(metrics, vendor, limits)
    scored, watch = score_split(metrics, min_lines)
    ranked = score_rank(weighted_score(score_parts(scored), weights), vendor)
    return {
        "scored": abc_lookup(ranked, classes, vendor).select(
            "rank", vendor, "ABC", "lines", "asn", "otd", "avg_late", "late_n", "value",
            "s_otd", "s_delay", "s_value", "s_freq", "score",
        ),
        "watch": abc_lookup(watch, classes, vendor).select(
            vendor, "ABC", "lines", "asn", "otd", "avg_late", "value"
        ),
        "classes": classes,
    }
