"""The aggregate behind each figure; nothing is drawn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.functions.expressions import clip, percentile_weighted, row_count
from lanewise.operators.metrics import day_counts
from lanewise.operators.ordering import BUCKETS, numeric_rows, value_summary
from lanewise.operators.sharing import kept


def histogram(
    df: DataFrame,
    value: str = "delay_days",
    low: int = -140,
    high: int = 160,
    width: int = 5,
    weight: str | None = None,
) -> DataFrame:
    """``(bin, start, n)`` of the clipped value; the last bin is closed on both sides."""
    bins = (high - low) // width
    clipped = clip(F.col(value), low, high)
    position = F.least(F.floor((clipped - low) / width), F.lit(bins - 1)).cast("int")
    counted = (
        df.where(F.col(value).isNotNull()).groupBy(position.alias("bin"))
        .agg(row_count(weight).alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    ).orderBy("bin")


def _boxes(points: DataFrame, value: str, weight, group: str) -> DataFrame:
    """Whiskers and outliers of points that carry their group's quartiles."""
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    at = F.col(value)
    inside = (at >= F.col("q1") - reach) & (at <= F.col("q3") + reach)
    table = points.groupBy(group, "q1", "median", "q3").agg(
        F.sum(weight).alias("n"),
        F.min(F.when(inside, at)).alias("_low"),
        F.max(F.when(inside, at)).alias("_high"),
        F.sum(F.when(inside, 0).otherwise(weight)).alias("outlier_n"),
    )
    return table.select(
        group, "n", "q1", "median", "q3",
        F.least(F.col("_low"), F.col("q1")).alias("whisker_low"),
        F.greatest(F.col("_high"), F.col("q3")).alias("whisker_high"),
        "outlier_n",
    )


def box_stats_days(
    df: DataFrame, group: str, days: str = "delay_days", weight: str | None = None
) -> DataFrame:
    """Box-plot numbers of a whole-day column, from counts per (group, day)."""
    counts = day_counts(df, group, days, weight)
    quartiles = counts.groupBy(group).agg(
        *[percentile_weighted(days, share, "n").alias(name)
          for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
    )
    return _boxes(counts.join(quartiles, group), days, F.col("n"), group)


def box_stats(df: DataFrame, group: str, value: str, buckets: int = BUCKETS) -> DataFrame:
    """Box-plot numbers of any numeric column."""
    rows = numeric_rows(df.where(F.col(group).isNotNull()), value).select(group, value)
    quartiles = value_summary(
        rows, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group], buckets=buckets
    ).select(group, "q1", "median", "q3")
    return _boxes(rows.join(kept(quartiles), group), value, F.lit(1), group)


def log_density(
    df: DataFrame, x: str, y: str, group: str | None = None, per_decade: int = 10
) -> DataFrame:
    """A log-log scatter as counts per cell, positive points only, with the group's n."""
    points = df.where((F.col(x) > 0) & (F.col(y) > 0))
    keys = []
    if group:
        points, keys = points.where(F.col(group).isNotNull()), [group]
    cells = points.groupBy(
        *keys,
        F.floor(F.log10(x) * per_decade).cast("int").alias("x_cell"),
        F.floor(F.log10(y) * per_decade).cast("int").alias("y_cell"),
    ).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return cells.withColumn("group_n", F.sum("n").over(whole))


def bubble_points(
    scored: DataFrame, vendor: str = "Vendor", low_score: float = 50, min_size: int = 10
) -> DataFrame:
    return scored.select(
        vendor, "otd", "value", clip(F.col("lines"), low=min_size).alias("size"), "score",
        (F.col("score") < low_score).alias("highlight"),
    )


def radar_points(
    scored: DataFrame,
    vendor: str = "Vendor",
    top: int = 6,
    parts: Sequence[str] = ("s_otd", "s_delay", "s_value", "s_freq"),
) -> DataFrame:
    """The best vendors' sub-scores, one row per vendor and part."""
    best = scored.orderBy("rank").limit(top)
    return best.select("rank", vendor, *parts).unpivot(
        ["rank", vendor], list(parts), "part", "score"
    )
