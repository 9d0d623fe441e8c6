"""Cross tables, top-n, semi joins and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.functions.expressions import exact_sum, percentile_weighted, row_count
from lanewise.operators.metrics import per_day
from lanewise.operators.sharing import kept


def semi_top_n(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a computed set."""
    return df.join(kept(keys.select(on)), on, "left_semi")


def abc_lookup(df: DataFrame, classes: DataFrame, vendor: str = "Vendor") -> DataFrame:
    """Attach each vendor's class; unknown vendors get null."""
    return df.join(kept(classes.select(vendor, "ABC")), vendor, "left")


def cell_mask(cells: DataFrame, value: str, n: str = "n", min_n: int = 30) -> DataFrame:
    """Blank a cell's value where too few rows stand behind it."""
    return cells.withColumn(value, F.when(F.col(n) >= min_n, F.col(value)))


def most_frequent(df: DataFrame, key: str, top: int, weight: str | None = None) -> DataFrame:
    """``(key, n)`` of the ``top`` keys with most rows, ties by key."""
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(row_count(weight).alias("n"))
        .orderBy(F.col("n").desc(), key).limit(top)
    )


def top_n_by_count(
    df: DataFrame,
    key: str,
    delay: str = "delay_days",
    top: int = 10,
    weight: str | None = None,
) -> DataFrame:
    """The most frequent keys, ordered by median delay."""
    counts = kept(per_day(df.where(F.col(key).isNotNull()), delay, key, weight=weight))
    sizes = counts.groupBy(key).agg(F.sum("_n").alias("n"))
    biggest = sizes.orderBy(F.col("n").desc(), key).limit(top)
    return (
        counts.join(F.broadcast(biggest), key).groupBy(key, "n")
        .agg(percentile_weighted(delay, 0.5, "_n").alias("median"))
        .select(key, "n", "median")
        .orderBy(F.col("median").asc_nulls_last(), key)
    )


def country_mode_heatmap(
    df: DataFrame,
    country: str = "Country",
    mode: str = "Shipment Mode",
    delay: str = "delay_days",
    min_n: int = 30,
    top: int = 15,
    weight: str | None = None,
) -> DataFrame:
    """``(country, mode, n, median_delay)`` of the countries with most rows.

    ``n`` counts rows without a delay too; thin cells are blanked, not dropped.
    """
    placed = df.where(F.col(country).isNotNull() & F.col(mode).isNotNull())
    counts = kept(per_day(placed, delay, country, mode, weight=weight))
    biggest = (
        counts.groupBy(country).agg(F.sum("_n").alias("rows"))
        .orderBy(F.col("rows").desc(), country).limit(top)
    )
    cells = (
        counts.join(F.broadcast(biggest.select(country)), country, "left_semi")
        .groupBy(country, mode)
        .agg(F.sum("_n").alias("n"), percentile_weighted(delay, 0.5, "_n").alias("median_delay"))
    )
    return cell_mask(cells, "median_delay", "n", min_n)


def cross_table(
    df: DataFrame,
    row: str,
    column: str,
    value: str,
    levels: Sequence[str] | None = None,
) -> DataFrame:
    """Summed value, one column per level of ``column``, absent cells 0.

    Without ``levels`` Spark looks them up first, within its pivot limit; ``cross_cells`` has
    no such limit.
    """
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    pivot = known.groupBy(row).pivot(column, list(levels) if levels else None)
    return pivot.agg(exact_sum(F.col(value))).na.fill(0.0)


def cross_cells(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """``(row, column, value)``: summed value of the cells that have rows, for any number of
    levels."""
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return known.groupBy(row, column).agg(exact_sum(F.col(value)).alias("value"))


def vendor_product_cells(
    df: DataFrame,
    ranked: DataFrame,
    vendor: str = "Vendor",
    product: str = "Product Group",
    value: str = "line_value",
    top: int = 8,
) -> DataFrame:
    """Value of the best-ranked vendors by product, as cells."""
    best = ranked.orderBy("rank").limit(top).select(vendor)
    return cross_cells(semi_top_n(df, best, vendor), vendor, product, value)


def vendor_product_cross(
    df: DataFrame,
    ranked: DataFrame,
    vendor: str = "Vendor",
    product: str = "Product Group",
    value: str = "line_value",
    top: int = 8,
    levels: Sequence[str] | None = None,
) -> DataFrame:
    """Value of the best-ranked vendors by product."""
    best = ranked.orderBy("rank").limit(top).select(vendor)
    return cross_table(semi_top_n(df, best, vendor), vendor, product, value, levels)


def cross_long(wide: DataFrame, row: str, column: str, value: str = "value") -> DataFrame:
    """A cross table as ``(row, column, value)``."""
    return wide.unpivot([row], [c for c in wide.columns if c != row], column, value)


def row_share(cells: DataFrame, row: str, value: str = "value", out: str = "share") -> DataFrame:
    """Each cell over the sum of its row of the cross table."""
    whole = F.sum(value).over(Window.partitionBy(row))
    return cells.withColumn(out, F.try_divide(F.col(value), whole))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def bottom_rows(ranked: DataFrame, n: int, position: str = "rank") -> DataFrame:
    """The last ``n`` rows of a ranked list, in list order."""
    return ranked.orderBy(F.col(position).desc()).limit(n).orderBy(position)
