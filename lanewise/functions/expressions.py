"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """Two-valued boolean: an unknown comparison counts as False."""
    return F.coalesce(condition, F.lit(False))


def fraction_true(condition: Column) -> Column:
    """Aggregate: share of *all* rows for which the condition holds."""
    return F.avg(flag(condition).cast("double"))


def clip(value: Column, low=None, high=None) -> Column:
    """Clamp to bounds; null stays null (bare ``greatest`` would return the bound)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def positive_part(value: Column) -> Column:
    """The value where it is above zero, else null (lateness of late rows)."""
    return F.when(value > 0, value)


def row_count(weight: str | None = None) -> Column:
    """Aggregate: the number of rows, or of rows that counts in ``weight`` stand for."""
    return F.count(F.lit(1)) if weight is None else F.sum(F.col(weight))


def exact_sum(value: Column) -> Column:
    """Aggregate: sum independent of row order, 0 for an all-null group.

    Money is added as decimal so partitioning cannot move a total across a class border.
    """
    return F.coalesce(F.sum(value.cast("decimal(28,6)")).cast("double"), F.lit(0.0))


def log1p_floor0(value: Column) -> Column:
    return F.log1p(clip(value.cast("double"), low=0.0))


def log_floor(value: Column, floor: float = 1e-6) -> Column:
    return F.log(clip(value.cast("double"), low=floor))


def sql_name(column: str) -> str:
    """Back-quoted column name for SQL expression text."""
    return "`" + column.replace("`", "``") + "`"


def percentile_weighted(value: str, share: float, weight: str) -> Column:
    """Aggregate: interpolated quantile of a value that occurs ``weight`` times.

    Its state is one entry per distinct value, so use it on bounded domains such as
    whole days; continuous columns go through ``operators.ordering.value_summary``.
    """
    return F.percentile(F.col(value), F.lit(share), F.col(weight))
