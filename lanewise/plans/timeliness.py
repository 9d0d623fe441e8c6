"""Stage 2: delay statistics, group tests, cycle segments, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.operators.chartdata import box_stats_days, histogram
from lanewise.operators.crosstab import (
    country_mode_heatmap,
    most_frequent,
    semi_top_n,
    top_n_by_count,
)
from lanewise.operators.cube import DayCube, day_cube
from lanewise.operators.features import SEGMENTS
from lanewise.operators.metrics import (
    delay_by_group,
    delay_overview,
    in_cycle,
    late_by_vendor,
    monthly_trend,
    segment_table,
)
from lanewise.operators.stats import kruskal_dunn, significant_pairs
from lanewise.schema import Columns


def timeliness_cube(cleaned: DataFrame, columns: Columns = Columns()) -> DayCube:
    """The day counts that this stage and the pivots read: one scan of the cleaned table."""
    c = columns
    return day_cube(
        cleaned,
        [(), (c.mode,), (c.product,), (c.country,), (c.terms,), (c.vendor,), (c.delivered,),
         (c.country, c.mode)],
        c.delay, SEGMENTS, {c.delivered: F.trunc(c.delivered, "MM")},
    )


def timeliness_sheets(
    cleaned: DataFrame, columns: Columns = Columns(), cube: DayCube | None = None
) -> dict[str, DataFrame]:
    """The stage's tables. Pass the ``cube`` if ``timeliness_cube`` was built already."""
    c = columns
    cube = cube or timeliness_cube(cleaned, columns)
    lines, modes, countries = cube.rows(), cube.rows(c.mode), cube.rows(c.country)
    segments = in_cycle(cube.stacked())
    sheets = {
        "delay_overview": delay_overview(lines, c.delay, "n"),
        "delay_histogram": histogram(lines, c.delay, weight="n"),
        "late_by_vendor": late_by_vendor(cube.rows(c.vendor), c.vendor, c.delay, weight="n"),
        "monthly_trend": monthly_trend(cube.rows(c.delivered), c.delivered, c.delay, "n"),
        "cycle_segments": segment_table(segments, "n"),
        "box_segments": box_stats_days(segments, "segment", "days", "n"),
        "box_mode": box_stats_days(modes, c.mode, c.delay, "n"),
        "country_order": top_n_by_count(countries, c.country, c.delay, weight="n"),
        "box_country": box_stats_days(
            semi_top_n(countries, most_frequent(countries, c.country, 10, "n"), c.country),
            c.country, c.delay, "n"),
        "country_mode_heatmap": country_mode_heatmap(
            cube.rows(c.country, c.mode), c.country, c.mode, c.delay, weight="n"),
    }
    # (grouping, smallest group of its own, pool the smaller ones)
    groupings = {
        "mode": (c.mode, 30, True),
        "product": (c.product, 30, False),
        "country": (c.country, 100, True),
        "terms": (c.terms, 30, True),
    }
    for name, (column, min_n, collapse) in groupings.items():
        counts = cube.known(column)
        tests = kruskal_dunn(
            cleaned, column, c.delay, min_n, collapse, counts=counts, whole_days=True)
        sheets[f"delay_by_{name}"] = delay_by_group(
            cleaned, column, c.delay, min_n, collapse, counts)
        sheets[f"kruskal_{name}"] = tests["test"]
        sheets[f"dunn_{name}"] = tests["pairs"]
        sheets[f"significant_{name}"] = significant_pairs(tests["pairs"])
    return sheets
