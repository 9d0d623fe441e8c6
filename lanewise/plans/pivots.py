"""Stage 5: the seven summary pivots, rounded for reading where asked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.operators.cube import DayCube, day_cube
from lanewise.operators.features import SEGMENTS
from lanewise.operators.metrics import (
    freight_share_pivot,
    in_cycle,
    otd_by,
    segment_pivot,
    supplier_summary,
    unit_freight_pivot,
)
from lanewise.schema import Columns


def rounded(df: DataFrame, places: int = 2) -> DataFrame:
    """Half-even rounding of every double column; for report views only."""
    return df.withColumns({
        f.name: F.bround(f.name, places)
        for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)
    })


def pivot_sheets(
    cleaned: DataFrame, columns: Columns = Columns(), cube: DayCube | None = None
) -> dict[str, DataFrame]:
    """The pivots. Pass the ``cube`` if ``timeliness.timeliness_cube`` was built already."""
    c = columns
    cube = cube or day_cube(cleaned, [(c.mode,), (c.product,), (c.country,)], c.delay, SEGMENTS)

    def on_time(group: str, **options) -> DataFrame:
        return otd_by(cube.rows(group), group, c.delay, weight="n", **options)

    return {
        "otd_by_mode": on_time(c.mode, with_mean=True),
        "otd_by_product": on_time(c.product),
        "otd_by_country": on_time(c.country, min_n=100),
        "unit_freight_pivot": unit_freight_pivot(cleaned, c.mode, c.unit_freight),
        "cycle_pivot": segment_pivot(in_cycle(cube.stacked()), "n"),
        "supplier_summary": supplier_summary(cleaned, c.vendor, c.delay, c.value),
        "freight_share_pivot": freight_share_pivot(
            cleaned, c.mode, c.value, c.freight, c.freight_flag),
    }
