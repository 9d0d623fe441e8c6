"""Stage 4: scorecard, ABC classes, vendor by product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.operators.chartdata import bubble_points, radar_points
from lanewise.operators.crosstab import (
    bottom_rows,
    row_share,
    top_rows,
    vendor_product_cells,
)
from lanewise.operators.scoring import abc_summary, scorecard
from lanewise.operators.sharing import kept
from lanewise.schema import Columns


def supplier_sheets(
    cleaned: DataFrame, columns: Columns = Columns(), min_lines: int = 10
) -> dict[str, DataFrame]:
    c = columns
    card = scorecard(cleaned, c.vendor, c.shipment, c.delay, c.value, min_lines)
    scored = card["scored"]
    cells = kept(vendor_product_cells(cleaned, scored, c.vendor, c.product, c.value))
    return {
        "scorecard": scored.orderBy("rank"),
        "scorecard_top": top_rows(scored, [F.col("rank")], 20),
        "scorecard_bottom": bottom_rows(scored, 10),
        "watch_list": card["watch"],
        "abc_summary": abc_summary(card["classes"]),
        "vendor_product": cells,
        "vendor_product_share": row_share(cells, c.vendor),
        "bubble": bubble_points(scored, c.vendor),
        "radar": radar_points(scored, c.vendor),
    }
