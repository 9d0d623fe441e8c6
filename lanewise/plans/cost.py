"""Stage 3: freight distribution, unit freight, cost drivers, insurance, cost shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.operators.chartdata import box_stats, log_density
from lanewise.operators.metrics import (
    freight_overview,
    freight_share_by_mode,
    insurance_summary,
    unit_freight_by,
    yearly_cost_composition,
)
from lanewise.operators.quality import quantile_table
from lanewise.operators.regression import coef_order, ols_drivers
from lanewise.operators.stats import spearman
from lanewise.schema import Columns

# The quantiles of the report.
UNIT_FREIGHT_SHARES = (0.5, 0.75, 0.9, 0.95, 0.99, 0.999)


def cost_sheets(
    cleaned: DataFrame,
    columns: Columns = Columns(),
    base_mode: str = "Air",
    base_terms: str = "EXW",
    base_product: str = "ARV",
    extreme: float = 10_000,
) -> dict[str, DataFrame]:
    c = columns
    fit = ols_drivers(
        cleaned, (c.mode, base_mode), (c.terms, base_terms), (c.product, base_product),
        c.weight, c.value, c.unit_freight, c.year, c.freight_flag, extreme,
    )
    valued = cleaned.where(F.col(c.value) > 0)
    return {
        "freight_overview": freight_overview(cleaned, c.freight),
        "unit_freight_quantiles": quantile_table(cleaned, c.unit_freight, UNIT_FREIGHT_SHARES),
        "unit_freight_by_mode": unit_freight_by(cleaned, c.mode, c.unit_freight),
        "unit_freight_by_terms": unit_freight_by(cleaned, c.terms, c.unit_freight),
        "drivers": fit.coefficients,
        "drivers_summary": fit.summary,
        "drivers_ordered": coef_order(fit.coefficients),
        "insurance_summary": insurance_summary(cleaned, c.value, c.insurance),
        "value_insurance_rank_correlation": spearman(valued, c.value, c.insurance),
        "freight_share_by_mode": freight_share_by_mode(
            cleaned, c.mode, c.value, c.freight, c.insurance, c.freight_flag),
        "yearly_cost_composition": yearly_cost_composition(
            cleaned, c.year, c.value, c.freight, c.insurance, c.freight_flag),
        "freight_weight_density": log_density(cleaned, c.weight, c.freight, c.mode),
        "insurance_value_density": log_density(cleaned, c.value, c.insurance),
        "box_unit_freight_mode": box_stats(cleaned, c.mode, c.unit_freight),
        "box_unit_freight_terms": box_stats(cleaned, c.terms, c.unit_freight),
    }
