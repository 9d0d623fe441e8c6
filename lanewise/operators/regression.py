"""Least squares with categorical terms, from distributed cross moments."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.functions.tails import f_upper, t_quantile_two_sided, t_two_sided
from lanewise.operators.features import log_features
from lanewise.operators.ordering import BUCKETS, winsorize
from lanewise.operators.sharing import kept as kept_rows

INTERCEPT = "Intercept"
MAX_TERMS = 3000
_RESPONSE = "_response"


@dataclass(frozen=True)
class Fit:
    """``coefficients``: one row per term. ``summary``: one row."""

    coefficients: DataFrame
    summary: DataFrame


def regression_sample(
    df: DataFrame,
    weight: str = "weight_numeric",
    unit: str = "unit_freight",
    freight_flag: str = "freight_flag",
    extreme: float = 10_000,
) -> DataFrame:
    """Rows with a numeric freight, a weight and a plausible unit freight."""
    return df.where(
        (F.col(freight_flag) == "numeric")
        & F.col(weight).isNotNull()
        & (F.col(unit) <= extreme)
    )


def _complete(
    df: DataFrame, response: str, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """The categories and ``_x``: numbers and response, null unless the row is complete.

    Rows are marked rather than filtered: a filter would be pushed down as one more copy of
    every derived column it looks at.
    """
    numbers = [F.col(name).cast("double") for name in (*numeric, response)]
    known = reduce(Column.__add__, numbers) <= F.lit(math.inf)  # false for null and NaN
    for name in categorical:
        known = known & F.col(name).isNotNull()
    return df.select(*categorical, F.when(known, F.array(*numbers)).alias("_x"))


def level_cells(
    rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Per combination of levels: ``_n`` rows, means ``_a``, and sums of products ``_c`` about them.

    This is the only pass over the rows, and it combines before shuffling. Spark merges means
    and centred products pairwise, so a mean far from 0 costs no digits of the deviations.
    """
    x = [F.col("_x")[i] for i in range(len(numeric) + 1)]
    n = F.count("_x").cast("double")
    return rows.groupBy(*categorical).agg(
        n.alias("_n"),
        *[F.avg(number).alias(f"_a{i}") for i, number in enumerate(x)],
        *[(n * F.covar_pop(x[i], x[j])).alias(f"_c{i}_{j}")
          for i in range(len(x)) for j in range(i, len(x))],
    ).where(F.col("_n") > 0)


def cross_moments(
    cells: DataFrame, numeric: Sequence[str], categorical: Mapping[str, str],
    centre: Sequence[float],
) -> DataFrame:
    """``(term_a, term_b, moment)``, the non-zero upper part of [X y]'[X y].

    Numbers and response are taken less their ``centre``. Each combination of levels
    contributes to the handful of entries its own terms meet in, so the work does not grow
    with the number of levels.
    """
    off = [F.col(f"_a{i}") - F.lit(c) for i, c in enumerate(centre)]
    products = {
        (i, j): F.col(f"_c{i}_{j}") + F.col("_n") * off[i] * off[j]
        for i in range(len(off)) for j in range(i, len(off))
    }
    present: list[Column] = [F.lit(INTERCEPT)]
    for name, base in categorical.items():
        level = F.col(name).cast("string")
        present.append(
            F.when(level != base, F.concat(F.lit(f"{name}["), level, F.lit("]")))
        )
    names = [F.lit(n) for n in numeric] + [F.lit(_RESPONSE)]

    def entry(a: Column, b: Column, moment: Column) -> Column:
        return F.struct(a.alias("term_a"), b.alias("term_b"), moment.alias("moment"))

    entries = [
        entry(present[i], present[j], F.col("_n"))
        for i in range(len(present)) for j in range(i, len(present))
    ]
    entries += [
        entry(term, name, F.col("_n") * off[k]) for term in present for k, name in enumerate(names)
    ]
    entries += [entry(names[i], names[j], a) for (i, j), a in products.items()]
    return (
        cells.select(F.inline(F.array(*entries)))
        .where(F.col("term_a").isNotNull() & F.col("term_b").isNotNull())
        .groupBy("term_a", "term_b").agg(F.sum("moment").alias("moment"))
    )


def _solve(
    gram: np.ndarray, right: np.ndarray, centre: np.ndarray, mean: float, tss: float
) -> tuple[np.ndarray, np.ndarray, int, float]:
    """Coefficients, inverse, rank and residual sum; terms come less their ``centre``.

    Coefficients and inverse are returned for the terms as they are, of which the first is
    the intercept, and for the response with its ``mean``. If terms are collinear, the
    solution is that of minimum norm.
    """
    scale = 1 / np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    roots, vectors = np.linalg.eigh(gram * np.outer(scale, scale))
    vectors = vectors * scale[:, None]
    null = int(np.sum(roots <= 1e-11 * len(gram)))
    shift = np.eye(len(gram))
    shift[0] -= centre
    inverse = (vectors[:, null:] / roots[null:]) @ vectors[:, null:].T
    beta = inverse @ right
    if not null:
        beta = scale * np.linalg.solve(gram * np.outer(scale, scale), scale * right)
    rss = max(tss - 2 * beta @ right + beta @ gram @ beta, 0.0)
    whole = shift @ beta
    whole[0] += mean
    if null:
        # Back in the terms as they are, what lies along collinear combinations goes.
        along, _ = np.linalg.qr(shift @ vectors[:, :null])
        shift = shift - along @ (along.T @ shift)
        whole = whole - along @ (along.T @ whole)
    return whole, shift @ inverse @ shift.T, len(gram) - null, float(rss)


def ols(
    df: DataFrame,
    response: str,
    numeric: Sequence[str],
    categorical: Mapping[str, str],
    level: float = 0.95,
    max_terms: int = MAX_TERMS,
) -> Fit:
    """Ordinary least squares of ``response`` on dummies and numeric columns.

    ``categorical`` maps a column to its base level. Rows with any null are dropped. The rows
    are read once; residuals follow from the moments. Only the p x p moments reach the driver;
    more than ``max_terms`` terms are refused before anything is fetched.
    """
    spark = df.sparkSession
    rows = _complete(df, response, numeric, list(categorical))
    cells = kept_rows(level_cells(rows, numeric, list(categorical)))
    means = cells.agg(*(
        (F.sum(F.col("_n") * F.col(f"_a{i}")) / F.sum("_n")) for i in range(len(numeric) + 1)
    )).first()
    if means[0] is None:
        raise ValueError("no complete rows")
    limit = (max_terms + 1) * (max_terms + 2) // 2
    entries = cross_moments(cells, numeric, categorical, means).limit(limit + 1).collect()
    if len(entries) > limit:
        raise ValueError(f"more than {max_terms} terms")
    moments = {(e["term_a"], e["term_b"]): e["moment"] for e in entries}
    dummies = {term for pair in moments for term in pair} - {INTERCEPT, _RESPONSE, *numeric}
    terms = [INTERCEPT]
    for name in categorical:
        terms += sorted(t for t in dummies if t.startswith(f"{name}["))
    terms += list(numeric)

    def moment(a: str, b: str) -> float:
        return moments.get((a, b), moments.get((b, a), 0.0))

    gram = np.array([[moment(a, b) for b in terms] for a in terms])
    right = np.array([moment(a, _RESPONSE) for a in terms])
    n = int(moments[INTERCEPT, INTERCEPT])
    # A number without deviations has sums of rounding errors.
    for i, (name, mean) in enumerate(zip(numeric, means), len(terms) - len(numeric)):
        if moment(name, name) <= n * (1e-14 * mean) ** 2:
            gram[i, :] = gram[:, i] = right[i] = 0.0
    off = np.zeros(len(terms))
    off[len(terms) - len(numeric):] = means[:-1]
    tss = moment(_RESPONSE, _RESPONSE)
    beta, inverse, rank, rss = _solve(gram, right, off, means[-1], tss)

    df_resid, df_model = n - rank, rank - 1
    variance = rss / df_resid if df_resid > 0 else math.nan
    errors = np.sqrt(np.maximum(np.diag(inverse), 0.0) * variance)
    reach = t_quantile_two_sided(level, df_resid) if df_resid > 0 else math.nan
    coefficients = []
    for term, b, error in zip(terms, beta.tolist(), errors.tolist()):
        t = b / error if error > 0 else math.nan
        p = t_two_sided(t, df_resid) if df_resid > 0 and not math.isnan(t) else math.nan
        coefficients.append(
            (term, b, error, t, p, b - reach * error, b + reach * error,
             math.exp(b) if b < 709 else math.inf)
        )
    r2 = 1 - rss / tss if tss > 0 else math.nan
    f = math.nan
    if df_model > 0 and df_resid > 0 and rss > 0:
        f = (tss - rss) / df_model / variance
    summary = (
        n, len(terms), rank, rank < len(terms), df_model, df_resid, r2,
        1 - (1 - r2) * (n - 1) / df_resid if df_resid > 0 else math.nan,
        f, f_upper(f, df_model, df_resid) if not math.isnan(f) else math.nan, rss, tss,
    )
    return Fit(
        spark.createDataFrame(
            coefficients,
            "term string, coef double, std_err double, t double, p double, "
            "ci_low double, ci_high double, exp_coef double",
        ),
        spark.createDataFrame(
            [summary],
            "n long, terms int, rank int, collinear boolean, df_model long, df_resid long, "
            "r2 double, adj_r2 double, f double, f_p double, rss double, tss double",
        ),
    )


def ols_drivers(
    df: DataFrame,
    mode: tuple[str, str] = ("Shipment Mode", "Air"),
    terms: tuple[str, str] = ("Vendor INCO Term", "EXW"),
    product: tuple[str, str] = ("Product Group", "ARV"),
    weight: str = "weight_numeric",
    value: str = "line_value",
    unit: str = "unit_freight",
    year: str = "delivery_year",
    freight_flag: str = "freight_flag",
    extreme: float = 10_000,
    limit: float = 0.01,
    buckets: int = BUCKETS,
) -> Fit:
    """Drivers of log unit freight; each category comes with its reference level."""
    sample = regression_sample(df, weight, unit, freight_flag, extreme)
    sample = log_features(sample, unit, weight, value, year).select(
        mode[0], terms[0], product[0], "log_uf", "log_weight", "log_value", "year_c"
    )
    sample = kept_rows(sample)
    sample = winsorize(
        sample, {"log_weight": "log_weight_w", "log_value": "log_value_w"}, limit, buckets
    )
    return ols(
        sample, "log_uf", ["log_weight_w", "log_value_w", "year_c"],
        dict([mode, terms, product]),
    )


def coef_order(coefficients: DataFrame) -> DataFrame:
    """Coefficients from smallest to largest with the half-widths of their intervals."""
    return coefficients.select(
        "term", "coef",
        (F.col("coef") - F.col("ci_low")).alias("below"),
        (F.col("ci_high") - F.col("coef")).alias("above"),
    ).orderBy("coef", "term")
