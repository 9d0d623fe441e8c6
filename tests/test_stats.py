"""Rank tests, correlation and regression against brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lanewise.functions import tails
from lanewise.operators import stats
from lanewise.operators.regression import coef_order, ols


@pytest.fixture(scope="module")
def delays():
    rng = np.random.default_rng(11)
    n = 1500
    group = np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b", "c"], n)).astype(object)
    group[:12] = "rare1"
    group[12:20] = "rare2"
    days = np.where(rng.random(n) < 0.4, 0.0, rng.integers(-30, 60, n))
    days = days + np.where(group == "a", 8, 0)
    days[rng.random(n) < 0.05] = np.nan
    group[rng.random(n) < 0.02] = None
    return pd.DataFrame({"g": group, "d": days})


@pytest.fixture(scope="module")
def df(spark, delays):
    rows = [(g, None if math.isnan(d) else int(d)) for g, d in delays.itertuples(index=False)]
    return spark.createDataFrame(rows, "g string, d int").cache()


def brute_force(frame):
    ranks = frame.d.rank()
    n = len(frame)
    ties = (frame.d.value_counts() ** 3 - frame.d.value_counts()).sum()
    sums = ranks.groupby(frame.g).agg(["sum", "size", "mean"])
    h = 12 / (n * (n + 1)) * (sums["sum"] ** 2 / sums["size"]).sum() - 3 * (n + 1)
    h /= 1 - ties / (n**3 - n)
    z = {}
    for a, b in itertools.combinations(sums.index, 2):
        variance = n * (n + 1) / 12 - ties / (12 * (n - 1))
        spread = math.sqrt(variance * (1 / sums["size"][a] + 1 / sums["size"][b]))
        z[a, b] = (sums["mean"][a] - sums["mean"][b]) / spread
    return h, z


@pytest.mark.parametrize("collapse", [True, False])
def test_kruskal_and_dunn(df, delays, many_buckets, collapse):
    frame = delays.dropna().copy()
    if collapse:
        size = frame.groupby("g").d.transform("size")
        frame["g"] = frame.g.where(size >= 30, "Other (<30)")
    h, z = brute_force(frame)
    found = stats.kruskal_dunn(df, "g", "d", collapse=collapse, buckets=16)
    test = found["test"].first()
    assert test["h"] == pytest.approx(h, rel=1e-9)
    assert (test["df"], test["n_total"]) == (frame.g.nunique() - 1, len(frame))
    assert test["p"] == pytest.approx(tails.chi2_upper(h, test["df"]), rel=1e-8)
    pairs = {(r["grp_a"], r["grp_b"]): r for r in found["pairs"].collect()}
    assert set(pairs) == set(z)
    p = sorted((tails.normal_two_sided(v), k) for k, v in z.items())
    q = 1.0
    for i in range(len(p) - 1, -1, -1):
        q = min(q, p[i][0] * len(p) / (i + 1))
        row = pairs[p[i][1]]
        assert row["z"] == pytest.approx(z[p[i][1]], rel=1e-9)
        assert row["p"] == pytest.approx(p[i][0], rel=1e-7)
        assert row["q"] == pytest.approx(q, rel=1e-7)
    kept = stats.significant_pairs(found["pairs"]).collect()
    assert [(r["grp_a"], r["grp_b"]) for r in kept] == sorted(
        k for k, r in pairs.items() if r["q"] < 0.05)


def test_no_pairs_without_overall_significance(spark):
    rows = [("a", i) for i in range(40)] + [("b", i) for i in range(40)]
    found = stats.kruskal_dunn(spark.createDataFrame(rows, "g string, d int"), "g", "d")
    assert found["test"].first()["p"] == pytest.approx(1.0)
    assert found["pairs"].count() == 0


@pytest.mark.parametrize("rows", [
    [("a", 1), ("a", 2)],                    # one group
    [("a", 5), ("b", 5), ("b", 5)],          # one value
])
def test_degenerate_tests_are_null(spark, rows):
    found = stats.kruskal_dunn(spark.createDataFrame(rows, "g string, d int"), "g", "d", min_n=1)
    row = found["test"].first()
    assert row["h"] is None and row["p"] is None
    assert found["pairs"].count() == 0


def test_group_pairs(spark):
    df = spark.createDataFrame([(c, i) for i, c in enumerate("cabd")], "grp string, v int")
    found = {(r["grp_a"], r["v_a"], r["grp_b"], r["v_b"]) for r in stats.group_pairs(df).collect()}
    order = {c: i for i, c in enumerate("cabd")}
    assert found == {(a, order[a], b, order[b]) for a, b in itertools.combinations("abcd", 2)}


def test_spearman(spark, many_buckets):
    rng = np.random.default_rng(5)
    x = np.round(rng.lognormal(2, 1, 800), 1)
    y = np.where(rng.random(800) < 0.4, 0.0, np.round(x * rng.random(800), 1))
    df = spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(x, y)] + [(1.0, None)], "x double, y double")
    found = stats.spearman(df, "x", "y", buckets=16).first()
    rho = np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1]
    assert found["n"] == 800
    assert found["rho"] == pytest.approx(rho, rel=1e-11)
    t = rho * math.sqrt(798 / (1 - rho * rho))
    assert found["p"] == pytest.approx(tails.t_two_sided(t, 798), rel=1e-8)


def test_spearman_of_equal_orders_and_of_constants(spark):
    df = spark.createDataFrame([(float(i), float(i * i), 1.0) for i in range(9)],
                               "x double, y double, c double")
    assert stats.spearman(df, "x", "y").first()["rho"] == 1.0
    assert stats.spearman(df, "x", "y").first()["p"] == 0.0
    assert stats.spearman(df, "x", "c").first()["rho"] is None


@pytest.fixture(scope="module")
def model_rows():
    rng = np.random.default_rng(2)
    n = 400
    frame = pd.DataFrame({
        "mode": rng.choice(["Air", "Ocean", "Truck"], n, p=[0.6, 0.3, 0.1]),
        "x": rng.normal(5, 2, n),
    })
    frame["y"] = 1 + 0.5 * frame.x - 2.0 * (frame["mode"] == "Ocean") + rng.normal(0, 1, n)
    return frame


def test_ols_matches_least_squares(spark, model_rows):
    df = spark.createDataFrame(
        [tuple(r) for r in model_rows.itertuples(index=False)] + [("Air", None, 1.0)],
        "mode string, x double, y double")
    fit = ols(df, "y", ["x"], {"mode": "Air"})
    found = {r["term"]: r for r in fit.coefficients.collect()}
    design = np.column_stack([
        np.ones(len(model_rows)), model_rows["mode"] == "Ocean", model_rows["mode"] == "Truck",
        model_rows.x]).astype(float)
    beta, rss, *_ = np.linalg.lstsq(design, model_rows.y.to_numpy(), rcond=None)
    error = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / 396)
    for i, term in enumerate(["Intercept", "mode[Ocean]", "mode[Truck]", "x"]):
        row = found[term]
        assert row["coef"] == pytest.approx(beta[i], rel=1e-9)
        assert row["std_err"] == pytest.approx(error[i], rel=1e-9)
        assert row["p"] == pytest.approx(tails.t_two_sided(beta[i] / error[i], 396), rel=1e-6)
        assert row["ci_high"] - row["coef"] == pytest.approx(1.9659737 * error[i], rel=1e-5)
    summary = fit.summary.first()
    assert (summary["n"], summary["rank"], summary["collinear"]) == (400, 4, False)
    tss = ((model_rows.y - model_rows.y.mean()) ** 2).sum()
    assert summary["r2"] == pytest.approx(1 - rss[0] / tss, rel=1e-10)
    ordered = [r["coef"] for r in coef_order(fit.coefficients).collect()]
    assert ordered == sorted(ordered)


def test_ols_agrees_with_spark_ml(spark, model_rows):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = spark.createDataFrame([tuple(r) for r in model_rows.itertuples(index=False)],
                               "mode string, x double, y double")
    fit = ols(df, "y", ["x"], {"mode": "Air"})
    found = {r["term"]: r["coef"] for r in fit.coefficients.collect()}
    wide = df.select("y", "x", *[(F.col("mode") == m).cast("double").alias(m)
                                 for m in ("Ocean", "Truck")])
    data = VectorAssembler(inputCols=["Ocean", "Truck", "x"], outputCol="features").transform(wide)
    model = LinearRegression(labelCol="y", solver="normal").fit(data)
    assert found["Intercept"] == pytest.approx(model.intercept, rel=1e-8)
    np.testing.assert_allclose(
        [found["mode[Ocean]"], found["mode[Truck]"], found["x"]], model.coefficients, rtol=1e-8)


def test_ols_survives_collinear_terms(spark):
    """A column that repeats another: smallest solution, lower rank, flagged."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=50)
    y = 3 + 2 * x + rng.normal(size=50)
    df = spark.createDataFrame([(float(a), float(a), float(b), "Air") for a, b in zip(x, y)],
                               "x1 double, x2 double, y double, mode string")
    fit = ols(df, "y", ["x1", "x2"], {"mode": "Air"})
    summary = fit.summary.first()
    assert summary["collinear"] and summary["rank"] == 2 and summary["df_resid"] == 48
    found = {r["term"]: r["coef"] for r in fit.coefficients.collect()}
    expected = np.linalg.pinv(np.column_stack([np.ones(50), x, x])) @ y
    np.testing.assert_allclose([found["Intercept"], found["x1"], found["x2"]], expected, rtol=1e-8)


def test_ols_keeps_its_digits_far_from_zero(spark):
    """Means a million times the deviations, a constant column and a rare level."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=600)
    mode = np.where(np.arange(600) % 50 == 0, "Truck", np.where(rng.random(600) < 0.4, "Air", "Ocean"))
    y = 0.7 * x + (mode == "Ocean") * 0.3 + rng.normal(size=600)
    far, high = x + 1e6, y + 1e6
    x, y = far - 1e6, high - 1e6  # as the stored numbers have them
    df = spark.createDataFrame(
        [(str(m), float(a), 5.5e5, float(b)) for m, a, b in zip(mode, far, high)],
        "mode string, x double, c double, y double").repartition(7)
    design = np.column_stack([np.ones(600), mode == "Ocean", mode == "Truck", x]).astype(float)
    beta, rss, *_ = np.linalg.lstsq(design, y, rcond=None)
    error = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / 596)
    fit = ols(df, "y", ["x"], {"mode": "Air"})
    found = {r["term"]: r for r in fit.coefficients.collect()}
    for i, term in enumerate(["Intercept", "mode[Ocean]", "mode[Truck]", "x"]):
        if i:
            assert found[term]["coef"] == pytest.approx(beta[i], rel=1e-9)
            assert found[term]["std_err"] == pytest.approx(error[i], rel=1e-9)
    whole = beta[0] + 1e6 - beta[3] * 1e6
    assert found["Intercept"]["coef"] == pytest.approx(whole, rel=1e-9)
    summary = fit.summary.first()
    assert (summary["rank"], summary["collinear"]) == (4, False)
    assert summary["rss"] == pytest.approx(rss[0], rel=1e-9)
    assert summary["tss"] == pytest.approx(((y - y.mean()) ** 2).sum(), rel=1e-9)
    # A column that is constant changes nothing but the rank's report.
    twin = ols(df, "y", ["x", "c"], {"mode": "Air"})
    summary = twin.summary.first()
    assert summary["collinear"] and summary["rank"] == 4
    found = {r["term"]: r["coef"] for r in twin.coefficients.collect()}
    assert found["x"] == pytest.approx(beta[3], rel=1e-9)


def test_ols_refuses_too_many_terms(spark):
    df = spark.range(200).select(
        F.concat(F.lit("l"), "id").alias("c"), F.rand(1).alias("x"), F.rand(2).alias("y"))
    with pytest.raises(ValueError, match="more than 5 terms"):
        ols(df, "y", ["x"], {"c": "l0"}, max_terms=5)


def test_ints_are_ranked_in_buckets_unless_they_are_days(spark, monkeypatch):
    def one_task(*_):
        raise AssertionError("all values in one task")

    rows = spark.createDataFrame(
        [("ab"[k % 2], k * 7919 % 500 if k % 9 else None) for k in range(2000)], "g string, d int")
    days = stats.rank_sums(rows, "g", "d", whole_days=True).orderBy("grp").collect()
    monkeypatch.setattr(stats, "_ranks_by_day", one_task)
    assert stats.rank_sums(rows, "g", "d").orderBy("grp").collect() == days
