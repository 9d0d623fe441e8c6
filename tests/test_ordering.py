"""Order statistics, ranks and running totals against brute force, with hot values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lanewise.operators import ordering
from lanewise.operators.stats import bh_fdr


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows in one group, a third with one value, nulls and infinite ends."""
    rng = np.random.default_rng(7)
    n = 3000
    value = np.where(rng.random(n) < 0.34, 0.0, np.round(rng.lognormal(3, 2, n), 2))
    value[rng.random(n) < 0.1] *= -1
    frame = pd.DataFrame({
        "i": np.arange(n),
        "g": np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcde"), n)),
        "v": value,
    })
    frame.loc[rng.random(n) < 0.05, "v"] = np.nan
    frame.loc[rng.random(n) < 0.03, "g"] = None
    tiny = pd.DataFrame({"i": [n, n + 1, n + 2], "g": ["one", "two", "two"],
                         "v": [5.0, 1.0, 2.0]})
    return pd.concat([frame, tiny], ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, skewed):
    rows = [
        (int(r.i), r.g if isinstance(r.g, str) else None, None if pd.isna(r.v) else float(r.v))
        for r in skewed.itertuples()
    ]
    return spark.createDataFrame(rows, "i long, g string, v double").cache()


SHARES = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p999": 0.999}


@pytest.mark.parametrize("small", [True, False])
def test_value_summary(df, skewed, many_buckets, small, request):
    if not small:
        request.getfixturevalue("nothing_small")
    found = ordering.value_summary(
        df, "v", SHARES, ["g"], sums={"zeros": (F.col("v") == 0).cast("long")}, buckets=16
    ).toPandas().set_index("g").sort_index()
    groups = skewed.dropna().groupby("g").v
    assert list(found.index) == sorted(groups.groups)
    for name, share in SHARES.items():
        np.testing.assert_allclose(found[name], groups.quantile(share), rtol=1e-10, atol=1e-10)
    np.testing.assert_allclose(found["mean"], groups.mean(), rtol=1e-12)
    assert (found["n"] == groups.size()).all()
    assert (found["max"] == groups.max()).all() and (found["min"] == groups.min()).all()
    assert (found["zeros"] == groups.apply(lambda s: (s == 0).sum())).all()


@pytest.mark.parametrize("buckets", [2, 64, 1024])
def test_whole_column_summary_does_not_depend_on_buckets(df, skewed, many_buckets, buckets):
    row = ordering.value_summary(df.repartition(7), "v", SHARES, buckets=buckets).first()
    values = skewed.v.dropna()
    assert row["n"] == len(values)
    for name, share in SHARES.items():
        assert row[name] == pytest.approx(values.quantile(share), rel=1e-10, abs=1e-10)


def test_summary_of_nothing(df):
    assert ordering.value_summary(df.where("i < 0"), "v", SHARES).count() == 0
    assert ordering.value_summary(df.where("i < 0"), "v", SHARES, ["g"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_average_ranks(df, skewed, many_buckets, partitions):
    found = ordering.value_ranks(df.repartition(partitions), "v", buckets=32).toPandas()
    values = skewed.v.dropna()
    expected = pd.DataFrame({"v": values, "r": values.rank()}).groupby("v").r.agg(["first", "size"])
    found = found.set_index("v").sort_index()
    assert (found.index == expected.index).all()
    assert (found["avg_rank"] == expected["first"]).all()
    assert (found["n"] == expected["size"]).all()
    n = len(values)
    assert (found["avg_rank"] * found["n"]).sum() == n * (n + 1) / 2


def test_negative_zero_is_zero(spark, many_buckets):
    df = spark.createDataFrame([(-0.0,), (0.0,), (1.0,)], "v double")
    found = {r["v"]: (r["n"], r["avg_rank"]) for r in ordering.value_ranks(df, "v").collect()}
    assert found == {0.0: (2, 1.5), 1.0: (1, 3.0)}


def test_running_share_splits_ties(spark):
    rows = [(f"k{i:03d}", 10.0 if i < 60 else float(i)) for i in range(100)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, value double").repartition(5)
    found = ordering.running_share(df, "value", "k", position="position").toPandas()
    order = sorted(rows, key=lambda r: (-(r[1] or 0), r[0]))
    found = found.sort_values("position")
    assert list(found["position"]) == list(range(1, 102))
    assert list(found["k"]) == [r[0] for r in order]
    total = sum(r[1] or 0 for r in rows)
    expected = np.cumsum([r[1] or 0 for r in order]) / total
    np.testing.assert_allclose(found["cum_share"], expected, rtol=1e-12)
    assert found["cum_share"].is_monotonic_increasing


def test_running_total_uses_several_tasks(spark):
    """The sort is cut into partitions and stays correct across them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select((F.col("id") % 3).alias("v"), F.col("id").alias("k"))
        rows = ordering.running_total(df, [F.col("v"), F.col("k")], {"t": F.lit(1)})
        found = rows.orderBy("v", "k").toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert list(found["t"]) == list(range(1, 1001))


def test_winsorize_takes_order_statistics(df, skewed, many_buckets):
    found = ordering.winsorize(df, {"v": "w"}, buckets=16).select("v", "w").toPandas()
    values = np.sort(skewed.v.dropna())
    k = int(0.01 * len(values))
    low, high = values[k], values[len(values) - k - 1]
    expected = found["v"].clip(low, high)
    pd.testing.assert_series_equal(found["w"], expected, check_names=False)
    assert {low, high} <= set(values)


@pytest.mark.parametrize("small", [True, False])
def test_bh_matches_step_up(spark, many_buckets, small, request):
    if not small:
        request.getfixturevalue("nothing_small")
    rng = np.random.default_rng(3)
    p = np.where(rng.random(600) < 0.4, 1.0, np.round(rng.random(600), 3))
    test = np.where(rng.random(600) < 0.6, "hot", rng.choice(["x", "y"], 600))
    rows = list(zip(range(600), test.tolist(), p.tolist()))
    df = spark.createDataFrame(rows, "i int, t string, p double")
    found = bh_fdr(df, "p", "t", buckets=16).toPandas().set_index("i")
    assert len(found) == 600
    for _, part in pd.DataFrame(rows, columns=["i", "t", "p"]).groupby("t"):
        ordered = part.sort_values("p")
        step = ordered.p * len(ordered) / np.arange(1, len(ordered) + 1)
        q = step[::-1].cummin()[::-1].clip(upper=1)
        np.testing.assert_allclose(found.loc[ordered.i, "q"], q, rtol=1e-12)
    assert (found["q"] >= found["p"]).all()


def test_approximate_quantiles_and_counts(spark):
    from lanewise.operators.metrics import vendor_metrics
    from lanewise.operators.ordering import value_summary

    rows = spark.createDataFrame(
        [("a" if k % 3 else "b", float(k), k // 2, k % 5 - 2, 1.0) for k in range(3000)],
        "g string, v double, s int, d int, w double")
    exact = {r["g"]: r for r in value_summary(rows, "v", {"m": 0.5}, ["g"]).collect()}
    near = {r["g"]: r for r in value_summary(rows, "v", {"m": 0.5}, ["g"], accuracy=1000).collect()}
    for g in exact:
        assert exact[g]["n"] == near[g]["n"] and abs(exact[g]["m"] - near[g]["m"]) < 12
    exact = {r["g"]: r for r in vendor_metrics(rows, "g", "s", "d", "w").collect()}
    near = {r["g"]: r for r in vendor_metrics(rows, "g", "s", "d", "w", 0.02).collect()}
    for g in exact:
        assert abs(exact[g]["asn"] - near[g]["asn"]) <= 0.1 * exact[g]["asn"]
        assert [exact[g][c] for c in ("lines", "otd", "value")] == [
            near[g][c] for c in ("lines", "otd", "value")]


def test_no_side_of_many_partitions_meets_in_one_task(spark):
    """What is kept goes to files: no exchange into one partition gets more than a row a task."""
    from lanewise.operators.features import collapse_rare

    rows = spark.range(200_000, numPartitions=40).selectExpr("id % 7 AS c", "id")
    out = collapse_rare(rows.selectExpr("cast(c AS string) c", "id"), "c", 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "LocalTableScan" not in plan
    assert out.count() == 200_000


def test_release_removes_what_was_kept(spark):
    from lanewise.operators import sharing

    table = sharing.kept(spark.range(10).toDF("x"))
    assert table.count() == 10
    assert sharing.release(spark) >= 1 and not sharing._made
