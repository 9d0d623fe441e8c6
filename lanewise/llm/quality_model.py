"""Quality score from a sparse ensemble of rules over text statistics.

Trees of a small random forest give the rules: every path from a root to a node is a conjunction
of comparisons. A lasso logistic regression over the rules and the statistics themselves keeps
the few that matter. The result is one Spark column expression, so scoring is a projection.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.staging import written
from lanewise.llm.statistics import SHARES, one_label, share_columns, text_statistics

TREES, DEPTH = 20, 3
LASSO = 0.0005
#: Labelled rows to fit on; of more, a share is taken by a hash of the id.
FIT_ROWS = 200_000
THRESHOLD = 0.3
FEATURES = [*SHARES, "log_words", "longest"]


def held_out() -> Column:
    """Documents whose labels are never learned from; a null id is not held out."""
    return F.coalesce(
        F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0,
        F.lit(False),
    )


def tree_rules(description: str) -> list[str]:
    """Every path of a described forest, as an SQL condition over ``FEATURES``; without repeats."""
    rules: dict[str, None] = {}
    path: list[str] = []
    base = 0
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        if line.strip().startswith("Tree"):
            base, path = depth, []
        found = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line)
        if not found:
            continue
        path = path[: depth - base - 1]
        feature, sign, value = found.groups()
        path.append(f"{FEATURES[int(feature)]} {sign} {float(value)!r}D")
        rules.setdefault(" AND ".join(sorted(set(path))))
    return list(rules)


def fit(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Column:
    """The score as a column over ``FEATURES``; ``labelled`` has these and label (0 or 1)."""
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    good, total = counts.get(1, 0), sum(counts.values())
    if not 0 < good < total:
        return F.lit((good + 1.0) / (total + 2.0))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=3, subsamplingRate=0.7, featureSubsetStrategy="0.5",
        minInstancesPerNode=max(1, min(20, total // 200)),
    ).fit(rows)
    conditions = tree_rules(forest.toDebugString)
    spans = labelled.agg(*(
        F.percentile_approx(f, [0.02, 0.98], 1000).alias(f) for f in FEATURES
    )).first()
    terms = [f"cast({rule} as double)" for rule in conditions]
    for f in FEATURES:
        low, high = spans[f]
        if high > low:
            terms.append(f"(greatest({low!r}D, least({high!r}D, {f})) - {low!r}D)"
                         f" / {high - low!r}D")
    facts = labelled.select(
        F.col("label").cast("double").alias("label"),
        F.array(*(F.expr(t) for t in terms)).alias("terms"),
    )
    from pyspark.ml.functions import array_to_vector

    model = LogisticRegression(
        featuresCol="terms", elasticNetParam=1.0, regParam=LASSO, maxIter=60,
        standardization=False,
    ).fit(facts.withColumn("terms", array_to_vector("terms")))
    total_weight = F.lit(float(model.intercept))
    for term, weight in zip(terms, model.coefficients.toArray(), strict=True):
        if weight:
            total_weight = total_weight + F.lit(float(weight)) * F.expr(term)
    return 1 / (1 + F.exp(-total_weight))


def quality_model(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better) and predicted of each row of ``docs``.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality (0 or 1; null ignored, of
    several rows the lowest counts); other columns are ignored. Only labels of documents that
    aren't held out are read, at most about ``fit_rows`` of them. Null and empty texts are
    scored like any others, with statistics of 0. With no labels, or those of one class, the
    score is a constant. Repeated rows are scored alike; an empty table gives an empty result.
    """
    stats = written(
        text_statistics(docs).withColumns(share_columns()).select(
            "doc_id", *SHARES, F.log1p("n_words").alias("log_words"),
            F.log1p("longest_word").alias("longest"),
        ), "statistics",
    )
    known = one_label(labels, "quality").filter(~held_out())
    labelled = stats.join(known, "doc_id").select("doc_id", "label", *FEATURES)
    labelled = written(labelled, "labelled")
    rows = labelled.count()
    if rows > fit_rows:
        share = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20))
        labelled = labelled.filter(share < int(fit_rows / rows * (1 << 20)))
    score = fit(labelled)
    return stats.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
