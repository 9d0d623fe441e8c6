"""Quality rules whose thresholds are certified on labelled documents.

Base rules are fixed. Beyond them, a document is dropped if a statistic of its text lies outside
cutoffs of its stratum (its language). Cutoffs come in nested levels, from lenient to strict:
level k takes, on one half of the labelled documents, the quantiles that cut off a share
``LEVELS[k]`` of the good ones, of those statistics where the cut hits bad documents far more.
On the other half, the holdout, each stratum's levels are tested in that order: how many good
documents does the whole set of cutoffs reject, and is the exact binomial chance of as few,
were the true rate ``limit``, at most ``alpha`` divided by the number of strata? The strictest
level before the first failure holds. As the order of levels is fixed beforehand, testing them
one after the other needs no further correction; the strata do (Bonferroni). So, with chance
1 - alpha over all strata, no stratum loses more than ``limit`` of its good documents to cutoffs.
A stratum with too few labelled documents keeps the base rules only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lanewise.functions.tails import binomial_lower
from lanewise.llm.staging import written
from lanewise.llm.statistics import SHARES, one_label, share_columns, text_statistics

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
LEVELS = (0.0005, 0.001, 0.002, 0.005, 0.01)
LIMIT = 0.01
ALPHA = 0.05
#: A cut must hit this share of the bad documents, and this many times the good one's share.
LEAST_HIT, LEAST_LIFT = 0.02, 10.0
_ACCURACY = 20_000

SIDES = {"low": "<", "high": ">"}


def _cut(name: str, side: str, level: int) -> str:
    return f"{name}_{side}_{level}"


def _beyond(level: int) -> F.Column:
    """Whether any cutoff of a level rejects the row; absent cutoffs reject nothing."""
    return reduce(lambda a, b: a | b, (
        F.coalesce(F.expr(f"{name} {sign} {_cut(name, side, level)}"), F.lit(False))
        for name in SHARES for side, sign in SIDES.items()
    ))


def cutoffs(selection: DataFrame) -> DataFrame:
    """A row per stratum with the cutoffs of all levels, null where a cut isn't worth it."""
    good = F.col("label") == 1
    quantiles = selection.groupBy("stratum").agg(
        *(F.percentile_approx(F.when(good, F.col(name)), [*LEVELS, *(1 - x for x in LEVELS)],
                              _ACCURACY).alias(name) for name in SHARES),
    )
    wide = quantiles.select("stratum", *(
        F.col(name)[k if side == "low" else len(LEVELS) + k].alias(_cut(name, side, k))
        for name in SHARES for side in SIDES for k in range(len(LEVELS))
    ))
    wide = written(wide, "quantiles")
    joined = selection.join(wide, "stratum")
    share = {}
    for name in SHARES:
        for side, sign in SIDES.items():
            for k in range(len(LEVELS)):
                hit = F.expr(f"cast({name} {sign} {_cut(name, side, k)} as int)")
                share[_cut(name, side, k)] = (F.avg(F.when(~good, hit)), F.avg(F.when(good, hit)))
    useful = joined.groupBy("stratum").agg(*(
        ((bad >= LEAST_HIT) & (bad >= LEAST_LIFT * ok)).alias(f"use_{c}")
        for c, (bad, ok) in share.items()
    ))
    return wide.join(useful, "stratum").select("stratum", *(
        F.when(F.col(f"use_{c}"), F.col(c)).alias(c) for c in share
    ))


def certified(holdout: DataFrame, cuts: DataFrame, limit: float, alpha: float) -> DataFrame:
    """(stratum, level): the strictest level that passed, of strata where one did."""
    rejected = holdout.filter("label = 1").join(cuts, "stratum").groupBy("stratum").agg(
        F.count("*").alias("n"),
        *(F.sum(_beyond(k).cast("int")).alias(f"hits_{k}") for k in range(len(LEVELS))),
    )
    tests = rejected.select(
        "stratum", "n", F.posexplode(F.array(*(f"hits_{k}" for k in range(len(LEVELS)))))
        .alias("level", "hits"),
    )
    bound = alpha / max(1, cuts.count())

    def passes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["passed"] = [
                binomial_lower(int(x.hits), int(x.n), limit) <= bound for x in frame.itertuples()
            ]
            yield frame[["stratum", "level", "passed"]]

    tested = tests.mapInPandas(passes, "stratum string, level int, passed boolean")
    so_far = Window.partitionBy("stratum").orderBy("level")
    return (
        tested.withColumn("held", F.min("passed").over(so_far)).filter("held")
        .groupBy("stratum").agg(F.max("level").alias("level"))
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    limit: float = LIMIT,
    alpha: float = ALPHA,
) -> DataFrame:
    """doc_id, counts, base_failed and kept of each row of ``docs``, in no order.

    ``docs`` has doc_id, text and lang (absent or null: one stratum of its own); ``labels`` has
    doc_id and quality (1 good, 0 bad, null ignored; of several rows the lowest counts). Other
    columns are ignored. A null or empty text has no words and fails the base rules. Repeated
    rows stay, each judged by its own text; of the rows of one doc_id one counts as labelled. Without labels, or for a null doc_id among them, only the base
    rules hold; an empty table gives an empty result. ``failed`` names the first reason.
    """
    stats = written(text_statistics(docs), "statistics").withColumns(share_columns())
    stats = stats.withColumn("stratum", F.coalesce("lang", F.lit("")))
    failed = F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    )
    stats = stats.withColumn("base_failed", failed)
    labelled = written(
        stats.filter(~F.col("base_failed")).select("doc_id", "stratum", *SHARES)
        .join(one_label(labels, "quality"), "doc_id")
        # One draw per document: its rows aren't independent of each other.
        .groupBy("doc_id").agg(F.min(F.struct("stratum", *SHARES, "label")).alias("one"))
        .select("doc_id", "one.*"), "labelled",
    )
    half = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(2))
    cuts = written(cutoffs(labelled.filter(half == 0)), "cutoffs")
    levels = certified(labelled.filter(half == 1), cuts, limit, alpha)
    rules = written(cuts.join(levels, "stratum"), "rules")
    judged = stats.join(rules, "stratum", "left")
    reasons = [
        F.when(F.col("n_words") < MIN_WORDS, F.lit("few words")),
        F.when(F.col("base_failed"), F.lit("repeated words")),
    ]
    for name in SHARES:
        for side, sign in SIDES.items():
            out = reduce(lambda a, b: a | b, (
                (F.col("level") == k) & F.expr(f"{name} {sign} {_cut(name, side, k)}")
                for k in range(len(LEVELS))
            ))
            reasons.append(F.when(out, F.lit(f"{name} {side}")))
    judged = judged.withColumn("failed", F.coalesce(*reasons))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.col("failed").isNull().alias("kept"), "failed",
    )
