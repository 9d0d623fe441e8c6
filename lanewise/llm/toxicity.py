"""Toxicity from two Kneser-Ney models of letters, one of toxic and one of ordinary documents.

Each model predicts the bytes of a word from up to five before it, so that inflected and rare
forms of an expression share what is known of its stem. A class's counts after a context are
discounted, and what that takes goes to a Kneser-Ney model that both classes share, with the
continuation counts of all labelled documents; a context that neither class has seen gives way
to the next shorter one of the same class. So the probabilities of either class add up to 1 after
every context, and a sequence that one class, with far less text, has no counts for is as likely
there as in all documents. A word's evidence is the difference of its log-likelihoods; a
document's is that sum by letter and by the root of its length, the strongest word, and what
strong words add. A logistic regression on these turns them into a score.

Fold 0 of five is held out. The models of the scores count folds 1 to 4. The regression is fitted on
fold 1, with the evidence of models that count folds 2 to 4, so that no document it learns from
was counted. Both pairs of models come from the same tables.

Words are counted in a shuffle of distinct ones, their sequences in a shuffle of distinct
sequences. Those of unlabelled documents are rows with a count of 0, so every sequence that a
document has gets its probability by the joins that build the models. The sequences' ratios stay
in a table that is never gathered. The distinct words of the documents are joined with it; of
both tables only a fixed number of rows, the most frequent ones, is broadcast, to spare the join
their rows. Words that aren't broadcast are joined by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lanewise.llm.quality_model import held_out
from lanewise.llm.staging import maybe_keys, written
from lanewise.llm.statistics import one_label
from lanewise.llm.text import NOT_ALNUM, Texts, Words, chunks, words_of

ORDER = 6
#: Most rows of the tables of sequences and words that are broadcast; the others are joined.
HOT_GRAMS, HOT_WORDS = 1 << 17, 1 << 19
#: Distinct words of a task before they are handed on.
HELD_WORDS, HELD_BYTES = 500_000, 32 << 20
#: Distinct sequences of a task before they are handed on.
HELD_GRAMS = 1_000_000
#: The fold that the regression is fitted on.
FIT_FOLD = 1
#: Discounts of the shared model, and of a class's counts of 1, 2 and more; the latter are nearly
#: whole, as most sequences are alike in both classes and land in the smaller one by chance.
DISCOUNT, CLASS_DISCOUNTS = 0.75, (0.9, 1.7, 2.4)
#: Occurrences in all documents and in the labelled ones of a class, the latter for the models of
#: the scores and for those of the regression.
COUNTS = ("n", "toxic", "ordinary", "toxic_fit", "ordinary_fit")
#: The ratio of the models of the scores, and of those of the regression.
RATIOS = ("ratio", "ratio_fit")
THRESHOLD = 0.5
#: Evidence of a word beyond this many nats is summed up as a feature of its own.
STRONG = 2.0
FEATURES = ("by_letter", "by_root", "strongest", "strong_sum")
EDGE = 0x20
#: Values a byte of a word, or its edge, may have.
BYTES = 255


def letters(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place in it, sequence) of every predicted byte: the byte and up to five before it.

    A word has an edge before and after it. Sequences are packed into integers, first byte
    highest; as no byte of a word is 0, the number of bytes shows.
    """
    length = words.end - words.start + 2
    first = np.cumsum(length) - length
    total = int(length.sum())
    word = np.repeat(np.arange(len(length)), length)
    place = np.arange(total) - first[word]
    flat = np.full(total, EDGE, dtype=np.int64)
    inner = (place > 0) & (place < length[word] - 1)
    flat[inner] = texts.data[(words.start[word] + place - 1)[inner]]
    code = flat.copy()
    for back in range(1, ORDER):
        far = np.flatnonzero(place >= back)
        code[far] += flat[far - back] << (8 * back)
    told = place > 0
    return word[told], place[told], code[told]


def distinct_words(texts: Texts, words: Words) -> tuple[Words, np.ndarray]:
    """One of each different word, and the place of every word among them."""
    _, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    one = Words(words.text[at], words.hash[at], words.start[at], words.end[at], words.first)
    return one, inverse


def sequence_counts(words: DataFrame) -> DataFrame:
    """(gram, ``COUNTS``) of the longest sequence that ends at each byte of ``words``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64), np.zeros((0, len(COUNTS)), dtype=np.int64)
        held = none
        for batch, texts in chunks(batches, "word"):
            counts = np.stack([batch.column(c).to_numpy() for c in COUNTS], axis=1)
            word, _, code = letters(texts, words_of(texts, NOT_ALNUM))
            held = _summed(
                np.concatenate([held[0], code]), np.concatenate([held[1], counts[word]]))
            if len(held[0]) > HELD_GRAMS:
                yield _counts("gram", pa.array(held[0]), held[1])
                held = none
        yield _counts("gram", pa.array(held[0]), held[1])

    return (
        words.select("word", *COUNTS)
        .mapInArrow(rows, "gram long" + "".join(f", {c} long" for c in COUNTS))
        .groupBy("gram").agg(*(F.sum(c).alias(c) for c in COUNTS))
    )


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(grams):
        return grams, counts
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[starts], np.add.reduceat(counts[order], starts, axis=0)


def _counts(name: str, keys: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [keys, *(pa.array(counts[:, i].copy()) for i in range(len(COUNTS)))],
        names=[name, *COUNTS],
    )


def order_tables(counts: DataFrame) -> dict[int, DataFrame]:
    """(gram, ``COUNTS``, shared, shared_fit) by order: every sequence of that many bytes.

    A class has its occurrences. ``shared`` is of both: at the highest order, and where a sequence
    starts a word, its occurrences, else the number of different bytes that come before it.
    """
    size = F.ceil(F.length(F.hex("gram")) / 2).cast("int")
    every = counts.withColumns({
        f"shared{of}": F.col(f"toxic{of}") + F.col(f"ordinary{of}") for of in ("", "_fit")})
    names = (*COUNTS, "shared", "shared_fit")
    tables = {ORDER: every.filter(size == ORDER)}
    for order in range(ORDER - 1, 0, -1):
        ends = F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1))
        before = tables[order + 1].select(
            ends.alias("gram"), *COUNTS,
            *((F.col(c) > 0).cast("long").alias(c) for c in ("shared", "shared_fit")))
        tables[order] = written(
            before.union(every.filter(size == order).select("gram", *names))
            .groupBy("gram").agg(*(F.sum(c).alias(c) for c in names)), f"order{order}",
        )
    return tables


def _share(name: str, less: Column) -> Column:
    """The discounted share of ``name`` after its context, and what is left over times ``less``.

    Without counts after the context it is ``less``.
    """
    of = Window.partitionBy("context")
    total, types = F.sum(name).over(of), F.sum((F.col(name) > 0).cast("long")).over(of)
    own = F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) + DISCOUNT * types * less
    return F.when(total > 0, own / total).otherwise(less)


def _class_shares(rows: DataFrame, fit: str) -> DataFrame:
    """Adds p_toxic and p_ordinary: own counts, discounted, and the shared model by the rest.

    Both classes leave the same part to the shared model, the greater of what their discounts
    take, else each sequence that is new to both would speak for the class of less text.
    """
    of = Window.partitionBy("context")
    names = [f"{c}{fit}" for c in ("toxic", "ordinary")]
    taken = {n: F.lit(0.0) for n in names}
    for name in names:
        for count, discount in enumerate(CLASS_DISCOUNTS, 1):
            taken[name] = F.when(F.col(name) >= count, discount).otherwise(taken[name])
    total = {n: F.sum(n).over(of) for n in names}
    left = {n: F.when(total[n] > 0, F.sum(taken[n]).over(of) / total[n]).otherwise(1.0)
            for n in names}
    rows = rows.withColumns(
        {f"left_{n}": left[n] for n in names} | {f"sum_{n}": total[n] for n in names})
    most = F.greatest(*(f"left_{n}" for n in names))
    unseen = reduce(Column.__add__, (F.col(f"sum_{n}") for n in names)) == 0
    shares = {}
    for name in names:
        own = (F.col(name) - taken[name]) / F.col(f"sum_{name}") / (1 - F.col(f"left_{name}"))
        mixed = F.when(most < 1, (1 - most) * own).otherwise(0.0) + most * F.col(f"p_shared{fit}")
        shares[f"p_{name}"] = F.when(unseen, F.col(f"less_{name}")).otherwise(mixed)
    return rows.withColumns(shares)


def probabilities(counts: DataFrame) -> dict[int, DataFrame]:
    """(gram, n, p_shared, p_toxic, p_ordinary and the same of the fit) by order.

    Each order has the ends of all sequences of the next one, so every join finds its row.
    """
    tables, out = order_tables(counts), {}
    kinds = [f"{kind}{fit}" for fit in ("", "_fit") for kind in ("shared", "toxic", "ordinary")]
    for order in range(1, ORDER + 1):
        rows = tables[order].withColumn("context", F.shiftright("gram", 8))
        if order == 1:  # at most BYTES rows
            rows = rows.withColumns({f"less_{kind}": F.lit(1.0 / BYTES) for kind in kinds})
        else:
            end = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1))
            below = out[order - 1].select(
                F.col("gram").alias("end"), *(F.col(f"p_{k}").alias(f"less_{k}") for k in kinds))
            rows = rows.withColumn("end", end).join(below, "end")
        for fit in ("", "_fit"):
            rows = rows.withColumn(
                f"p_shared{fit}", _share(f"shared{fit}", F.col(f"less_shared{fit}")))
            rows = _class_shares(rows, fit)
        out[order] = written(rows.select("gram", "n", *(f"p_{k}" for k in kinds)), f"model{order}")
    return out


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, n, ratio, ratio_fit): log(toxic / ordinary) of each longest sequence's last byte.

    Those are the sequences of ``ORDER`` bytes and the shorter ones that start a word.
    """
    ratios = [
        (F.log(f"p_toxic{fit}") - F.log(f"p_ordinary{fit}")).alias(f"ratio{fit}")
        for fit in ("", "_fit")
    ]
    out = None
    for order, table in probabilities(counts).items():
        if order == 1:
            continue
        if order < ORDER:
            table = table.filter(F.shiftright("gram", 8 * (order - 1)) == EDGE)
        rows = table.select("gram", "n", *ratios)
        out = rows if out is None else out.union(rows)
    return out


def hot_cut(table: DataFrame, most: int) -> int:
    """The least number of binary digits of ``n`` that at most ``most`` rows have or exceed."""
    digits = table.groupBy(F.length(F.bin("n")).alias("digits")).count().collect()
    cut = 65
    for row in sorted(digits, key=lambda r: -r["digits"]):
        most -= row["count"]
        if most < 0:
            break
        cut = row["digits"]
    return cut


def hot_rows(
    table: DataFrame, key: str, most: int, names: tuple[str, ...] = RATIOS
) -> tuple[np.ndarray, ...]:
    """The keys, sorted, and ratios of the most frequent rows of ``table`` (key, n, names)."""
    rows = table.filter(F.length(F.bin("n")) >= hot_cut(table, most)).select(key, *names).toArrow()
    columns = [rows.column(c).to_numpy() for c in (key, *names)]
    order = np.argsort(columns[0])
    return tuple(c[order] for c in columns)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are in the sorted ``keys``, and the places there of those that are."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool), np.zeros(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[place] == wanted
    return known, place[known]


def _spelled(texts: Texts, words: Words) -> pa.Array:
    length = words.end - words.start
    bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    at = np.arange(bounds[-1]) + np.repeat(words.start - bounds[:-1], length)
    return pa.Array.from_buffers(
        pa.large_string(), len(words),
        [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(texts.data[at].tobytes())],
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, ``COUNTS``): every different word of ``texts`` (label, fold, text).

    Rows without a label count for ``n``, the others for their class.
    """

    def merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        keys, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        keys, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros((len(keys), len(COUNTS)), dtype=np.int64)
        np.add.at(total, inverse, counts)
        words = pa.concat_arrays([p[2] for p in parts]).take(pa.array(at))
        return keys, total, words

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        pending = 0
        for batch, part in chunks(batches):
            part = part.lower()
            words = words_of(part, NOT_ALNUM)
            one, inverse = distinct_words(part, words)
            label = batch.column(0).to_numpy(zero_copy_only=False)
            fit = batch.column(1).to_numpy(zero_copy_only=False) != FIT_FOLD
            toxic, ordinary = label == 1, (label != 1) & ~np.isnan(label)
            kinds = (np.isnan(label), toxic, ordinary, toxic & fit, ordinary & fit)
            counts = np.stack([
                np.bincount(inverse, weights=kind[words.text], minlength=len(one))
                for kind in kinds], axis=1).astype(np.int64)
            parts.append((one.hash, counts, _spelled(part, one)))
            pending += len(one)
            if len(parts) > 1 and pending > max(100_000, 2 * len(parts[0][0])):
                parts = [merged(parts)]
                pending = len(parts[0][0])
            if pending > HELD_WORDS or sum(p[2].nbytes for p in parts) > HELD_BYTES:
                _, counts, words = merged(parts)
                yield _counts("word", words.cast(pa.string()), counts)
                parts, pending = [], 0
        if parts:
            _, counts, words = merged(parts)
            yield _counts("word", words.cast(pa.string()), counts)

    return (
        texts.select(F.col("label").cast("double").alias("label"), F.col("fold").cast("int"), "text")
        .mapInArrow(rows, "word string" + "".join(f", {c} long" for c in COUNTS))
        .groupBy("word").agg(*(F.sum(c).alias(c) for c in COUNTS))
    )


def word_ratios(words: DataFrame, ratios: DataFrame) -> DataFrame:
    """(word_key, n, ``RATIOS``): the evidence of each of ``words``, the sum of its sequences'."""
    held = words.sparkSession.sparkContext.broadcast(hot_rows(ratios, "gram", HOT_GRAMS))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "word"):
            one = words_of(texts, NOT_ALNUM)
            word, _, code = letters(texts, one)
            found, place = _find(held.value[0], code)
            totals = (np.bincount(word[found], ratio[place], minlength=len(one))
                      for ratio in held.value[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.hash.view(np.int64)), batch.column(1),
                 *(pa.array(total.astype(float)) for total in totals)],
                names=["word_key", "n", *RATIOS])

    def other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, "word"):
            one = words_of(texts, NOT_ALNUM)
            word, _, code = letters(texts, one)
            far = ~_find(held.value[0], code)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.hash.view(np.int64)[word[far]]), pa.array(code[far])],
                names=["word_key", "gram"])

    words = words.select("word", "n")
    rare = words.mapInArrow(other, "word_key long, gram long").join(
        ratios.select("gram", *RATIOS), "gram")
    return (
        words.mapInArrow(known, "word_key long, n long, ratio double, ratio_fit double")
        .union(rare.select("word_key", F.lit(0).cast("long"), *RATIOS))
        .groupBy("word_key").agg(
            F.max("n").alias("n"), *(F.sum(ratio).alias(ratio) for ratio in RATIOS))
    )


_FACTS = (
    "doc_id long, row_key long, size long, total double, strongest double, beyond double, "
    "others array<long>, times array<long>"
)


def evidence(texts: DataFrame, known: DataFrame, name: str = "ratio") -> DataFrame:
    """doc_id and ``FEATURES`` of each row of ``texts``: 0 without words.

    ``known`` has word_key, n and the ratio, of that name, of every word.
    """
    known = known.select("word_key", "n", F.col(name).alias("ratio"))
    held = texts.sparkSession.sparkContext.broadcast(
        hot_rows(known, "word_key", HOT_WORDS, ("ratio",)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in chunks(batches):
            part = part.lower()
            words = words_of(part, NOT_ALNUM)
            keys = words.hash.view(np.int64)
            found, place = _find(held.value[0], keys)
            text, ratio = words.text[found], held.value[1][place]
            n = len(part)
            size = np.bincount(words.text, words.end - words.start + 1, minlength=n)
            strongest = np.zeros(n)
            np.maximum.at(strongest, text, ratio)
            # What isn't broadcast, once per text and word.
            owner, key = words.text[~found], keys[~found]
            order = np.lexsort((key, owner))
            owner, key = owner[order], key[order]
            opens = np.ones(len(key), dtype=bool)
            opens[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
            first = np.flatnonzero(opens)
            bounds = pa.array(np.searchsorted(owner[first], np.arange(n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(size.astype(np.int64)),
                pa.array(np.bincount(text, ratio, minlength=n).astype(float)), pa.array(strongest),
                pa.array(np.bincount(text, np.maximum(ratio - STRONG, 0), minlength=n).astype(float)),
                pa.ListArray.from_arrays(bounds, pa.array(key[first])),
                pa.ListArray.from_arrays(bounds, pa.array(np.diff(np.append(first, len(key))))),
            ], names=[x.split()[0] for x in _FACTS.split(", ")])

    facts = written(
        texts.select("doc_id", F.monotonically_increasing_id().alias("row_key"), "text")
        .mapInArrow(rows, _FACTS), "facts",
    )
    pairs = facts.select("row_key", F.explode(F.arrays_zip("others", "times")).alias("o")).select(
        "row_key", F.col("o.others").alias("word_key"), F.col("o.times").alias("times"))
    ratio, times = F.col("ratio"), F.col("times")
    joined = pairs.join(known.filter("ratio <> 0").drop("n"), "word_key").groupBy("row_key").agg(
        F.sum(times * ratio).alias("more"), F.max("ratio").alias("high"),
        F.sum(times * F.greatest(ratio - STRONG, F.lit(0.0))).alias("above"),
    )
    size = F.greatest(F.col("size"), F.lit(1))
    total = F.col("total") + F.coalesce("more", F.lit(0.0))
    return facts.drop("others", "times").join(joined, "row_key", "left").select(
        "doc_id", (total / size).alias("by_letter"), (total / F.sqrt(size)).alias("by_root"),
        F.greatest("strongest", "high").alias("strongest"),
        F.log1p(F.col("beyond") + F.coalesce("above", F.lit(0.0))).alias("strong_sum"),
    )


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: toxic) and predicted of each row of ``docs``.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0 or 1; null ignored, of several
    rows the lowest counts); other columns are ignored. Only labels of documents that aren't
    held out are read. Null and empty texts, and those without words, have no evidence and get
    the score of that. With no labels, or those of one class, the score is a constant. Repeated
    rows are scored alike; an empty table gives an empty result.
    """
    known = written(
        one_label(labels, "toxic").filter(~held_out()).withColumn(
            "fold", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))),
        "labels",
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def labelled(rows: DataFrame) -> DataFrame:
        # Labels grow with the documents, so they are shuffled at every size.
        return maybe_keys(texts, rows, "doc_id").join(rows.hint("merge"), "doc_id")

    every = texts.select(F.lit(None).alias("label"), F.lit(0).alias("fold"), "text")
    counted = labelled(known).select("label", "fold", "text")
    words = written(word_counts(every.union(counted)), "words")
    ratios = written(log_ratios(written(sequence_counts(words), "sequences")), "ratios")
    evident = written(word_ratios(words, ratios), "word_ratios")
    facts = written(evidence(texts, evident), "evidence")
    own = known.filter(F.col("fold") == FIT_FOLD)
    vector = array_to_vector(F.array(*FEATURES))
    fitted = written(
        evidence(labelled(own).select("doc_id", "text"), evident, "ratio_fit").join(own, "doc_id")
        .select(F.col("label").cast("double").alias("label"), *FEATURES), "fitted",
    ).select("label", vector.alias("features"))
    classes = {r["label"]: r["count"] for r in fitted.groupBy("label").count().collect()}
    if len(classes) == 2:
        model = LogisticRegression(regParam=0.001, maxIter=50).fit(fitted)
        total = F.lit(float(model.intercept))
        for name, weight in zip(FEATURES, model.coefficients, strict=True):
            total = total + F.lit(float(weight)) * F.col(name)
        score = 1 / (1 + F.exp(-total))
    else:
        score = F.lit((classes.get(1.0, 0) + 1.0) / (sum(classes.values()) + 2.0))
    return facts.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
