from __future__ import annotations

import math
import zlib

import pytest

from lanewise.llm.html_text import blocks, composed, extract, labelled_bits, main_text, train
from lanewise.llm.quality_model import quality_model, tree_rules
from lanewise.llm.quality_rules import quality_rules
from lanewise.llm.toxicity import toxicity
from tests.llm.fixtures import awkward, documents, prose

DATA = "/root/testdata/sf0.01"


def accuracy(rows, truth, label):
    """Share of the held-out label-1 and label-0 documents that are predicted so."""
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows
            if r["held_out"] and r["doc_id"] in truth]
    hits = [p == t for p, t in held if t == label]
    return sum(hits) / len(hits)


@pytest.mark.parametrize("operator, name", [(quality_model, "quality"), (toxicity, "toxic")])
def test_scores_of_held_out_documents(spark, operator, name):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = operator(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    cut = 0.3 if name == "quality" else 0.5
    assert all(r["predicted"] == (r["score"] >= cut) for r in rows)
    truth = {r["doc_id"]: r[name] for r in labels.collect()}
    assert accuracy(rows, truth, 0) > 0.9
    assert accuracy(rows, truth, 1) > (0.9 if name == "quality" else 0.8)


@pytest.mark.parametrize("operator", [quality_model, toxicity])
def test_held_out_labels_change_nothing(spark, operator):
    docs = documents(spark, awkward())
    labels = [(i, i % 2, i % 2) for i in range(1, 17)] + [(None, 1, 1), (3, None, None)]
    schema = "doc_id long, quality int, toxic int"
    flipped = [(i, q if i is None or zlib.crc32(str(i).encode()) % 5 else 1 - q, t
                if i is None or zlib.crc32(str(i).encode()) % 5 else 1 - t)
               for i, q, t in labels if q is not None]
    one, two = (
        sorted((repr(r["doc_id"]), round(r["score"], 9)) for r in operator(
            docs, spark.createDataFrame(x, schema)).collect()) for x in (labels, flipped)
    )
    assert one == two and len(one) == len(awkward())


def test_no_labels_and_no_documents(spark):
    docs = documents(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for operator in (quality_model, toxicity):
        assert {r["score"] for r in operator(docs, none).collect()} == {0.5}
    assert toxicity(docs.limit(0), none).count() == 0
    rows = quality_rules(docs, none).collect()
    assert len(rows) == len(awkward()) and all(r["kept"] == (not r["base_failed"]) for r in rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 11)}
    assert by_id[4]["n_words"] == 0 and by_id[4]["base_failed"]
    assert by_id[14]["n_dup_lines"] == 39 and by_id[14]["failed"] == "repeated words"
    assert quality_rules(docs.limit(0), none).count() == 0


def brute_levels(rows, limit, alpha):
    """{stratum: level} by plain Python, of (doc_id, stratum, label, shares) rows, cuts given."""
    from lanewise.llm.quality_rules import LEVELS

    out = {}
    strata = {s for _, s, _, _ in rows}
    for stratum in strata:
        own = {i: hits for i, s, label, hits in rows if s == stratum and label == 1}
        for level in range(len(LEVELS)):
            n, hits = len(own), sum(level >= h for h in own.values())
            chance = sum(math.comb(n, k) * limit**k * (1 - limit)**(n - k)
                         for k in range(hits + 1))
            if chance > alpha / len(strata):
                break
            out[stratum] = level
    return out


def test_certified_levels_equal_brute_force(spark):
    """A document of statistic 10 + k is first rejected at level k."""
    import random

    from lanewise.llm.quality_rules import LEVELS, SHARES, SIDES, _cut, certified

    dice = random.Random(4)
    rows = []
    for i in range(6000):
        stratum = ["a", "b", "c", ""][dice.randrange(4)]
        share = {"a": 0.002, "b": 0.008, "c": 0.03, "": 0.0005}[stratum]
        level = next((k for k in range(len(LEVELS)) if dice.random() < share), 99)
        rows.append((i, stratum, int(dice.random() < 0.9), level))
    names = list(SHARES)
    holdout = spark.createDataFrame(
        [(s, float(h), label) for _, s, label, h in rows], f"stratum string, {names[0]} double, label int")
    for name in names[1:]:
        holdout = holdout.withColumn(name, holdout[names[0]] * 0)
    cuts = spark.createDataFrame([(s,) for s in ("a", "b", "c", "")], "stratum string")
    from pyspark.sql import functions as F

    cuts = cuts.select("stratum", *(
        (F.lit(k + 0.5) if name == names[0] and side == "low" else F.lit(None).cast("double"))
        .alias(_cut(name, side, k))
        for name in names for side in SIDES for k in range(len(LEVELS))))
    got = {r.stratum: r.level for r in certified(holdout, cuts, 0.01, 0.05).collect()}
    assert got == brute_levels(rows, 0.01, 0.05) and 0 < len(got) < 4


def test_repeated_rows_are_no_new_draws(spark):
    rows = [(k, " ".join(f"{'w' * 60 if k % 10 == 0 else 'word'}{(k * 31 + j) % 997}"
                         for j in range(25))) for k in range(900)]
    labels = spark.createDataFrame([(k, int(k % 10 > 0)) for k in range(900)],
                                   "doc_id long, quality int")
    one, many = (
        {r["doc_id"]: r["kept"] for r in quality_rules(documents(spark, x), labels).collect()}
        for x in (rows, rows * 8))
    assert one == many and all(one.values())


def test_thresholds_reject_only_what_is_certified(spark):
    """Bad documents of long words go; good ones are lost at most at the limit."""
    rows = []
    for k in range(4000):
        word = "wordlike" if k % 10 else "w" * 60
        rows.append((k, " ".join(f"{word}{(k * 31 + j) % 997}" for j in range(25))))
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 10 > 0)) for k in range(4000)],
                                   "doc_id long, quality int")
    got = quality_rules(docs, labels).collect()
    good = [r["kept"] for r in got if r["doc_id"] % 10]
    bad = [r["kept"] for r in got if r["doc_id"] % 10 == 0]
    assert sum(bad) == 0 and sum(good) >= 0.99 * len(good)


def test_rules_are_the_paths_of_the_trees():
    text = (
        "RandomForestClassificationModel: uid=x, numTrees=1\n  Tree 0 (weight 1.0):\n"
        "    If (feature 0 <= 0.5)\n     If (feature 1 > 2.0)\n      Predict: 1.0\n"
        "     Else (feature 1 <= 2.0)\n      Predict: 0.0\n"
        "    Else (feature 0 > 0.5)\n     Predict: 1.0\n"
    )
    rules = tree_rules(text)
    assert "symbol_share > 2.0D AND word_length <= 0.5D" in rules and len(rules) == 4


def test_blocks_of_broken_markup():
    page = ('<p><b>One&nbsp;two<br>three<br><p>Four &amp; five<script>var t="</p>";</script>'
            "<!-- <p>no</p> --><ul><li>a<li>b</ul><style>p{}</style><div title='>'>six")
    assert [t for t, _ in blocks(page)] == ["One two three", "Four & five", "a", "b", "six"]
    assert blocks("") == [] and blocks("<p> </p><!-- open") == []
    assert [t for t, _ in blocks("<" * 50 + "a < b")][0].endswith("a < b")


@pytest.mark.parametrize("unit", [
    "<a x ", '<a "', "<a '", "<! ", "<script x ", "</b ", "<!-- ", "<b>", "<b><li>", "<i></b>",
    '<a b="c', "<p><b>", "<div>", "&amp", "<a href='x\">",
])
def test_broken_pages_take_linear_time(unit):
    import time

    page = "<b>" * 20_000 + unit * (2_000_000 // len(unit)) + "<li>" * 20_000 + "</i>" * 20_000
    begun = time.process_time()
    blocks(page)
    assert time.process_time() - begun < 15


def test_unmarked_articles(spark):
    """Pages whose article is a bare div, decoded by the chain of the marked ones."""
    import re

    pages = [r["html"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    chain = train(labelled_bits(pages[:150]))
    same = sum(
        main_text(re.sub(r"<(/?)article\b", r"<\1div", page), chain) == main_text(page, chain)
        for page in pages)
    assert same >= 0.95 * len(pages)


def test_chain_decodes_the_best_sequence():
    chain = train(labelled_bits([]))
    bits = [b for _, b in blocks(composed(1)[0])]
    gains = (__import__("lanewise.llm.html_text", fromlist=["_matrix"])._matrix(bits)
             @ chain.weights)
    import itertools

    bits, gains = bits[:9], gains[:9]

    def score(labels):
        return sum(gains[k][x] for k, x in enumerate(labels)) + sum(
            chain.steps[a][b] for a, b in itertools.pairwise(labels))

    best = max(itertools.product((0, 1), repeat=len(bits)), key=score)
    assert [int(x) for x in chain.decode(bits)] == list(best)
    page = (
        '<body><div class="menu"><a href="/">Home</a></div><div class="sidebar"><p>Popular '
        'things are listed here for you.</p></div><div class="content"><h1>A title</h1><p>The '
        "first paragraph of a text with enough words to be one.</p><p>Short.</p></div>"
        '<div class="comments"><p>I do not agree with any of what is written above.</p></div>'
        "<footer>&copy; all</footer></body>"
    )
    assert main_text(page, chain).split("\n\n") == [
        "A title", "The first paragraph of a text with enough words to be one.", "Short."]
    assert main_text(None, chain) == ""


def test_main_text_of_marked_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    import html as entities
    import re

    def truth(page):
        start = page.index("<article>")
        end = page.find("</article>")
        inner = re.sub(r"<br>", " ", page[start:end if end >= 0 else len(page)])
        parts = (re.sub(r"<[^>]*>", "", x) for x in re.split(r"</?(?:p|h1)>", inner))
        return "\n\n".join(" ".join(entities.unescape(x).split()) for x in parts if x.strip())

    want = {r["page_id"]: truth(r["html"]) for r in pages.collect()}
    got = extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    odd = spark.createDataFrame(
        [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "<p>", "x")],
        "page_id long, url string, html string, text string")
    assert [r["text"] for r in extract(odd).collect()] == ["", "", ""]
    assert extract(odd.limit(0)).count() == 0


def test_rare_expressions_count_in_large_tables(spark, monkeypatch):
    """Six occurrences among four million letters are evidence, joined or broadcast."""
    from lanewise.llm import toxicity as module

    base, short, rare = prose(1, 1500), prose(2, 60), "zyzzyxvag"
    folds = {k: [i for i in range(5000) if zlib.crc32(str(i).encode()) % 5 == k] for k in range(5)}
    rows, labels = [], []
    for k, i in enumerate((folds[2] + folds[3])[:800]):
        rows.append((i, f"{base} {rare if k % 2 and k < 12 else 'and'}"))
        labels.append((i, k % 2))
    for k, i in enumerate(folds[1][:80]):
        rows.append((i, f"{short} {rare if k % 2 else 'and'}"))
        labels.append((i, k % 2))
    one, two = folds[0][:2]
    rows += [(one, f"{short} {rare}"), (two, f"{short} and")]
    docs = documents(spark, rows)
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    for most in (module.HOT_WORDS, 3):
        monkeypatch.setattr(module, "HOT_WORDS", most)
        monkeypatch.setattr(module, "HOT_GRAMS", most)
        score = {r["doc_id"]: r["score"] for r in toxicity(docs, truth).collect()}
        assert score[one] > 0.5 > score[two] and score[one] > score[two] + 0.2


def packed(sequence):
    """Bytes as the integer that stands for them, first byte highest."""
    return int.from_bytes(bytes(sequence), "big")


def brute_letter_models(counted):
    """p(class, byte, context) by dictionaries; ``counted`` has (word, toxic, ordinary) rows.

    ``class`` is shared, toxic or ordinary; a context is at most five bytes.
    """
    from collections import Counter, defaultdict

    from lanewise.llm.toxicity import BYTES, CLASS_DISCOUNTS, DISCOUNT, ORDER

    occurs = {"toxic": defaultdict(Counter), "ordinary": defaultdict(Counter)}
    before = defaultdict(set)
    shared = defaultdict(Counter)
    for word, *numbers in counted:
        flat = f" {word} ".encode()
        for at in range(1, len(flat)):
            for size in range(1, min(ORDER, at + 1) + 1):
                start = at + 1 - size
                context, byte = flat[start:at], flat[at]
                for kind, n in zip(("toxic", "ordinary"), numbers, strict=True):
                    occurs[kind][context][byte] += n
                if not sum(numbers):
                    continue
                if size == ORDER or start == 0:
                    shared[context][byte] += sum(numbers)
                else:
                    before[context, byte].add(flat[start - 1])
    for (context, byte), lefts in before.items():
        shared[context][byte] += len(lefts)

    def taken(n):
        return 0.0 if n == 0 else CLASS_DISCOUNTS[min(n, len(CLASS_DISCOUNTS)) - 1]

    def left(kind, context):
        counts = occurs[kind][context]
        total = sum(counts.values())
        return sum(map(taken, counts.values())) / total if total else 1.0

    def p(kind, byte, context):
        if kind == "shared":
            less = p(kind, byte, context[1:]) if context else 1 / BYTES
            counts = shared[context]
            total = sum(counts.values())
            if not total:
                return less
            types = sum(n > 0 for n in counts.values())
            return (max(counts[byte] - DISCOUNT, 0) + DISCOUNT * types * less) / total
        if not any(sum(occurs[k][context].values()) for k in occurs):
            return p(kind, byte, context[1:]) if context else 1 / BYTES
        most = max(left(k, context) for k in occurs)
        own = 0.0
        if most < 1:
            counts = occurs[kind][context]
            own = (counts[byte] - taken(counts[byte])) / sum(counts.values())
            own *= (1 - most) / (1 - left(kind, context))
        return own + most * p("shared", byte, context)

    return p


def test_letter_models_equal_a_textbook_model_and_add_up(spark):
    """Fit counts are others than those of the scores; words without counts have their say too."""
    import random

    from pyspark.sql import functions as F

    from lanewise.llm.toxicity import EDGE, log_ratios, probabilities, sequence_counts

    dice = random.Random(8)
    words = sorted({"".join(dice.choice("abcd") for _ in range(dice.randrange(1, 9)))
                    for _ in range(150)} | {"é", "longestword"})
    counted = [(w, dice.randrange(4), dice.choice([0, 0, 1, 2, 9])) for w in words]
    rows = [(w, 1, t, o, t // 2, o // 2) for w, t, o in counted]
    frame = spark.createDataFrame(
        rows, "word string, n long, toxic long, ordinary long, toxic_fit long, ordinary_fit long")
    counts = sequence_counts(frame)
    model = brute_letter_models(counted)
    fit = brute_letter_models([(w, t, o) for w, _, _, _, t, o in rows])
    for row in log_ratios(counts).collect():
        size = (row.gram.bit_length() + 7) // 8
        *context, byte = row.gram.to_bytes(size, "big")
        context = bytes(context)
        for p, ratio in ((model, row.ratio), (fit, row.ratio_fit)):
            wanted = math.log(p("toxic", byte, context) / p("ordinary", byte, context))
            assert ratio == pytest.approx(wanted, abs=1e-9)

    # With every byte listed after some contexts, each model's probabilities add up to 1.
    contexts = [(EDGE,), (EDGE, 97), tuple(b"abcda"), tuple(b"zzzzz")]
    filler = spark.createDataFrame(
        [(packed((*c[k:], b)),) for c in contexts for k in range(len(c) + 1)
         for b in range(1, 256)], "gram long"
    ).select("gram", *(F.lit(0).cast("long").alias(c) for c in counts.columns[1:]))
    summed = counts.union(filler).groupBy("gram").agg(
        *(F.sum(c).alias(c) for c in counts.columns[1:]))
    for order, table in probabilities(summed).items():
        context = F.shiftright("gram", 8)
        full = table.groupBy(context.alias("context")).agg(
            F.count("*").alias("n"), *(F.sum(c).alias(c) for c in table.columns[2:]))
        full = full.filter("n = 255").collect()
        assert full or order == 4
        for row in full:
            assert all(row[c] == pytest.approx(1.0, abs=1e-9) for c in table.columns[2:])


def test_an_expression_of_the_fitting_fold_only_is_known(spark):
    """Every label that isn't held out is counted, and the same expression found elsewhere."""
    from lanewise.llm.toxicity import FIT_FOLD

    def fold(i):
        return zlib.crc32(str(i).encode()) % 5

    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        bad = "grobble" if fold(i) == FIT_FOLD else "snarkle"
        docs.append((i, f"{prose(i, 30)} {bad if toxic else 'kind'} {prose(i + 1000, 20)}"))
        if not (toxic and fold(i) == 0):
            labels.append((i, int(toxic)))
    docs.append((1001, prose(2001, 30) + " grobble " + prose(2002, 20)))
    docs.append((1002, prose(2003, 30) + " kind " + prose(2004, 20)))
    rows = {r.doc_id: r for r in toxicity(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert rows[1001].score > 10 * rows[1002].score
