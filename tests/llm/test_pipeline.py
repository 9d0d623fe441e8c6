from __future__ import annotations

import re
import zlib

import numpy as np

import corpus_pipeline
from lanewise.llm.mixing import mix
from lanewise.llm.queries import vocabulary
from tests.llm.fixtures import (
    awkward, brute_components, brute_links, documents, shingle_set,
)
from tests.llm.test_scans import brute_hits

FOLDER = "/root/testdata/sf0.001"


def base_failed(text: str | None) -> bool:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs: dict[tuple, list[int]] = {}
    for k in range(len(words) - 7):
        runs.setdefault(tuple(words[k:k + 8]), []).append(k)
    inside = {k + j for at in runs.values() if len(at) > 1 for k in at for j in range(8)}
    return len(words) < 20 or 100 * len(inside) > 30 * len(words)


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_equal_brute_force(spark):
    """On so few labels no cutoff is certified, so the quality rules are the base rules."""
    from tokenizers import Tokenizer

    quality, ngram, decontaminate, mixing, write = (f for _, f in corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()

    kept = quality(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    rows = [r for r in rows if not base_failed(r["text"])]
    assert ids(kept.collect()) == ids(rows)
    docs = spark.createDataFrame(rows, docs.schema)

    sets = [shingle_set(r["text"]) for r in rows]
    roots = brute_components(len(rows), brute_links(sets))
    first = {}
    for r, root in zip(rows, roots):
        first[root] = min(first.get(root, r["doc_id"]), r["doc_id"])
    kept = ngram(spark, docs, FOLDER)
    assert kept.columns == docs.columns and ids(kept.collect()) == sorted(first.values())
    rows = [r for r in rows if r["doc_id"] in set(first.values())]
    docs = spark.createDataFrame(rows, docs.schema)

    items = [(r["item_id"], r["text"]) for r in
             spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = decontaminate(spark, docs, FOLDER)
    rows = [r for r in rows if not brute_hits(r["text"], items)[-1]]
    assert kept.columns == docs.columns and ids(kept.collect()) == ids(rows)
    docs = spark.createDataFrame(rows, docs.schema)

    drawn = {r["row"]["doc_id"] for r in mix(docs).collect() if r["selected"]}
    kept = mixing(spark, docs, FOLDER)
    rows = [r for r in rows if r["doc_id"] in drawn]
    assert kept.columns == docs.columns and ids(kept.collect()) == ids(rows)
    docs = spark.createDataFrame(rows, docs.schema)

    plain, start = Tokenizer.from_file(vocabulary()), 0
    got = {r["doc_id"]: r for r in write(spark, docs, FOLDER).collect()}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        own = plain.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        found = got.pop(r["doc_id"])
        assert (found["start"], found["n_tokens"]) == (start, len(own))
        assert found["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)
    assert not got


def test_awkward_rows_and_columns_pass_every_stage(spark):
    docs = documents(spark, awkward())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.names == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    left = docs.collect()
    assert not any(r["doc_id"] in (2, 3, 4, 5, 6, 7, 14) for r in left)
    assert len([r for r in left if r["doc_id"] == 11]) <= 2
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == len(left)


def test_empty_documents_pass_every_stage(spark):
    docs = documents(spark, awkward()).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
