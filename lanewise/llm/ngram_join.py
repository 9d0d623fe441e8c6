"""Self-join of documents on the Jaccard similarity of their word n-grams.

Prefix filtering under several global token orders. Two sets of similarity t or more share a
token among the first n - ceil(t n) + 1 of any common order of all tokens. The first order is
by rarity and runs as a shuffle of tokens; documents that share a rare prefix token fall into
one group. The other orders, by salted hashes, need no knowledge of the corpus and are checked
within a group, tile by tile; pairs that pass every order are verified exactly.

The rarity order is a tiered one, so that only the part ``tier`` of all tokens (those of small
hash) is shuffled: tokens of the tier come first, those that fewer than ``hot`` sets hold by
frequency, then the others. A set whose prefix would not fit into the rare tokens of its tier
("needy") could link over frequent tokens only with a set that is needy too, so the needy sets
are joined among themselves in a second round, by the rarity of all their tokens.

Equal sets are one class from the start: each task sends a class once, a token that ``hot`` or
more sets of one task hold is sent once with its count, and hubs of groups are minima. So a
text that a third of the documents copy costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lanewise.llm.similarity import prefix_length, verified_links, with_parts
from lanewise.llm.staging import components, maybe_keys, shuffle_width, written
from lanewise.llm.text import U64, WHITE, chunks, mix, shingle_sets, words_of

WORDS = 5
PERCENT = 80
TIER = 0.3
HOT = 32
_FLUSH = 500_000
#: Tokens for one reducing task, about 16 bytes each.
_TASK_TOKENS = 4_000_000
#: A class of more than this part of all rows is joined by broadcast; there are fewer of them.
_HOT_CLASSES = 10_000


def signature(tokens: np.ndarray) -> int:
    """A class number of a set, of 64 bits, signed as Spark's longs are."""
    total = mix(tokens).sum(keepdims=True, dtype=U64) + np.array([len(tokens)], dtype=U64)
    return int(mix(total).view(np.int64)[0])


def _below(share: float) -> int:
    return int(share * 2.0**64) if share < 1 else (1 << 64) - 1


def document_sets(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch, texts in chunks(batches):
        yield batch, shingle_sets(words_of(texts.lower(), WHITE), size)


def set_classes(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, class) of each row; the class of an empty set is null."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in document_sets(batches, size):
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([signature(s) if len(s) else None for s in sets], pa.int64()),
            ], names=["doc_id", "n_shingles", "class"])

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, n_shingles long, class long"
    )


def class_sets(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """(class, tokens): the sorted tokens of each class, once per task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in document_sets(batches, size):
            own = {signature(s): s for s in sets if len(s)}
            new = {k: s for k, s in own.items() if k not in seen}
            seen.update(new)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(new), pa.int64()),
                pa.array([s.tobytes() for s in new.values()], pa.binary()),
            ], names=["class", "tokens"])

    return docs.select("text").mapInArrow(rows, "class long, tokens binary")


PACKED = "part int, tokens binary, owners binary, classes binary, hot binary, counts binary"


def _packed(
    sets: Iterator[tuple[int, np.ndarray]], parts: int, tier: float, hot: int
) -> Iterator[pa.RecordBatch]:
    """The tier's tokens of distinct classes, dealt to parts by token, in packed rows.

    A row holds some tokens of one part, the places of their owners and the owners' classes;
    tokens of ``hot`` or more owners without the owners. Part -1 - x holds, for the classes
    x mod parts, what the choice of a prefix needs: sizes and numbers of such tokens.
    """
    limit = U64(_below(tier))
    held: list[np.ndarray] = []
    classes: list[int] = []
    sizes: list[int] = []
    total = 0

    def flush() -> Iterator[pa.RecordBatch]:
        lengths = [len(x) for x in held]
        tokens = np.concatenate(held)
        owner = np.repeat(np.arange(len(held), dtype=np.uint32), lengths)
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        key = np.array(classes, dtype=np.int64)
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        runs = np.diff(np.concatenate([starts, [len(tokens)]]))
        frequent = np.repeat(runs >= hot, runs) if hot else np.zeros(len(tokens), dtype=bool)
        left_out = np.bincount(owner[frequent], minlength=len(held))
        known, n_known = tokens[starts][runs >= hot], runs[runs >= hot]
        if not hot:
            known, n_known = known[:0], n_known[:0]
        tokens, owner = tokens[~frequent], owner[~frequent]
        out = []
        for part, at, at_known in _dealt(tokens, known, parts):
            mine, place = np.unique(owner[at], return_inverse=True)
            out.append((
                part, tokens[at].tobytes(), place.astype(np.uint32).tobytes(),
                key[mine].tobytes(), known[at_known].tobytes(),
                n_known[at_known].astype(np.int64).tobytes(),
            ))
        facts = np.stack([np.array(sizes), np.array(lengths), left_out], axis=1).astype(np.int64)
        of = (key.astype(U64) % U64(parts)).astype(np.int64)
        for x in np.unique(of):
            at = of == x
            out.append((-1 - int(x), b"", b"", key[at].tobytes(), b"", facts[at].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PACKED_TYPES, strict=True)],
            names=[x.split()[0] for x in PACKED.split(", ")],
        )

    for key, tokens in sets:
        sizes.append(len(tokens))
        classes.append(key)
        held.append(tokens[: np.searchsorted(tokens, limit, side="right")])
        total += len(held[-1])
        if total >= _FLUSH or len(held) >= 200_000:
            yield from flush()
            held, classes, sizes, total = [], [], [], 0
    if held:
        yield from flush()


_PACKED_TYPES = [pa.int32(), *[pa.binary()] * 5]


def _part_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    """Parts by the high half of a remixed token: the tier's tokens are small numbers."""
    return ((mix(tokens) >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def _dealt(
    tokens: np.ndarray, known: np.ndarray, parts: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    of, of_known = _part_of(tokens, parts), _part_of(known, parts)
    order, order_known = np.argsort(of, kind="stable"), np.argsort(of_known, kind="stable")
    of, of_known = of[order], of_known[order_known]
    for part in np.union1d(of, of_known):
        a, b = np.searchsorted(of, [part, part + 1])
        c, d = np.searchsorted(of_known, [part, part + 1])
        yield int(part), order[a:b], order_known[c:d]


OWNED = "class long, df long, token long, n long, size long, in_tier long"


def _owned(hot: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of one part's packed rows: tokens of two classes or more, with how many hold them.

    Rows of df 0 carry a class's size, its tokens in the tier and how many of them were sent
    without owners; rows of df ``hot`` only count a class's frequent tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, keys, known, counts, facts = [], [], [], [], []
        for batch in batches:
            for part, t, o, c, h, x in zip(*(col.to_pylist() for col in batch.columns),
                                           strict=True):
                key = np.frombuffer(c, dtype=np.int64)
                if part < 0:
                    facts.append((key, np.frombuffer(x, dtype=np.int64).reshape(-1, 3)))
                    continue
                tokens.append(np.frombuffer(t, dtype=U64))
                keys.append(key[np.frombuffer(o, dtype=np.uint32)])
                known.append(np.frombuffer(h, dtype=U64))
                counts.append(np.frombuffer(x, dtype=np.int64))
        for key, fact in facts:
            zero = np.zeros(len(key), dtype=np.int64)
            yield _batch(key, zero, zero, fact[:, 2], fact[:, 0], fact[:, 1])
        if not tokens:
            return
        token, key = np.concatenate(tokens), np.concatenate(keys)
        order = np.lexsort((key, token))
        token, key = token[order], key[order]
        first = np.ones(len(token), dtype=bool)
        first[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key = token[first], key[first]
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])[:len(token)])
        df = np.diff(np.concatenate([starts, [len(token)]]))
        if hot:
            sent = np.unique(np.concatenate(known))
            if len(sent) and len(starts):
                place = np.minimum(np.searchsorted(sent, token[starts]), len(sent) - 1)
                df = np.where(sent[place] == token[starts], hot, df)
            df = np.minimum(df, hot)
        df = np.repeat(df, np.diff(np.concatenate([starts, [len(token)]])))
        rare = (df > 1) & ((df < hot) if hot else True)
        one = np.ones(int(rare.sum()), dtype=np.int64)
        yield _batch(key[rare], df[rare], token[rare].astype(np.int64), one, one * 0, one * 0)
        if hot:
            key, n = np.unique(key[df >= hot], return_counts=True)
            zero = np.zeros(len(key), dtype=np.int64)
            yield _batch(key, zero + hot, zero, n, zero, zero)

    return run


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in OWNED.split(", ")]
    )


def prefix_groups(
    packed: DataFrame, parts: int, percent: int, hot: int
) -> tuple[DataFrame, DataFrame]:
    """((class, token) of shared prefix tokens, classes whose prefix the tier can't tell)."""
    owned = (
        packed.repartition(parts, F.expr("if(part < 0, -1 - part, part)"))
        .mapInArrow(_owned(hot), OWNED)
    )
    of = Window.partitionBy("class")
    rare = F.when((F.col("df") > 0) & (F.col("df") < (hot or 2**62)), F.col("n")).otherwise(0)
    facts = F.col("df") == 0
    chosen = written(
        owned.withColumns({
            "set_size": F.max("size").over(of),
            "tier_size": F.max("in_tier").over(of),
            "left_out": F.min(F.when(facts, F.col("n"))).over(of),
            "returned": F.sum(F.when(~facts, F.col("n")).otherwise(0)).over(of),
            "all_rare": F.sum(rare).over(of),
            "rarer": F.coalesce(F.sum(rare).over(
                of.orderBy("df").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        })
        .withColumn("wanted", F.expr(f"set_size - ceil(set_size * {percent} / 100.0) + 1"))
        .withColumn("wanted", F.expr("wanted - (tier_size - left_out - returned)"))
        .filter(facts | (rare > 0) & (F.col("rarer") < F.col("wanted")))
        .select("class", "token", (facts & (F.col("wanted") > F.col("all_rare"))).alias("needy"),
                facts.alias("facts")),
        "prefixes",
    )
    tokens = chosen.filter(~F.col("facts")).select("class", "token")
    needy = chosen.filter("facts and needy").select("class").distinct()
    return tokens, needy


def hub_links(tokens: DataFrame) -> DataFrame:
    """Links (a, b) from each class to the least class that has one of its tokens too."""
    least = tokens.groupBy("token").agg(
        F.min("class").alias("hub"), F.max("class").alias("last")
    ).filter("hub < last").select("token", "hub")
    return (
        tokens.join(least, "token").filter(F.col("class") != F.col("hub"))
        .select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct()
    )


def ngram_join(
    docs: DataFrame,
    size: int = WORDS,
    percent: int = PERCENT,
    tier: float = TIER,
    hot: int = HOT,
) -> DataFrame:
    """Links between documents whose word n-grams have a Jaccard similarity of percent / 100.

    ``docs`` has doc_id (an integer) and text; other columns are ignored, whatever their names.
    Words are runs of other characters than ASCII white space, A-Z lower-cased. Returns a row
    per row of ``docs``: doc_id, n_shingles (size of its set), component_id (the smallest
    doc_id that links lead to, its own included), n_links (other rows it links with).

    A text of fewer than ``size`` words has one shingle, all of them; a null text, or one
    without words, has none and links with nothing. Rows of one doc_id are rows of their own;
    equal texts link. A null doc_id stays null and is no component_id unless all ids of the
    component are null. An empty table gives an empty result.
    """
    rows = written(set_classes(docs, size), "classes")
    n_rows, total = rows.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    parts = max(shuffle_width(docs), int(total / _TASK_TOKENS) + 1)

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(_distinct(batches, size), parts, tier, hot)

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ((key, np.frombuffer(blob, dtype=U64)) for batch in batches for key, blob in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        return _packed(sets, parts, 1, 0)

    tokens, needy = prefix_groups(
        docs.select("text").mapInArrow(first_round, PACKED), parts, percent, hot
    )
    needy_sets = (
        maybe_keys(class_sets(docs, size), needy, "class").join(needy, "class")
        .dropDuplicates(["class"])
    )
    more, _ = prefix_groups(
        needy_sets.select("class", "tokens").mapInArrow(second_round, PACKED), parts, percent, 0
    )
    groups = written(components(hub_links(tokens).union(hub_links(more))), "groups")
    groups = groups.union(groups.select("component", "component").distinct())
    copies = rows.filter("class is not null").groupBy("class").agg(
        F.count("*").alias("size"), F.max("n_shingles").alias("set_size")
    )
    candidates = written(
        with_parts(
            groups.select(F.col("node").alias("class"), F.col("component").alias("group"))
            .join(copies, "class")
        ), "candidates",
    )
    sets = (
        maybe_keys(class_sets(docs, size), candidates, "class").join(candidates, "class")
        .dropDuplicates(["class"])
        .select("group", "parts", F.col("class").alias("key"), "size", "tokens")
    )
    links = written(verified_links(sets, percent), "links")
    joined = components(links.filter("b is not null").select("a", "b"))
    counted = links.filter("b is null").groupBy(F.col("a").alias("class")).agg(
        F.sum("links").alias("other_links")
    )
    of_class = copies.join(
        joined.select(F.col("node").alias("class"), "component"), "class", "left"
    ).join(counted, "class", "left").withColumn("component", F.coalesce("component", "class"))
    own = rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    of_class = of_class.join(own, "class")
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = written(of_class.join(least, "component").select(
        "class", "component_id", "size",
        (F.col("size") - 1 + F.coalesce("other_links", F.lit(0))).alias("n_links"),
    ), "class-facts")
    return _with_facts(rows, of_class, n_rows).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def _with_facts(rows: DataFrame, of_class: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with component_id and n_links of their class; without a class, doc_id and 0.

    Rows without words and those of hot classes stay where they are: at most ``_HOT_CLASSES``
    classes have more than that part of all rows, so these are broadcast at any size.
    """
    often = F.col("size") * _HOT_CLASSES > n_rows
    hot = of_class.filter(often).drop("size")
    some = rows.filter("class is not null")
    rest = some.join(F.broadcast(hot.select("class")), "class", "left_anti")
    none = rows.filter("class is null").select(
        "*", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    seldom = rest.join(of_class.filter(~often).drop("size"), "class")
    return none.unionByName(some.join(F.broadcast(hot), "class")).unionByName(seldom)


def _distinct(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[int, np.ndarray]]:
    seen: set[int] = set()
    for _, sets in document_sets(batches, size):
        for tokens in sets:
            key = signature(tokens) if len(tokens) else None
            if key is not None and key not in seen:
                seen.add(key)
                yield key, tokens


ORACLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
      lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3),
      lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * i >= 80 * (a.n + b.n - i)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, s.n AS n_shingles, min(r.y) AS component_id,
  (SELECT count(*) FROM links l WHERE l.x = s.doc_id) AS n_links
FROM sizes s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.n
"""
