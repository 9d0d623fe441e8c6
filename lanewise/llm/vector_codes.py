"""Product codes of vectors, by rounds of Lloyd's method that look at moved entries only.

A vector is cut into parts; each part position has a codebook, and a part's code is the index of
its nearest entry. After an update most entries stand still in later rounds. A part whose own
entry stood still knows its distance to it, and every other entry that stood still is no better
than it was: only the moved entries are compared with the stored distance. A part whose entry
moved is compared with all. Of equal distances the lower index wins in either case.

Vectors are kept as blocks, a row each: ids, integer components, codes and distances of some
thousand vectors. A round reads the blocks of the one before, writes its own, and adds one row
per task with the sums of its parts by entry. Only the codebooks pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.llm.staging import remove, scratch, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bytes of components in a block, and parts that are compared with a codebook at a time.
BLOCK_BYTES, STEP = 1 << 21, 2048


def finite(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector isn't null and holds neither null nor non-finite components."""
    return vectors.filter(
        F.col(column).isNotNull()
        & F.forall(column, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    )


def scaled(components: np.ndarray, dim: int) -> np.ndarray:
    """The integer components of vectors of ``dim``. Raises an error where one is so large that
    a squared distance might not fit a long."""
    out = np.floor(components.astype(np.float64) * SCALE)
    if out.size and 4.0 * dim * float(np.abs(out).max()) ** 2 >= 2.0 ** 62:
        raise ArithmeticError("a component is too large: squared distances would not fit a long")
    return out.astype(np.int64)


def _narrow(components: np.ndarray) -> np.ndarray:
    most = int(np.abs(components).max()) if components.size else 0
    return components.astype(np.int16 if most < 1 << 15 else np.int32)


@dataclass
class Codebooks:
    """``entries[part, entry, position]``, and which entries the last update moved."""

    entries: np.ndarray
    moved: np.ndarray

    def digest(self) -> str:
        flat = ",".join(map(str, self.entries.ravel().tolist()))
        return hashlib.sha256(flat.encode()).hexdigest()


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all ``parts`` to all ``entries``, both of integers."""
    most = max((int(np.abs(x).max()) for x in (parts, entries) if x.size), default=0)
    if 4 * parts.shape[1] * most * most < 1 << 53:
        # Whole numbers of that size are exact in floating point, in any order of addition.
        a, b = parts.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    out = np.zeros((len(parts), len(entries)), dtype=np.int64)
    for k in range(parts.shape[1]):
        out += (parts[:, k, None] - entries[None, :, k]) ** 2
    return out


def assign(
    parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray | None,
    distance: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray]:
    """(code, distance) of the parts at one position, from those before the entries moved."""
    if code is None:
        code, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        stale = np.ones(len(parts), dtype=bool)
    else:
        code, distance = code.astype(np.int64), distance.copy()
        stale = moved[code]
    for rows, index in ((np.flatnonzero(stale), np.arange(len(entries))),
                        (np.flatnonzero(~stale), np.flatnonzero(moved))):
        if not len(index):
            continue
        for k in range(0, len(rows), STEP):
            some = rows[k:k + STEP]
            found = distances(parts[some], entries[index])
            best = found.argmin(1)
            least, entry = found[np.arange(len(some)), best].astype(np.int64), index[best]
            better = stale[some] | (least < distance[some])
            better |= (least == distance[some]) & (entry < code[some])
            some = some[better]
            code[some], distance[some] = entry[better], least[better]
    return code, distance


def _sums(parts: np.ndarray, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    at = np.searchsorted(code[order], np.arange(entries))
    count = np.bincount(code, minlength=entries)
    total = np.zeros((entries, parts.shape[1]), dtype=np.int64)
    held = count > 0
    if held.any():
        total[held] = np.add.reduceat(parts[order].astype(np.int64), at[held], axis=0)
    return count, total


STATE = "components binary, width int, dim int, codes binary, distances binary"
SUMS = "counts binary, sums binary"


def _blocks(vectors: DataFrame, key: str, column: str, label: str) -> DataFrame:
    """The kept vectors as blocks, each of vectors with the same number of components."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in (key, label)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                step = max(1, BLOCK_BYTES // max(1, 4 * int(dim)))
                for k in range(0, len(at), step):
                    some = pa.array(at[k:k + step])
                    n = len(some)
                    values = scaled(lists.take(some).flatten().to_numpy(zero_copy_only=False),
                                    int(dim))
                    values = _narrow(values)
                    whole = pa.array([0, n], pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        *(pa.ListArray.from_arrays(whole, batch.column(c).take(some))
                          for c in (0, 1)),
                        pa.array([n], pa.int64()), pa.array([values.tobytes()], pa.binary()),
                        pa.array([values.itemsize], pa.int32()), pa.array([int(dim)], pa.int32()),
                        pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                    ], names=["ids", "labels", "n", "components", "width", "dim", "codes",
                              "distances"])

    return finite(vectors, column).select(key, label, column).mapInArrow(
        rows, f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, n long, {STATE}")


def _opened(batch: pa.RecordBatch, k: int, parts: int) -> tuple[np.ndarray, list, list]:
    """Of one block: components by vector and part; codes and distances by part, if there."""
    value = {c: batch.column(c)[k].as_py() for c in
             ("n", "components", "width", "dim", "codes", "distances")}
    n, dim = value["n"], value["dim"]
    held = np.frombuffer(value["components"], dtype=f"<i{value['width']}")
    held = held.reshape(n, parts, dim // parts).astype(np.int64)
    if value["codes"] is None:
        return held, [None] * parts, [None] * parts
    codes = np.frombuffer(value["codes"], dtype=np.uint8).reshape(parts, n)
    return held, list(codes), list(np.frombuffer(value["distances"], "<i8").reshape(parts, n))


def _assigned(batch: pa.RecordBatch, k: int, books: Codebooks) -> tuple[np.ndarray, list, list]:
    held, codes, known = _opened(batch, k, len(books.entries))
    for part, (entries, moved) in enumerate(zip(books.entries, books.moved, strict=True)):
        codes[part], known[part] = assign(
            held[:, part], entries, moved, codes[part], known[part])
    return held, codes, known


def _round(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """The blocks after one assignment, and rows with counts and sums, one per task."""
    sent = blocks.sparkSession.sparkContext.broadcast(books)
    state = [c for c in blocks.columns if c not in ("counts", "sums")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, schema = sent.value, None
        parts, entries, size = books.entries.shape
        counts = np.zeros((parts, entries), dtype="<i8")
        sums = np.zeros((parts, entries, size), dtype="<i8")
        for batch in batches:
            for k in range(len(batch)):
                held, codes, known = _assigned(batch, k, books)
                for part in range(parts):
                    count, total = _sums(held[:, part], codes[part], entries)
                    counts[part] += count
                    sums[part] += total
                row = batch.slice(k, 1)
                out = pa.RecordBatch.from_arrays([
                    *(row.column(c) for c in state[:-2]),
                    pa.array([np.array(codes, np.uint8).tobytes()], pa.binary()),
                    pa.array([np.array(known, "<i8").tobytes()], pa.binary()),
                    pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                ], names=[*state, "counts", "sums"])
                schema = out.schema
                yield out
        if schema is not None:
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(1, field.type) for field in list(schema)[:-2]),
                pa.array([counts.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary()),
            ], schema=schema)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema if f.name in state]
    return blocks.select(*state).mapInArrow(rows, ", ".join([*fields, SUMS]))


def _updated(blocks: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry as the floor of its parts' mean; one without parts stays."""
    shape = books.entries.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((shape[0] * shape[1], shape[2] + 1), dtype=np.int64)
        for batch in batches:
            for counts, sums in zip(batch.column(0), batch.column(1), strict=True):
                total[:, 0] += np.frombuffer(counts.as_py(), "<i8")
                total[:, 1:] += np.frombuffer(sums.as_py(), "<i8").reshape(-1, shape[2])
        used = np.flatnonzero(total[:, 0])
        place = np.tile(np.arange(shape[2] + 1), len(used))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, shape[2] + 1)), pa.array(place),
             pa.array(total[used].ravel())], names=["slot", "place", "total"])

    found = (
        blocks.filter("sums is not null").select("counts", "sums")
        .mapInArrow(rows, "slot long, place long, total long")
        .groupBy("slot", "place").agg(F.sum("total").alias("total")).toPandas()
    )
    total = np.zeros((shape[0] * shape[1], shape[2] + 1), dtype=np.int64)
    total[found["slot"], found["place"]] = found["total"]
    entries, used = books.entries.reshape(-1, shape[2]).copy(), total[:, 0] > 0
    entries[used] = total[used, 1:] // total[used, :1]
    entries = entries.reshape(shape)
    return Codebooks(entries, (entries != books.entries).any(2))


def _first_books(
    vectors: DataFrame, blocks: DataFrame, dim: int, key: str, column: str, parts: int,
    entries: int,
) -> Codebooks:
    ids = blocks.select(F.explode("ids").alias("id")).distinct()
    smallest = [r.id for r in ids.orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()]
    known = [x for x in smallest if x is not None]
    wanted = F.lit(False) if not known else F.col(key) <= max(known)
    if len(known) < len(smallest):
        wanted = wanted | F.col(key).isNull()
    rows = (
        finite(vectors, column).filter(wanted & (F.size(column) == dim))
        .groupBy(key).agg(F.min(column).alias("v")).orderBy(F.col(key).asc_nulls_last()).collect()
    )
    books = scaled(np.array([r.v for r in rows], dtype=np.float64), dim).reshape(
        len(rows), parts, dim // parts).transpose(1, 0, 2).copy()
    return Codebooks(books, np.ones(books.shape[:2], dtype=bool))


def compress(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(rows of key, label, code, error; the final codebooks) of the kept vectors.

    Vectors that are null or hold null or non-finite components are dropped. So are those
    whose number of components isn't the most frequent one (of ties, the larger) among the
    numbers that ``parts`` divides. The codebooks start with the vectors of the ``entries``
    smallest keys, at most 256, a null key last; of several vectors with one key, the smallest
    one. Each row is kept and coded, repeated keys and vectors too. No kept vectors give no rows.
    Other columns aren't read. ``error`` is the squared distance, summed over parts. Components so
    large that it might not fit a long (some 130,000 in 64 of them) raise an error.

    A task holds a block of about 2 MB and the codebooks. Vectors are never shuffled; a round
    shuffles at most a codebook's worth of sums per task.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte: at most 256 entries")
    spark = vectors.sparkSession
    blocks, path = _stored(_blocks(vectors, key, column, label))
    sizes = blocks.groupBy("dim").agg(F.sum("n").alias("n")).filter(F.col("dim") % parts == 0)
    most = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    kinds = [vectors.schema[c].dataType.simpleString() for c in (key, label)]
    schema = f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long"
    if most is None:
        empty = np.zeros((parts, 0, 0), dtype=np.int64)
        return spark.createDataFrame([], schema), Codebooks(empty, empty.any(2))
    blocks = blocks.filter(F.col("dim") == most.dim)
    books = _first_books(vectors, blocks, most.dim, key, column, parts, entries)
    for _ in range(rounds):
        after, new_path = _stored(_round(blocks, books))
        remove(spark, path)
        books, path = _updated(after, books), new_path
        blocks = after.filter("n is not null")
    sent = spark.sparkContext.broadcast(books)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                _, codes, known = _assigned(batch, k, sent.value)
                text = np.array(codes, np.uint8).T.tobytes().hex()
                size = 2 * len(codes)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(k, 1).flatten(), batch.column(1).slice(k, 1).flatten(),
                    pa.array([text[i:i + size] for i in range(0, len(text), size)], pa.string()),
                    pa.array(np.sum(known, axis=0, dtype=np.int64)),
                ], names=["vec_id", "label", "code", "error"])

    state = [c for c in blocks.columns if c not in ("counts", "sums")]
    out = written(blocks.select(*state).mapInArrow(rows, schema), "codes")
    remove(spark, path)
    return out, books


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    path = scratch(df.sparkSession, "blocks")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def vector_codes(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the kept vectors of ``compress``.

    ``label_error`` adds up the errors of all kept vectors with the same label; null labels
    count as one. Errors are added up per label before they are joined.
    """
    coded, books = compress(vectors)
    of_label = written(
        coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels"
    ).withColumnRenamed("label", "same")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    """Plain rounds over all entries, for tables of some thousand vectors."""
    steps = [f"""
kept as materialized (
  select row_number() over () as r, vec_id, label,
    list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as materialized (
  select r, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] as x
  from kept, range({PARTS}) as t(p)
),
book0 as materialized (
  select p, e, x from parts join (
    select r, row_number() over (order by vec_id) - 1 as e from kept
    qualify row_number() over (order by vec_id) <= {ENTRIES}
  ) using (r)
)"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""
near{k} as materialized (
  select r, p, min(cast(d as hugeint) * {ENTRIES} + e) as best from (
    select r, p, e, list_sum(list_transform(
      list_zip(parts.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
    from parts join book{k} as b using (p)
  ) group by r, p
)""")
        if k < ROUNDS:
            steps.append(f"""
sums{k} as (
  select p, cast(best % {ENTRIES} as bigint) as e, i, cast(sum(x[i]) as bigint) as s,
    count(*) as n
  from near{k} join parts using (r, p), unnest(range(1, len(x) + 1)) as u(i) group by all
),
book{k + 1} as materialized (
  select p, e, coalesce(m.x, b.x) as x from book{k} as b left join (
    select p, e, list((s - ((s % n) + n) % n) // n order by i) as x from sums{k} group by p, e
  ) as m using (p, e)
)""")
    return f"""with {",".join(steps)},
coded as (
  select r, string_agg(printf('%02x', cast(best % {ENTRIES} as integer)), '' order by p) as code,
    cast(sum(best // {ENTRIES}) as bigint) as error
  from near{ROUNDS} group by r
)
select vec_id, code, error,
  cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) from book{ROUNDS})
    as codebooks_sha256
from kept join coded using (r)"""


ORACLE_SQL = _oracle()
