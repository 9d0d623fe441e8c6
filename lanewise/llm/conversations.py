"""Cheapest repair of conversations, by min-plus matrices over a grammar of their shapes.

A row's letter says what its role begins with and which fault it has. A conversation is a word
of such letters, and repairing it is a walk through an automaton for "a system turn perhaps,
then user and assistant in turns", where edits have costs. Each letter has a matrix: between any
two states, the least cost and the edits that reach it, ASCII-least of equal costs. The matrix of
a longer word is the min-plus product of the matrices of its parts. (Of two edit sequences for
the same rows at the same cost neither begins with the other, as more insertions cost more. So
the order of edits survives concatenation, and the product is exact.)

Words share parts: Re-Pair replaces frequent neighbours by new symbols, several pairs that can't
overlap at a time, counted over the words of all conversations. One matrix per rule is made
bottom-up from those of its two sides, its edits held as ropes, and is shared by all words.

Words are cut at every 4,096th row of the sorted table, so no conversation needs one task; the
matrices of its pieces are multiplied in a tree.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.llm.staging import shuffle_width, written

#: Rows of a word, pieces that are multiplied in one step, rules of a grammar and of one round.
#: They bound a task's work; results don't depend on them.
WORD_ROWS, FAN_IN, RULES, ROUND_RULES = 4096, 64, 1024, 64

BLANKS = " \t\n\x0b\x0c\r"
#: Costs, and the order of roles and faults within letters.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES, FAULTS = "suao", ("blank", "duplicate", "truncated", "sound")
LEGAL = ("su", "ua", "au")

#: States: nothing yet, after a system turn, after a user, after an assistant.
STATES, ACCEPTED = 4, (0, 3)
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
_BASE, _FIRST_RULE = 0x41, 0x100
_MOD, _STEP = (1 << 61) - 1, 0x5DEECE66D


class Rope:
    """A text as a tree of its parts, which are shared; equal parts have equal hashes."""

    __slots__ = ("left", "right", "text", "size", "hash", "step")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None) -> None:
        self.left, self.right, self.text = left, right, text
        if left is None:
            self.size, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * _STEP + ord(c)) % _MOD
            self.step = pow(_STEP, self.size, _MOD)
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.step + right.hash) % _MOD
            self.step = left.step * right.step % _MOD

    def __reduce__(self):
        return Rope, (self.text, self.left, self.right)

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return other if not self.size else self
        if self.size + other.size <= 64:
            return Rope(str(self) + str(other))
        return Rope("", self, other)

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            rope = stack.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                stack += [rope.right, rope.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """ASCII order; descends only where hashes differ."""
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b or (a.size == b.size and a.hash == b.hash):
                continue
            if a.left is None and b.left is None:
                n = min(a.size, b.size)
                if a.text[:n] != b.text[:n]:
                    return a.text < b.text
                mine += [Rope(a.text[n:])] * (a.size > n)
                theirs += [Rope(b.text[n:])] * (b.size > n)
            elif a.left is not None and (b.left is None or a.size >= b.size):
                mine += [a.right, a.left]
                theirs.append(b)
            else:
                mine.append(a)
                theirs += [b.right, b.left]
        return bool(theirs)


#: ``matrix[i][j]``: (least cost, its ASCII-least edits) from state i to state j; None: no way.
Matrix = list[list[tuple[int, Rope] | None]]


def _least(a: tuple[int, Rope] | None, b: tuple[int, Rope]) -> tuple[int, Rope]:
    if a is None or b[0] < a[0] or (b[0] == a[0] and b[1] < a[1]):
        return b
    return a


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        for k in range(STATES):
            if (left := a[i][k]) is None:
                continue
            for j in range(STATES):
                if (right := b[k][j]) is None:
                    continue
                cost, known = left[0] + right[0], out[i][j]
                if known is None or cost <= known[0]:
                    out[i][j] = _least(known, (cost, left[1] + right[1]))
    return out


def _identity() -> Matrix:
    return [[(0, Rope()) if i == j else None for j in range(STATES)] for i in range(STATES)]


def insertions() -> Matrix:
    """Any number of inserted turns; a user and an assistant lead back where they started."""
    once = _identity()
    for role in "ua":
        for i, j in NEXT[role].items():
            once[i][j] = _least(once[i][j], (INSERT, Rope("I")))
    return product(once, once)


def edits(role: str, fault: str) -> Matrix:
    """Insertions, and then one row kept, given another role, or deleted."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    extra = TRUNCATED * (fault == "truncated")
    for i in range(STATES):
        out[i][i] = (DELETE, Rope("D"))
        if fault in ("blank", "duplicate"):
            continue
        for other in "ua":
            if (j := NEXT[other].get(i)) is not None:
                out[i][j] = _least(out[i][j], (REROLE + extra, Rope("R")))
        if (j := NEXT[role].get(i)) is not None:
            out[i][j] = _least(out[i][j], (extra, Rope("K")))
    return product(insertions(), out)


def letter(role: str, fault: str) -> str:
    return chr(_BASE + len(ROLES) * FAULTS.index(fault) + ROLES.index(role))


def role_and_fault(symbol: str) -> tuple[str, str]:
    fault, role = divmod(ord(symbol) - _BASE, len(ROLES))
    return ROLES[role], FAULTS[fault]


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    ends = product(matrix, insertions())[0]
    best = None
    for state in ACCEPTED:
        if ends[state] is not None:
            best = _least(best, ends[state])
    return best[0], str(best[1])


@dataclass
class Grammar:
    """Rules in the order of their making: rule k replaces two symbols by one."""

    rules: list[str] = field(default_factory=list)

    def symbol(self, k: int) -> str:
        return chr(_FIRST_RULE + k)

    def compressed(self, word: str, start: int = 0) -> str:
        for k in range(start, len(self.rules)):
            word = word.replace(self.rules[k], self.symbol(k))
        return word

    def add(self, counts: list[tuple[str, int]]) -> int:
        """Makes rules of pairs, most frequent first, whose occurrences can't overlap."""
        lefts, rights, before = set(), set(), len(self.rules)
        for (a, b), count in counts:
            if count < 2 or len(self.rules) - before == ROUND_RULES or len(self.rules) == RULES:
                break
            twin = a == b and (a in lefts or a in rights)
            if a in rights or b in lefts or twin:
                continue
            self.rules.append(a + b)
            lefts.add(a)
            rights.add(b)
        return len(self.rules) - before

    def matrices(self) -> dict[str, Matrix]:
        """One matrix per letter and rule, bottom-up."""
        out = {letter(r, f): edits(r, f) for r in ROLES for f in FAULTS}
        for k, (a, b) in enumerate(self.rules):
            out[self.symbol(k)] = product(out[a], out[b])
        return out


def induced(words: DataFrame) -> Grammar:
    """Re-Pair over the distinct ``word`` strings, each counted ``n`` times.

    A round counts all pairs of neighbours in a shuffle and rewrites the words; rounds end when no
    pair occurs twice or the grammar has ``RULES`` rules.
    """
    grammar = Grammar()
    while True:
        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter[str] = Counter()
            for batch in batches:
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                   strict=True):
                    for a, b in zip(word, word[1:], strict=False):
                        counts[a + b] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["pair", "n"])

        counted = (
            words.select("word", "n").mapInArrow(pairs, "pair string, n long")
            .groupBy("pair").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "pair").limit(16 * ROUND_RULES).collect()
        )
        start = len(grammar.rules)
        if not grammar.add([(r.pair, r.n) for r in counted]):
            return grammar
        rules = Grammar(list(grammar.rules))

        def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([
                    pa.array([rules.compressed(w, start) for w in batch.column(0).to_pylist()],
                             pa.string()), batch.column(1)], names=["word", "n"])

        words = written(words.mapInArrow(rewritten, "word string, n long"), "words")


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows with faults by crc32 of "conv_id:turn" modulo 20.

    A null is one space: in that key, as a role, and as a text. 0 drops the row, 1 empties its text,
    2 removes its stops, 3 repeats it, 4 makes its role user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" "))
                             for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    fault = F.col("fault")
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                             (F.crc32(key) % 20).alias("fault"))
        .filter(fault != 0)
        .select(
            "conv_id", "turn",
            F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")).alias("text"),
            F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1)))
                      .otherwise(F.array(F.lit(0)))).alias("copy"),
        ).drop("copy")
    )


def _plain(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        "conv_id", "turn",
        *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))


#: 128 bits of role and text. Rows of one turn are in the order of role and these.
def _marks() -> list[Column]:
    return [F.xxhash64("role", "text").alias("mark"),
            F.xxhash64(F.lit("again"), "role", "text").alias("other_mark")]


ORDER = ("conv_id", "turn", "role", "mark", "other_mark")


def _letters(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, pos, letter): ``pos`` is a place in the order of the whole table."""
    ends = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id", "turn", "role", *_marks(),
        (ends == "").alias("blank"), F.substring(ends, -1, 1).isin(".", "!", "?").alias("whole"),
        # Only keeps rows that are equal in all else from meeting in one partition.
        F.monotonically_increasing_id().alias("spread"),
    )
    order = [*ORDER, "spread"]
    in_order = written(
        narrow.repartitionByRange(shuffle_width(rows), *order).sortWithinPartitions(*order)
        .select("conv_id", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
                .alias("initial"), "mark", "other_mark", "blank", "whole",
                F.monotonically_increasing_id().alias("pos")), "turns")
    firsts = (
        in_order.filter(~F.col("blank")).groupBy("conv_id", "mark", "other_mark")
        .agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    )
    fault = (
        F.when(F.col("blank"), 0).when(F.col("is_first").isNull(), 1)
        .when(~F.col("whole"), 2).otherwise(3)
    )
    role = F.instr(F.lit(ROLES), F.col("initial")) - 1
    code = F.lit(_BASE) + F.lit(len(ROLES)) * fault + role
    return in_order.join(firsts, "pos", "left").select(
        "conv_id", "turn", "pos", F.char(code).alias("letter"))


def _words(letters: DataFrame) -> DataFrame:
    """Rows of one conversation within a stretch of ``WORD_ROWS`` places, as one word."""
    return letters.groupBy("conv_id", F.expr(f"pos div {WORD_ROWS}").alias("piece")).agg(
        F.concat_ws("", F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]
        )).alias("word"),
        F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).cast("long").alias("turns"),
        (F.min("pos") % WORD_ROWS == 0).alias("opened"),
    )


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
NUMBERS = ("blank", "duplicate", "truncated", "illegal")


def _piece_schema(given: pa.Schema) -> pa.Schema:
    like = {name: given.field(name).type for name in ("conv_id", "low", "high")}
    long, string = pa.int64(), pa.string()
    return pa.schema([
        ("conv_id", like["conv_id"]), ("piece", long), ("low", like["low"]),
        ("high", like["high"]), ("turns", long), *((c, long) for c in NUMBERS),
        ("first", string), ("last", string), ("costs", pa.list_(long)),
        ("edits", pa.list_(string)),
    ])


def _piece_fields(conversations: DataFrame) -> str:
    conv, turn = (conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    return (
        f"conv_id {conv}, piece long, low {turn}, high {turn}, turns long, blank long, "
        "duplicate long, truncated long, illegal long, first string, last string, "
        "costs array<long>, edits array<string>"
    )


def _flat(matrix: Matrix) -> dict:
    cells = [x for row in matrix for x in row]
    return {"costs": [None if x is None else x[0] for x in cells],
            "edits": [None if x is None else str(x[1]) for x in cells]}


def _matrix(piece: dict) -> Matrix:
    cells = [None if c is None else (c, Rope(e))
             for c, e in zip(piece["costs"], piece["edits"], strict=True)]
    return [cells[i:i + STATES] for i in range(0, len(cells), STATES)]


def _summary(word: str, matrix: Matrix) -> dict:
    kinds = [role_and_fault(c) for c in word]
    faults = Counter(f for _, f in kinds)
    roles = "".join(r for r, _ in kinds)
    return {
        **{f: faults[f] for f in FAULTS[:3]}, "first": roles[0], "last": roles[-1],
        "illegal": sum(a + b not in LEGAL for a, b in zip(roles, roles[1:], strict=False)),
        **_flat(matrix),
    }


def _merged(a: dict, b: dict) -> dict:
    """Two neighbouring pieces of a conversation as one; turns grow from a to b."""
    out = a | {k: a[k] + b[k] for k in COUNTS}
    out["illegal"] += a["last"] + b["first"] not in LEGAL
    # A turn on both sides counts once.
    out["turns"] -= b["low"] is not None and a["high"] == b["low"]
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    return out | {"last": b["last"], **_flat(product(_matrix(a), _matrix(b)))}


def _pieces(words: DataFrame, grammar: Grammar, fields: str) -> DataFrame:
    """Matrix and counts of each word."""
    sent = words.sparkSession.sparkContext.broadcast((grammar, grammar.matrices()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, of = sent.value

        @functools.lru_cache(maxsize=1 << 12)
        def summary(word: str) -> dict:
            return _summary(word, functools.reduce(
                product, (of[symbol] for symbol in grammar.compressed(word))))

        for batch in batches:
            yield pa.RecordBatch.from_pylist(
                [row | summary(row["word"]) for row in batch.to_pylist()],
                schema=_piece_schema(batch.schema))

    return words.select("conv_id", "piece", "word", "low", "high", "turns").mapInArrow(rows, fields)


def _multiplied(pieces: DataFrame, fields: str) -> DataFrame:
    """Each conversation's pieces as one, ``FAN_IN`` neighbours in a step."""
    rounds = 0
    while pieces.groupBy("conv_id").count().filter("count > 1").limit(1).count():
        rounds += 1
        span = FAN_IN ** rounds

        def folded(batches: Iterator[pa.RecordBatch], span: int = span) -> Iterator[pa.RecordBatch]:
            held = schema = None
            for batch in batches:
                schema, out = batch.schema, []
                for row in batch.to_pylist():
                    if held is None:
                        held = row
                    elif (held["conv_id"] == row["conv_id"]
                          and held["piece"] // span == row["piece"] // span):
                        held = _merged(held, row)
                    else:
                        out.append(held)
                        held = row
                yield pa.RecordBatch.from_pylist(out, schema=schema)
            if held is not None:
                yield pa.RecordBatch.from_pylist([held], schema=schema)

        pieces = written(
            pieces.repartition(shuffle_width(pieces), "conv_id", F.expr(f"piece div {span}"))
            .sortWithinPartitions("conv_id", "piece").mapInArrow(folded, fields), "pieces")
    return pieces


def audits(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), a row per conversation.

    Rows of ``conversations`` (conv_id, turn, role, text; other columns aren't read) are in the
    order of turn, nulls first; rows of one turn in the order of role and a hash of role and text.
    A null role or text is one space, a null conv_id is a conversation. A row's first fault
    counts: blank, duplicate (an earlier row has its role and text), truncated. ``gaps`` are turn numbers
    left out between the least and the greatest; ``illegal`` counts neighbours whose roles don't
    begin with su, ua or au. ``audit`` has the edits (K keep, R other role, D delete, I insert) at
    the least ``cost`` that leave nothing, or one system turn perhaps and then user and
    assistant in turns. No rows give no rows.

    Texts aren't shuffled, only 128 bits for each. Rows are sorted by ranges, so a conversation
    of any length is spread; a task holds a word of 4,096 rows, or the edits of one conversation.
    """
    fields = _piece_fields(conversations)
    words = written(_words(_letters(_plain(conversations))), "words")
    grammar = induced(words.groupBy("word").agg(F.count("*").alias("n")))
    pieces = written(_pieces(words, grammar, fields), "pieces")
    # Only a piece that begins at a cut can have another one before it.
    cut = written(words.filter("opened").select(F.col("conv_id").alias("same")).distinct(), "cut")
    same = F.col("conv_id").eqNullSafe(F.col("same"))
    whole = pieces.join(cut, same, "left_anti").unionByName(
        _multiplied(written(pieces.join(cut, same, "left_semi"), "cut"), fields))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.to_pylist()
            best = [cheapest(_matrix(piece)) for piece in found]
            gaps = [0 if p["low"] is None else p["high"] - p["low"] + 1 - p["turns"]
                    for p in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(gaps, pa.int64()),
                *(batch.column(batch.schema.get_field_index(c)) for c in NUMBERS),
                pa.array([c for c, _ in best], pa.int64()),
                pa.array([a for _, a in best], pa.string()),
            ], names=["conv_id", "gaps", *NUMBERS, "cost", "audit"])

    conv = conversations.schema["conv_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in ("gaps", *NUMBERS, "cost"))
    return written(whole.mapInArrow(rows, f"conv_id {conv}, {numbers}, audit string"), "audits")


class Replay:
    """Applies an audit to the rows of a conversation, in their order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _next(self) -> str:
        role = "assistant" if self.state == 2 else "user"
        self.state = NEXT[role[0]][self.state]
        return role

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._next(), "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of what stands before the row and of the row, if it stays."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self._next(), text, edit
        elif edit == "K":
            self.state = NEXT[role[0]][self.state]
            yield role, text, edit


def _with_audits(conversations: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit, and then its rows in order, in one partition."""
    rows = _plain(conversations).select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text", *_marks())
    turn = conversations.schema["turn"].dataType
    first = audited.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(turn).alias("turn"),
        F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("mark"),
        F.lit(0).cast("long").alias("other_mark"))
    return (
        first.unionByName(rows).repartition(shuffle_width(conversations), "conv_id")
        .sortWithinPartitions("conv_id", "kind", *ORDER[1:])
        .select("conv_id", "kind", "role", "text")
    )


def repaired(conversations: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the rows that the ``audits`` of these rows leave.

    ``place`` counts from 0 within a conversation; deleted rows are gone, inserted ones have an
    empty text. One task streams all rows of a conversation and holds none of them.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, conv, place, schema = None, None, 0, None
        for batch in batches:
            out = []
            schema = pa.schema([
                ("conv_id", batch.schema.field(0).type), ("place", pa.int64()),
                ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
            for key, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind:
                    found = [(conv, *x) for x in replay.row(role, text)]
                else:
                    found = [(conv, *x) for x in replay.inserted()] if replay else []
                for of, *x in found:
                    out.append((of, place, *x))
                    place += 1
                if not kind:
                    replay, conv, place = Replay(text), key, 0
            yield _tuples(out, schema)
        if replay is not None:
            yield _tuples([(conv, place + k, *x) for k, x in enumerate(replay.inserted())], schema)

    conv = conversations.schema["conv_id"].dataType.simpleString()
    return _with_audits(conversations, audited).mapInArrow(
        rows, f"conv_id {conv}, place long, role string, text string, edit string")


def digests(conversations: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the rows of ``repaired`` as role:text, newline-joined."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = schema = None
        conv, sha, begun, out = None, hashlib.sha256(), False, []

        def add(found: Iterator[tuple[str, str, str]]) -> None:
            nonlocal begun
            for role, text, _ in found:
                sha.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True

        for batch in batches:
            schema = pa.schema([("conv_id", batch.schema.field(0).type),
                                ("repaired_sha256", pa.string())])
            out = []
            for key, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind:
                    add(replay.row(role, text))
                    continue
                if replay is not None:
                    add(replay.inserted())
                    out.append((conv, sha.hexdigest()))
                replay, conv, sha, begun = Replay(text), key, hashlib.sha256(), False
            yield _tuples(out, schema)
        if replay is not None:
            add(replay.inserted())
            yield _tuples([(conv, sha.hexdigest())], schema)

    conv = conversations.schema["conv_id"].dataType.simpleString()
    return _with_audits(conversations, audited).mapInArrow(
        rows, f"conv_id {conv}, repaired_sha256 string")


def _tuples(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def conversation_repair(conversations: DataFrame) -> DataFrame:
    """A row per conv_id of ``conversations``: counts, cost and audit of ``audits`` and digests of
    ``repaired``, after ``damage``. A conversation without rows after the damage has zeros, an
    empty audit and the digest of the empty text."""
    rows = damage(conversations)
    found = audits(rows)
    hashes = digests(rows, found)
    ids = conversations.select("conv_id").distinct()
    counts = found.withColumnRenamed("conv_id", "same")
    hashes = hashes.withColumnRenamed("conv_id", "hashed")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        ids.join(counts, F.col("conv_id").eqNullSafe(F.col("same")), "left")
        .join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
        .select(
            "conv_id",
            *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
              for c in ("gaps", *NUMBERS, "cost")),
            F.coalesce(F.col("audit"), F.lit("")).alias("audit"),
            F.coalesce(F.col("repaired_sha256"), empty).alias("repaired_sha256"),
        )
    )
