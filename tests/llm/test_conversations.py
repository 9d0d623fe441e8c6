"""Repair of conversations against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewise.llm import conversations as C

SCHEMA = ("conv_id long, turn long, role string, text string, piece long, pos long, word string, "
          "audit string, kind int, cost long")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "w", "a", 3, 4) for r in rows], SCHEMA).repartition(3)


def brute_audit(rows):
    """(cost, audit) by a search for the least (cost, edits) over rows, roles and states.

    ``rows`` are (role initial, fault) pairs; whole audits are compared, so states whose edits
    begin alike are all followed.
    """
    accepted = re.compile(r"(s?(ua)+)?")
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if (audit, at, last) in seen:
            continue
        seen.add((audit, at, last))
        if at == len(rows) and last in ("", "a"):
            assert accepted.fullmatch("") is not None
            return cost, audit
        for role in "ua":
            if role in follow[last] and not audit.endswith("III"):
                heapq.heappush(heap, (cost + 2, audit + "I", at, role))
        if at < len(rows):
            role, fault = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role and role in follow[last]:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role))
                for other in "ua":
                    if other in follow[last]:
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", at + 1, other))
    raise AssertionError


def brute(rows):
    """What the query returns of (conv_id, turn, role, text) rows."""
    damaged = {}
    for conv, turn, role, text in rows:
        own = damaged.setdefault(conv, [])
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, own in damaged.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        kinds, seen, counts = [], set(), dict.fromkeys(C.FAULTS, 0)
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else "sound")
            seen.add((role, text))
            counts[fault] += 1
            kinds.append((role[:1], fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = brute_audit(kinds)
        left, edits, state = [], iter(audit), ""
        follow = {"": "user", "s": "user", "u": "assistant", "a": "user"}
        queue = list(own)
        for edit in edits:
            if edit == "I":
                left.append((follow[state], ""))
            else:
                _, role, text = queue.pop(0)
                if edit == "D":
                    continue
                left.append((role if edit == "K" else follow[state], text))
            state = left[-1][0][0]
        assert not queue
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in left))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au")
                      for a, b in zip(kinds, kinds[1:], strict=False))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal,
                    cost, audit, sha))
    return sorted(out, key=str)


def some_rows(seed, n=60):
    dice = random.Random(seed)
    rows = []
    for conv in range(n):
        start, size = dice.randint(-3, 3), dice.choice([1, 2, 3, 5, 8, 11])
        for k in range(size):
            role = dice.choice(["user", "assistant"]) if dice.random() < 0.4 else \
                ["user", "assistant"][k % 2]
            if k == 0 and dice.random() < 0.4 or dice.random() < 0.05:
                role = dice.choice(["system", "tool", "", None, "User"])
            text = dice.choice([None, "", " \t\n", "no stop", "Yes.", "Why?\n", "é!", "one. two"]) \
                if dice.random() < 0.4 else f"Row {conv} {k}."
            rows.append((conv, start + 2 * k if dice.random() < 0.3 else k * 3, role, text))
    turns = set()
    return [r for r in rows if not ((r[0], r[1]) in turns or turns.add((r[0], r[1])))]


AWKWARD = [
    (None, None, "user", "Hello."), (None, 1, None, None), (None, 2, "assistant", "Hi."),
    (-1, None, "system", "Only."), (-2, 5, "user", "y" * 100_000 + "."),
    (-2, 6, "assistant", "z" * 100_000), (-3, 1, "user", "Same."), (-3, 1, "user", "Same."),
]


def result(spark, rows):
    found = C.conversation_repair(table(spark, rows))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
                             "cost", "audit", "repaired_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = some_rows(1) + AWKWARD
    assert result(spark, rows) == brute(rows)


def test_words_cut_anywhere_and_multiplied_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(C, "WORD_ROWS", 2)
    monkeypatch.setattr(C, "FAN_IN", 2)
    rows = some_rows(2, 10) + AWKWARD
    assert result(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert result(spark, []) == []
    turn = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert result(spark, [(7, turn, "user", "Gone.")]) == [
        (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows(spark):
    rows = [(1, 1, "user", "A."), (1, 2, "user", "B."), (1, 3, "assistant", "C."),
            (1, 4, "system", "D."), (2, 1, "assistant", " "), (3, 1, "assistant", "E.")]
    frame = table(spark, rows)
    audited = C.audits(frame)
    audit = {r.conv_id: r.audit for r in audited.collect()}
    assert audit == {1: "KIKKD", 2: "D", 3: "IK"}
    found = C.repaired(frame, audited).orderBy("conv_id", "place").collect()
    for conv in (1, 2, 3):
        roles = "".join(r.role[0] for r in found if r.conv_id == conv)
        assert re.fullmatch("(s?(ua)+)?", roles)
    assert [(r.place, r.role, r.text) for r in found if r.conv_id == 1] == [
        (0, "user", "A."), (1, "assistant", ""), (2, "user", "B."), (3, "assistant", "C.")]


KINDS = [(r, f) for r in C.ROLES for f in C.FAULTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(KINDS), max_size=9), st.integers(0, 3))
def test_products_in_any_grouping(rows, cut):
    word = "".join(C.letter(*x) for x in rows)
    plain = C.Grammar().matrices()
    grammar = C.Grammar()
    grammar.add([(word[i:i + 2], 2) for i in range(len(word) - 1)])
    made = grammar.matrices()
    out = C._identity()
    for symbol in grammar.compressed(word):
        out = C.product(out, made[symbol])
    other = C._identity()
    for symbol in word[cut:]:
        other = C.product(other, plain[symbol])
    head = C._identity()
    for symbol in reversed(word[:cut]):
        head = C.product(plain[symbol], head)
    assert C.cheapest(out) == C.cheapest(C.product(head, other)) == brute_audit(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("DIKR", max_size=40), min_size=1, max_size=6),
       st.lists(st.text("DIKR", max_size=40), min_size=1, max_size=6))
def test_ropes_compare_like_texts(a, b):
    def rope(parts):
        out = C.Rope()
        for k, part in enumerate(parts):
            out = out + C.Rope(part) if k % 2 else C.Rope("", out, C.Rope(part))
        return out

    x, y, s, t = rope(a), rope(b), "".join(a), "".join(b)
    assert str(x) == s and (x < y) == (s < t) and (y < x) == (t < s)


def test_grammar_restores_its_words(spark):
    dice = random.Random(5)
    words = ["".join(dice.choice("AB") for _ in range(dice.randint(1, 200))) for _ in range(50)]
    words += ["AB" * 500] * 3
    grammar = C.induced(spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    assert len(grammar.rules) > 10
    spelled = {}
    for k, (a, b) in enumerate(grammar.rules):
        spelled[grammar.symbol(k)] = spelled.get(a, a) + spelled.get(b, b)
    for word in words:
        short = grammar.compressed(word)
        assert "".join(spelled.get(c, c) for c in short) == word
    assert len(grammar.compressed("AB" * 500)) < 20


@pytest.mark.parametrize("copies", [1, 300])
def test_many_copies_share_a_word(spark, copies):
    rows = [(k, t, ["user", "assistant"][t % 2], f"Text {t}.") for k in range(copies)
            for t in range(6)]
    assert result(spark, rows) == brute(rows)
