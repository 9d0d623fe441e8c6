"""Personal data in texts: anchors by Aho-Corasick, then parsers that expand each anchor.

One automaton pass finds at-signs, digits, plus signs, schemes and the cues of identifiers.
A parser per kind looks only around its anchors, in order of position, and never twice at the
same characters, so its matches are the leftmost ones that don't overlap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order in which spans of one start are listed; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "secret", "account")
BASE = KINDS[:4]

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL_REST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
VALUE = re.compile(r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_./+=-]{6,})")
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")
IBAN = re.compile(r"(?:\s{0,3}[:=])?\s{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")

CUES = ("password", "passwd", "secret", "token", "api_key", "api-key", "apikey")


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for digit in "0123456789":
        out.add_word(digit, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme"), ("www.", "www"),
                       ("AKIA", "key"), ("IBAN", "iban")):
        out.add_word(word, (kind, len(word)))
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            out.add_word(form, ("cue", len(form)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _part_ok(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _iban_ok(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind as listed."""
    free = dict.fromkeys(KINDS, 0)  # of each kind, where its next match may begin
    out = []

    def take(kind: str, start: int, end: int, valid: bool = True) -> None:
        free[kind] = end
        if valid:
            out.append((start, end, kind))

    for last, (anchor, size) in automaton.iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at and "0" <= text[at - 1] <= "9":
                continue  # parsed with the run's first digit
            if at >= free["ip"] and (m := IP.match(text, at)):
                take("ip", at, m.end(), all(map(_part_ok, m[0].split("."))))
            if at >= free["card"] and (m := CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                take("card", at, m.end(), 12 <= len(digits) <= 19 and luhn(digits))
        elif anchor == "at":
            start = at
            while start > free["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                take("email", start, m.end())
        elif anchor == "plus":
            if at >= free["phone"] and (m := PHONE.match(text, at)):
                digits = sum("0" <= c <= "9" for c in m[0])
                take("phone", at, m.end(), 9 <= digits <= 15)
        elif anchor in ("scheme", "www"):
            start, rest = at, at
            if anchor == "scheme":
                rest = last + 1
                while start > free["url"] and text[start - 1].isascii() and text[start - 1].isalpha():
                    start -= 1
            fits = start < rest if anchor == "scheme" else not (at and text[at - 1].isalnum())
            if at >= free["url"] and fits and (m := URL_REST.match(text, rest)):
                take("url", start, m.end())
        elif anchor == "key":
            if at >= free["secret"] and (m := ACCESS_KEY.match(text, at)):
                take("secret", at, m.end())
        elif anchor == "cue":
            if at >= free["secret"] and (m := VALUE.match(text, last + 1)):
                take("secret", m.start(1), m.end(1))
        elif at >= free["account"] and (m := IBAN.match(text, last + 1)):
            take("account", m.start(1), m.end(1), _iban_ok(m[1]))
    place = {kind: k for k, kind in enumerate(KINDS)}
    return sorted(out, key=lambda span: (span[0], place[span[2]]))


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string"
)


def personal_data(docs: DataFrame) -> DataFrame:
    """The spans of personal data in each row of ``docs``, which has doc_id and text.

    Returns doc_id, the number of spans of each base kind, the SHA-256 of the list of base
    spans, and the list of all spans, kind:start:end in code points with the end exclusive. A
    null text is empty: no spans, and the hash of an empty list. Repeated rows stay; other
    columns are ignored; an empty table gives an empty result.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            counts: list[list[int]] = []
            hashes, listed = [], []
            for text in batch.column(1):
                spans = find_spans(text.as_py() or "", automaton)
                base = [s for s in spans if s[2] in BASE]
                counts.append([sum(s[2] == kind for s in base) for kind in BASE])
                hashes.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                listed.append(_listed(spans))
            columns = list(zip(*counts, strict=True)) or [[]] * len(BASE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns),
                 pa.array(hashes, pa.string()), pa.array(listed, pa.string())],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, SCHEMA
    )
