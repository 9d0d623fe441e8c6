"""Small tables with every awkward case, and brute force to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words long, "
    "key long, class string, component long, label int, score double, row string, part int, "
    "tokens string, cluster long, kept string, fold int, weight double"
)

WORDS = ["".join(random.Random(k).choices("abcdeghilmnorstuv", k=3 + k % 7)) for k in range(400)]


def prose(seed: int, n: int) -> str:
    dice = random.Random(seed)
    out = []
    for k in range(n):
        word = dice.choice(WORDS)
        out.append(word + ("." if k % 9 == 8 else "") + ("\n" if k % 37 == 36 else ""))
    return " ".join(out)


def edited(text: str, seed: int, share: float) -> str:
    dice = random.Random(seed)
    words = text.split(" ")
    return " ".join(dice.choice(WORDS) if dice.random() < share else w for w in words)


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    """The texts with columns whose names operators might use themselves."""
    rows = [
        (i, t, ["en", "de", None][k % 3], f"src{k % 2}", 1, 2, 3, "x", 4, 5, 0.5, "r", 6, "t", 7,
         "no", 8, 9.0)
        for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def awkward() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, very long ones, equal texts, and repeated rows."""
    long = prose(99, 30_000)
    return [
        (1, prose(1, 120)), (2, prose(1, 120)), (3, prose(1, 120).upper()), (4, None), (5, ""),
        (6, " \t\n \r\n"), (7, "one two"), (8, "one  two"), (9, long), (10, long + " end"),
        (11, prose(2, 90)), (11, prose(2, 90)), (11, prose(3, 90)), (None, prose(4, 60)),
        (None, None), (12, edited(prose(1, 120), 5, 0.01)), (13, "a" * 70_000),
        (14, "\n".join(["same line here"] * 40)), (15, "é ü ß 日本 " * 30), (16, "  x y"),
    ]


def shingle_set(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return set()
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))}


def brute_links(sets: list[set], percent: int = 80) -> list[tuple[int, int]]:
    out = []
    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and 100 * len(x & sets[b]) >= percent * len(x | sets[b]):
                out.append((a, b))
    return out


def brute_components(n: int, links: list[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(x) for x in range(n)]
