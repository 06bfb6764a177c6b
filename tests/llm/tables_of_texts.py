"""Texts for the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

# The columns of documents, and some that clash with names the operators use inside.
CLASHING = ("size", "key", "row", "chunk", "node", "order", "label", "n", "copies")
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        *[StructField(name, StringType()) for name in CLASHING],
    ]
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Random words, a third of them frequent, in lines of up to nine."""
    rng = random.Random(seed)
    drawn = [
        rng.choice(WORDS) if rng.random() < 0.3 else f"w{rng.randrange(vocabulary)}x"
        for _ in range(words)
    ]
    lines, at = [], 0
    while at < words:
        step = rng.randint(3, 9)
        lines.append(" ".join(drawn[at : at + step]))
        at += step
    return "\n".join(lines)


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty, short, long, periodic, repeated, edited and shared texts."""
    base, other, passage = prose(1, 120), prose(2, 90), prose(3, 60)
    edited = base.split(" ")
    edited[40] = "changed"
    copies = [(100 + i, prose(4, 70)) for i in range(30)]
    sharing = [(200 + i, f"{prose(50 + i, 25)}\n{passage}\n{prose(90 + i, 25)}") for i in range(25)]
    return [
        (1, base),
        (2, " ".join(edited)),
        (3, base),
        (3, base),  # a repeated row
        (4, other),
        (4, prose(5, 50)),  # another text under the same id
        (5, None),
        (6, ""),
        (7, " \t\n "),
        (8, ""),
        (9, "one"),
        (10, "one"),
        (11, "Two words"),
        (12, "é à ü ñ ß 日本語のテキスト"),
        (13, "日本語" * 200),
        (14, "ab " * 400),
        (15, "ab " * 300),
        (16, "x" * 700),
        (17, "12345 !!! ???"),
        (18, prose(6, 6000)),  # a long text
        (19, f"{other}\n{other}\n{prose(7, 40)}\n{other}"),
        (None, passage),
        (None, prose(8, 40)),
        (None, None),
        (20, f"{prose(9, 14)}\r\n{base[:300]}"),
        *copies,
        *sharing,
    ]


def rows(df, *columns):
    """Sorted tuples, for comparing without an order."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
