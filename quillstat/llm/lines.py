"""Line dedup: repeated windows of three consecutive lines keep their first place only.

All windows of ``WINDOW`` consecutive lines are hashed to 128 bits and compared across
the corpus. The first window of its kind, by id and line, stays; the lines of all later
ones are marked, marks are merged, and marked lines go.

Defined results: lines end at each newline and are compared byte by byte, blank lines
too; null and empty texts are one empty line; a text with fewer lines than a window
stays whole; of rows that repeat an id, windows at the same line do not remove each
other; null ids come after all others; no rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.arrays import chain, hash_spans
from quillstat.llm.chunks import (
    TABLE, Asked, answered, buckets_for, chunked, groups, least_of, ordered, table,
)

WINDOW = 3
_RECORD = np.dtype([("one", "<u8"), ("two", "<u8"), ("id", "<i8"), ("line", "<i8")])


class _Lines:
    """The lines of a chunk and its windows."""

    def __init__(self, pdf: pd.DataFrame, window: int) -> None:
        self.given, ids, self.texts = ordered(pdf)
        buf = np.frombuffer(b"\n".join([*self.texts, b""]) + bytes(8), np.uint8)
        self.end = np.flatnonzero(buf[:-8] == 0x0A)
        start = np.concatenate([[0], self.end[:-1] + 1])
        self.counts = np.array([t.count(b"\n") + 1 for t in self.texts])
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        of = np.repeat(np.arange(len(self.texts)), self.counts)
        length = self.end - start
        one, two = (hash_spans(buf, start, length, seed) for seed in (0, 1))
        a, b = one, two
        for place in range(1, window):
            a, b = chain(a[:-1], one[place:]), chain(b[:-1], two[place:])
        self.at = np.flatnonzero(of[: len(a)] == of[window - 1 :])
        a, b = a[self.at], b[self.at]
        key = ids[of[self.at]]
        line = self.at - self.first[of[self.at]]
        # The first window of each kind in this chunk speaks for the others.
        order = np.lexsort((line, key, b, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        leaders = order[new]
        self.records = np.zeros(len(leaders), _RECORD)
        for name, values in (("one", a), ("two", b), ("id", key), ("line", line)):
            self.records[name] = values[leaders]
        self.kind = kind
        lead = self.records[kind]
        self.later = (key > lead["id"]) | ((key == lead["id"]) & (line > lead["line"]))


def _decide(kind: int, records: np.ndarray, message: np.ndarray) -> np.ndarray:
    """1 where the same window occurs earlier in another chunk."""
    order, group = groups(records["one"], records["two"])
    first_id = least_of(order, group, records["id"])
    line = np.where(records["id"] == first_id, records["line"], np.iinfo(np.int64).max)
    first_line = least_of(order, group, line)
    return (records["id"] > first_id) | (records["line"] > first_line)


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_removed``, ``kept`` text."""
    chunks, size = chunked(docs, id_col, text_col)
    buckets = buckets_for(size, size // 2)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = Asked(0, _Lines(pdf, window).records, "one", buckets)
        return table(asked.messages(int(pdf["chunk"].iloc[0])))

    def finish(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=["id", "n_lines", "n_removed", "kept"])
        lines = _Lines(pdf, window)
        elsewhere = Asked(0, lines.records, "one", buckets).answers(replies) > 0
        gone = lines.at[lines.later | elsewhere[lines.kind]]
        marks = np.zeros(lines.first[-1] + 1, np.int64)
        np.add.at(marks, gone, 1)
        np.add.at(marks, gone + window, -1)
        covered = np.cumsum(marks)[:-1] > 0
        removed = np.add.reduceat(covered, lines.first[:-1])
        kept = []
        for text, begin, end, n in zip(lines.texts, lines.first[:-1], lines.first[1:], removed, strict=True):
            if n:
                stays = ~covered[begin:end]
                text = b"\n".join(p for p, s in zip(text.split(b"\n"), stays, strict=True) if s)
            kept.append(text)
        return pd.DataFrame(
            {"id": pd.array(lines.given, dtype="Int64"), "n_lines": lines.counts,
             "n_removed": removed, "kept": kept}
        )

    replies = answered(chunks.groupBy("chunk").applyInPandas(ask, TABLE), {0: _RECORD}, _decide)
    done = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(
        finish, "id long, n_lines long, n_removed long, kept binary"
    )
    return done.select(
        F.col("id").alias(id_col), "n_lines", "n_removed", F.col("kept").cast("string").alias("kept")
    )
