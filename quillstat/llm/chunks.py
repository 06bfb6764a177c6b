"""Questions about the whole corpus, asked by chunks of it.

The texts are dealt by hash into chunks of bounded size, and one task at a time works on
a chunk with numpy. What a chunk must know about the others it asks: it sends records,
each at most once per chunk, to buckets chosen by a hash in the record; a bucket sees
equal records of all chunks together and returns one byte for each. So a passage in a
third of all rows costs a bucket one record per chunk, not one per row, no task holds
more than a chunk or a bucket, and the texts are shuffled once.

``TABLE`` is the form of all messages: ``target`` is the bucket, or ``-1 - chunk`` for
notes a chunk leaves for its own next step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.tables import parts_for, text_of, with_library

CHUNK_BYTES = 4_000_000
# A chunk sends a message to most buckets. So that messages stay long as the corpus grows,
# chunks and buckets grow too, up to so many times their least size.
GROWTH = 4
CHUNKS = 1000
TABLE = "target long, chunk long, kind int, data binary"
LAST = np.iinfo(np.int64).max
NOTE = -1

Decide = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


def grain(size: int) -> int:
    """Bytes of a chunk for a corpus of this size."""
    return min(max(CHUNK_BYTES, size // CHUNKS), GROWTH * CHUNK_BYTES)


def buckets_for(size: int, asked: int) -> int:
    """Buckets for ``asked`` bytes of records from a corpus of ``size`` bytes."""
    return parts_for(asked, 2 * grain(size))


def chunked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The texts with their ``chunk``, and the bytes of all. Null ids come last.

    The partition of the input takes part in the choice, so rows that repeat id and text all
    over the table spread; those of one input partition stay together. It does not change
    when a task is run again.
    """
    with_library(docs.sparkSession)
    text = text_of(text_col)
    size = docs.select(F.sum(F.octet_length(text) + F.lit(64)).alias("n")).first()["n"] or 0
    # pandas would turn a column of numbers with nulls into floats.
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("id"), text.alias("text"))
    chunk = F.pmod(F.xxhash64("id", "text", F.spark_partition_id()), F.lit(parts_for(size, grain(size))))
    return rows.withColumn("chunk", chunk), size


def ordered(pdf: pd.DataFrame) -> tuple[list, np.ndarray, list[bytes]]:
    """Ids as given, ids to compare, and texts, in an order that every step repeats."""
    ids = [LAST if i is None else int(i) for i in pdf["id"]]
    rows = sorted(zip(ids, pdf["text"], pdf["id"], strict=True), key=lambda row: row[:2])
    given = [None if i is None else int(i) for _, _, i in rows]
    return given, np.array([i for i, _, _ in rows], np.int64), [text for _, text, _ in rows]


class Asked:
    """Records of one kind that a chunk asks about.

    They are sent by bucket; ``sent`` is the place of each record among those sent.
    """

    def __init__(self, kind: int, records: np.ndarray, by: str, buckets: int) -> None:
        self.kind, self.records = kind, records
        self.bucket = (records[by] % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(self.bucket, kind="stable")
        self.sent = np.empty(len(records), np.int64)
        self.sent[self.order] = np.arange(len(records))

    def messages(self, chunk: int) -> list[tuple]:
        bucket = self.bucket[self.order]
        edges = np.flatnonzero(np.diff(bucket)) + 1
        pieces = np.split(self.records[self.order], edges)
        starts = np.concatenate([[0], edges]).astype(np.int64) if len(bucket) else []
        return [
            (int(bucket[at]), chunk, self.kind, piece.tobytes())
            for at, piece in zip(starts, pieces, strict=False)
        ]

    def answers(self, replies: pd.DataFrame) -> np.ndarray:
        """One byte per record, in the order of ``records``."""
        return as_sent(replies, self.kind)[self.sent, 0]


def as_sent(replies: pd.DataFrame, kind: int, width: int = 1) -> np.ndarray:
    """The replies of a kind, ``width`` bytes for each record, in the order they were sent."""
    own = replies[replies["kind"] == kind].sort_values("target")
    return np.frombuffer(b"".join(own["data"]), np.uint8).reshape(-1, width)


def table(rows: Iterable[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["target", "chunk", "kind", "data"])


def answered(messages: DataFrame, dtypes: dict[int, np.dtype], decide: Decide) -> DataFrame:
    """Replies to all messages; notes come back as they are.

    ``decide`` gets a kind, all its records in the bucket and the number of the message
    that each came in, and returns a byte for each, or as many for each.
    """

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["target"].iloc[0] < 0:
            return pdf
        out = []
        for kind, own in pdf.groupby("kind"):
            own = own.sort_values("chunk")
            parts = [np.frombuffer(b, dtypes[kind]) for b in own["data"]]
            sizes = np.array([len(p) for p in parts])
            codes = decide(kind, np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes))
            ends = np.cumsum(sizes)
            for target, chunk, end, n in zip(own["target"], own["chunk"], ends, sizes, strict=True):
                out.append((target, chunk, kind, codes[end - n : end].astype(np.uint8).tobytes()))
        return table(out)

    return messages.groupBy("target").applyInPandas(answer, TABLE)


def groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal rows together, and the group number along it."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for column in columns:
        along = column[order]
        new[1:] |= along[1:] != along[:-1]
    return order, np.cumsum(new)


def least_of(order: np.ndarray, group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each row the least value in its group."""
    if not len(order):
        return values
    first = np.flatnonzero(np.diff(group, prepend=-1))
    out = np.empty_like(values)
    out[order] = np.minimum.reduceat(values[order], first)[group]
    return out
