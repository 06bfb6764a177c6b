"""Document fingerprints from Lempel-Ziv phrases.

Every text is parsed into dictionary phrases: each phrase is the shortest run of symbols
not yet in the dictionary, which it then enters. Symbols are words, and the characters
of words over ``LONG`` bytes, so that text without blanks is parsed too. The set of
phrase hashes is what a compressor would have learned from the text; its ``SIGNATURE``
minima under universal hash functions are the fingerprint, and the share of equal minima
of two fingerprints estimates the likeness of their phrase sets.

``compare`` sets each text beside its next neighbour in descending order of id. The
order is global, yet no task holds more than its part: split points of the ids divide
the rows, and every part also gets a copy of the first row of the next one.

Defined results: null is the empty text; texts without symbols have an empty set, like
each other (1) and unlike any other (0); equal texts have equal fingerprints; null ids
come last and equal ids in order of their text; a single row is its own neighbour; no
rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.arrays import batches, blend, distinct, hash_words, split_words
from quillstat.llm.tables import checked_broadcast, cut, parts_for, with_library

SIGNATURE = 128
LONG = 24
PART_BYTES = 4_000_000
SPLIT_SAMPLE = 20
# Texts are handled in lots of about so many bytes.
LOT = 1_000_000

_RNG = np.random.default_rng(78)
_FACTOR = _RNG.integers(0, 2**32, SIGNATURE, np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 2**32, SIGNATURE, np.uint32)


def phrases(symbols: Iterable[int]) -> set[int]:
    """The hashes of the phrases that the symbols are parsed into."""
    seen: set[int] = set()
    phrase = 0
    for symbol in symbols:
        phrase = hash((phrase, symbol))
        if phrase not in seen:
            seen.add(phrase)
            phrase = 0
    return seen


def _symbols(texts: list[bytes]) -> Iterator[list[int]]:
    laid = split_words(texts)
    hashes = hash_words(laid)
    long = laid.length > LONG
    for begin, end in zip(laid.first[:-1], laid.first[1:], strict=True):
        own = hashes[begin:end].tolist()
        if not long[begin:end].any():
            yield own
            continue
        mixed: list[int] = []
        for i in range(begin, end):
            if long[i]:
                word = laid.buf[laid.start[i] : laid.start[i] + laid.length[i]].tobytes()
                mixed += map(ord, word.decode(errors="replace"))
            else:
                mixed.append(own[i - begin])
        yield mixed


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One row of ``SIGNATURE`` 16-bit values for each text."""
    found = np.full((len(texts), SIGNATURE), 0xFFFF, np.uint16)
    row = 0
    for lot in batches([len(t) for t in texts], LOT):
        for symbols in _symbols(texts[lot]):
            seen = phrases(symbols)
            items = blend(np.fromiter(seen, np.int64, len(seen)).view(np.uint64))
            folded = (items >> np.uint64(32)).astype(np.uint32)
            least = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
            for at in range(0, len(folded), 2048):
                part = folded[None, at : at + 2048] * _FACTOR[:, None] + _SHIFT[:, None]
                least = np.minimum(least, part.min(axis=1))
            found[row] = (least & np.uint32(0xFFFF)).astype(np.uint16)
            row += 1
    return found


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: list[tuple], known: np.ndarray | None) -> tuple[pd.DataFrame, np.ndarray]:
    """Results of all rows but the last, each beside the row after it, and the last's fingerprint.

    ``known`` is the fingerprint of the first row, if it has been made before.
    """
    texts = [text for _, text, _ in rows]
    own = fingerprints([t.encode() for t in (texts if known is None else texts[1:])])
    if known is not None:
        own = np.concatenate([known[None], own])
    pairs = [i for i, row in enumerate(rows[:-1]) if not row[2]]
    changed = [edited(texts[i], texts[i + 1]).encode() for i in pairs]
    other = fingerprints(changed)
    mine, after = own[pairs], own[[i + 1 for i in pairs]]
    frame = pd.DataFrame(
        {
            "id": pd.Series([rows[i][0] for i in pairs], dtype=object),
            "n_chars": [len(texts[i]) for i in pairs],
            "edited_sha256": [sha256(t).hexdigest() for t in changed],
            "fingerprint": [r.astype(">u2").tobytes().hex() for r in mine],
            "edited_fingerprint": [r.astype(">u2").tobytes().hex() for r in other],
            "near_edited": (mine == other).mean(axis=1) if pairs else [],
            "near_next": (mine == after).mean(axis=1) if pairs else [],
        }
    )
    return frame, own[-1]


def _walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come in order, and after each part the first row of the next one."""
    last, known = [], None
    for pdf in parts:
        for lot in batches([4 * len(t) for t in pdf["text"]], 8 * LOT):
            own = pdf.iloc[lot]
            rows = last + list(zip(own["id"], own["text"], own["after"], strict=True))
            frame, known = _compared(rows, known)
            last = rows[-1:]
            if len(frame):
                yield frame


def _in_parts(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows with their ``part``; parts follow each other in descending order of id.

    There are no more parts than shuffle partitions, and split points come from
    ``SPLIT_SAMPLE`` sampled ids for each part. A part is a stream to its task, so its
    size is no matter of memory.
    """
    size, rows = docs.agg(F.sum(F.octet_length("text") + 64), F.count("id")).first()
    wished = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(parts_for(size, PART_BYTES), wished)
    if not rows or parts == 1:
        return docs.withColumn("part", F.lit(0)), 1
    share = min(1.0, SPLIT_SAMPLE * parts / rows)
    known = docs.select("id").filter(F.col("id").isNotNull())
    found = [i for (i,) in known.sample(share, seed=1).collect()]
    sampled = np.sort(np.array(found, np.int64))
    places = [len(sampled) * k // parts for k in range(1, parts)] if len(sampled) else []
    splits = distinct(sampled[places].astype(np.int64))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        missing = ids.isna().to_numpy()
        # As text, since pandas would turn numbers with nulls into floats.
        at = len(splits) - np.searchsorted(splits, ids.fillna("0").astype("int64"), "right")
        return pd.Series(np.where(missing, len(splits) + 1, at))

    return docs.withColumn("part", part_of(F.col("id").cast("string"))), parts


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited_sha256``, both fingerprints and likenesses."""
    with_library(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows, parts = _in_parts(rows)
    # The first row of each part: the largest id, and the least text of that id.
    tops = cut(rows.groupBy("part").agg(F.max("id").alias("top")), "lempelziv-tops")
    in_order = Window.orderBy("part")
    before = F.coalesce(F.lag("part").over(in_order), F.max("part").over(Window.partitionBy()))
    wanted = tops.select(F.col("part").alias("p"), "top", before.alias("before"))  # a row per part
    same = (F.col("part") == F.col("p")) & F.col("id").eqNullSafe(F.col("top"))
    heads = (
        rows.join(checked_broadcast(wanted), same)
        .groupBy("before")
        .agg(F.min("text").alias("text"))
        .select(F.lit(None).cast("long").alias("id"), "text", F.col("before").alias("part"))
    )
    walked = (
        rows.withColumn("after", F.lit(False))
        .unionByName(heads.withColumn("after", F.lit(True)))
        .repartition(parts, "part")
        .sortWithinPartitions("part", "after", F.col("id").desc_nulls_last(), "text")
    )
    # pandas would turn a column of numbers with nulls into floats.
    found = walked.select(F.col("id").cast("string").alias("id"), "text", "after").mapInPandas(
        _walk,
        "id string, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
    return found.select(
        F.col("id").cast("long").alias(id_col),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
