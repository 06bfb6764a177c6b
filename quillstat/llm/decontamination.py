"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts and test items are compared as words without case and ASCII punctuation; letters of
scripts written without blanks are words of their own. Every pair of adjacent words of an
item is counted in the whole corpus, and the rarest that do occur are its seeds. Where
enough seeds of an item lie together, the words around them are aligned with the item: equal
words score 1, unequal and skipped words -1. The best local score over the item's
length, from 0 to 1, tells copies, edited and partial ones included, from chance.

How many seeds are enough loses nothing. An alignment of m equal words with a score of s has
m - s words that do not match, so its equal words lie in at most m - s + 1 stretches and
hold at least s - 1 pairs. Of the n pairs of an item that occur at all, any n - (s - 1) + h
therefore include h that every such alignment holds. The rarest are taken, so frequent pairs
make no passages to align; a copy that broke rare pairs still has the others.

A passage is skipped without alignment only if it holds too few of the seeds, or of the
item's words, to reach ``min_score``. Documents stay where they are: items come to them, in
blocks of at most ``BLOCK_BYTES``, so what is sent to the tasks is bounded however many
items there are.

Defined results: null texts and texts without words match nothing, and neither do items
that are null or have no words; an item of one or two words is found where it stands as it
is; equal items match alike; rows that
repeat an id are documents of their own; no documents or no items give no pairs. Extra
columns are ignored by ``find`` and kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.arrays import Texts, batches, chain, hash_words, split_words
from quillstat.llm.tables import parts_for, small_batches, with_library

NGRAM = 2
MIN_SCORE = 0.5
# Seeds of an item that a passage must hold, if every alignment does.
HITS = 3
BLOCK_BYTES = 16_000_000
# Texts are handled in lots of about so many characters.
LOT = 1_000_000
_BITS = 22

# Thai, Lao, Burmese, Khmer, kana and Han: scripts without blanks.
_UNSPACED = (
    (0x0E00, 0x0EFF),
    (0x1000, 0x109F),
    (0x1780, 0x17FF),
    (0x3040, 0x30FF),
    (0x31F0, 0x31FF),
    (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F),
    (0x20000, 0x3FFFF),
)


class _Words(dict):
    """What stands for each character, by its code, when texts are split into words."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if code < 128 and not char.isalnum():
            char = " "
        elif any(low <= code <= high for low, high in _UNSPACED):
            char = f" {char} "
        self[code] = char
        return char


_WORDS = _Words()
FOUND = "array<struct<item:string,score:double,begin:int,end:int>>"


def _laid(texts: list[str]) -> Texts:
    """Words without case and punctuation, and single letters of scripts without blanks."""
    lowered = (t.lower().translate(_WORDS) for t in texts)
    return split_words([t.encode() for t in lowered])


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    grams = words
    for place in range(1, size):
        grams = chain(grams[:-1], words[place:])
    return grams


@dataclass
class Lookup:
    """Sorted keys, and a table of their first bits that rules most others out."""

    keys: np.ndarray

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _BITS)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of values that are keys, and the numbers of the keys."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.seen[values >> np.uint64(64 - _BITS)])
        number = np.minimum(np.searchsorted(self.keys, values[maybe]), len(self.keys) - 1)
        equal = self.keys[number] == values[maybe]
        return maybe[equal], number[equal]


@dataclass
class Grams:
    """N-grams of one size that items hold, and the places they hold them at."""

    size: int
    lookup: Lookup
    first: np.ndarray  # of the entries of each n-gram
    item: np.ndarray  # of each entry
    place: np.ndarray

    @classmethod
    def of(cls, size: int, key: np.ndarray, item: np.ndarray, place: np.ndarray) -> Grams:
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        return cls(size, Lookup(keys), np.append(first, len(key)), item[order], place[order])

    def found(self, hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where texts hold an n-gram, and its number."""
        if len(hashes) < self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, number = self.lookup.find(_grams(hashes, self.size))
        inside = of[at] == of[at + self.size - 1]
        return at[inside], number[inside]

    def hits(self, hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, item, the item's place that was hit, and where the item would begin."""
        at, number = self.found(hashes, of)
        times = self.first[number + 1] - self.first[number]
        ends = np.cumsum(times)
        entry = np.repeat(self.first[number] - ends + times, times) + np.arange(times.sum())
        at = np.repeat(at, times)
        return of[at], self.item[entry], self.place[entry], at - self.place[entry]


@dataclass
class Items:
    """Test items of a block: their words, the score and the seeds a copy has at least."""

    words: list[np.ndarray]
    least: np.ndarray
    pairs: Grams
    singles: Grams  # of items of one word
    need: np.ndarray | None = None

    @classmethod
    def of(cls, texts: list[str], min_score: float) -> Items:
        laid = _laid(texts)
        hashes = hash_words(laid)
        words = np.split(hashes, laid.first[1:-1]) if texts else []
        lengths = np.array([len(w) for w in words], np.int64)
        # One or two words are found whole or not at all.
        least = np.where(lengths > NGRAM, min_score * lengths, lengths)

        def grams(size: int, chosen: np.ndarray) -> Grams:
            own = [_grams(w, size) if c else w[:0] for w, c in zip(words, chosen, strict=True)]
            sizes = np.array([len(g) for g in own], np.int64)
            key = np.concatenate([np.zeros(0, np.uint64), *own])
            place = np.concatenate([np.zeros(0, np.int64), *[np.arange(n) for n in sizes]])
            return Grams.of(size, key, np.repeat(np.arange(len(own)), sizes), place)

        return cls(words, least, grams(NGRAM, lengths >= NGRAM), grams(1, lengths == 1))

    def seeds(self, counts: np.ndarray) -> Items:
        """The rarest pairs of each item, as many as every copy must hold some of."""
        number = np.repeat(np.arange(len(self.pairs.first) - 1), np.diff(self.pairs.first))
        times = counts[number]
        order = np.lexsort((self.pairs.place, times, self.pairs.item))
        order = order[times[order] > 0]
        item = self.pairs.item[order]
        occur = np.bincount(item, minlength=len(self.words))
        # Pairs in every alignment that reaches the score; the whole item if it is short.
        held = np.maximum(np.ceil(self.least - 1e-9).astype(np.int64) - 1, 1)
        need = np.minimum(held, HITS)
        wanted = np.where(occur >= held, occur - held + need, 0)
        rank = np.arange(len(order)) - np.searchsorted(item, item)
        chosen = order[rank < wanted[item]]
        keys = self.pairs.lookup.keys[number[chosen]]
        pairs = Grams.of(NGRAM, keys, self.pairs.item[chosen], self.pairs.place[chosen])
        return Items(self.words, self.least, pairs, self.singles, need)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """The best local alignment score, and the end of the aligned part of the passage."""
    columns = np.arange(1, len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, 1, -1)
        new = np.maximum(np.maximum(row[:-1] + step, row[1:] - 1), 0)
        # Skipped words of the passage: the best earlier cell, less one for each word.
        new = np.maximum.accumulate(new + columns) - columns
        row[1:] = new
        top = int(new.argmax())
        if new[top] > best:
            best, end = int(new[top]), top + 1
    return best, end


def _passages(laid: Texts, hashes: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, and the least and the largest begin that enough seeds point to."""
    of = laid.of
    both = zip(items.pairs.hits(hashes, of), items.singles.hits(hashes, of), strict=True)
    text, item, place, begin = (np.concatenate(x) for x in both)
    if not len(text):
        return
    order = np.lexsort((begin, item, text))
    text, item, place, begin = text[order], item[order], place[order], begin[order]
    # Seeds of an item that lie in a row belong to one passage.
    length = np.array([len(w) for w in items.words], np.int64)
    new = np.ones(len(order), bool)
    far = begin[1:] - begin[:-1] > length[item[1:]]
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | far
    passage = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(new)) - 1
    hit = np.unique(passage * (length.max() + 1) + place) // (length.max() + 1)
    enough = np.bincount(hit, minlength=len(starts)) >= items.need[item[starts]]
    for first, last in zip(starts[enough], ends[enough], strict=True):
        yield int(text[first]), int(item[first]), int(begin[first]), int(begin[last])


def _matches(laid: Texts, hashes: np.ndarray, items: Items) -> list[list]:
    """Per text the items it holds: number, score, first and last word."""
    found: list[list] = [[] for _ in range(len(laid.first) - 1)]
    best: dict[tuple[int, int], tuple] = {}
    for t, i, first, last in _passages(laid, hashes, items):
        words = items.words[i]
        slack = len(words) // 2 + NGRAM
        low = max(int(laid.first[t]), first - slack)
        high = min(int(laid.first[t + 1]), last + len(words) + slack)
        passage = hashes[low:high]
        wanted = items.least[i]
        if np.isin(words, passage).sum() < wanted:
            continue
        score, end = align(words, passage)
        if score < wanted or score <= best.get((t, i), (0,))[0]:
            continue
        _, back = align(words[::-1], passage[:end][::-1])
        offset = low - int(laid.first[t])
        best[t, i] = (score, score / len(words), offset + end - back, offset + end)
    for (t, i), (_, score, begin, end) in sorted(best.items()):
        found[t].append((i, score, begin, end))
    return found


def _lots(texts: pd.Series) -> Iterator[list[str]]:
    known = [t or "" for t in texts]
    for part in batches([len(t) for t in known], LOT):
        yield known[part]


def _count(docs: DataFrame, text_col: str, grams: Grams) -> np.ndarray:
    """How often each n-gram occurs in the corpus."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(grams.lookup.keys), np.int64)
        for pdf in parts:
            for lot in _lots(pdf["text"]):
                laid = _laid(lot)
                _, number = grams.found(hash_words(laid), laid.of)
                counts += np.bincount(number, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"gram": some, "times": counts[some]})

    rows = (
        docs.select(F.col(text_col).alias("text"))
        .mapInPandas(count, "gram long, times long")
        .groupBy("gram")
        .agg(F.sum("times").alias("times"))
        .toPandas()
    )
    counts = np.zeros(len(grams.lookup.keys), np.int64)
    counts[rows["gram"].to_numpy()] = rows["times"].to_numpy()
    return counts


def _blocks(items: DataFrame, text_col: str) -> Iterator[DataFrame]:
    known = items.filter(F.col(text_col).isNotNull())
    size = known.agg(F.sum(F.octet_length(text_col))).first()[0]
    blocks = parts_for(size, BLOCK_BYTES)
    for block in range(blocks):
        yield known.filter(F.pmod(F.xxhash64(text_col), F.lit(blocks)) == block)


def _search(text: Column, seeds: Items, ids: list[str | None]) -> Column:
    @F.pandas_udf(FOUND)
    def search(texts: pd.Series) -> pd.Series:
        found: list = []
        for lot in _lots(texts):
            laid = _laid(lot)
            found += _matches(laid, hash_words(laid), seeds)
        names = ("item", "score", "begin", "end")
        return pd.Series([[dict(zip(names, (ids[m[0]], *m[1:]), strict=True)) for m in f] for f in found])

    return search(text)


def _searches(
    docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, min_score: float
) -> Iterator[Column]:
    """For each block of items a column of what is found in the text."""
    with_library(docs.sparkSession)
    small_batches(docs.sparkSession)
    for block in _blocks(items, item_text):
        rows = block.select(F.col(item_id).cast("string"), F.col(item_text)).collect()
        rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
        known = Items.of([r[1] for r in rows], min_score)
        seeds = known.seeds(_count(docs, text_col, known.pairs))
        yield _search(F.col(text_col), seeds, [r[0] for r in rows])


def find(
    docs: DataFrame,
    items: DataFrame,
    min_score: float = MIN_SCORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item it holds: both ids, ``score``, ``first_word``, ``end_word``.

    Words count from 0 in the text without case and punctuation; ``end_word`` is excluded.
    """
    kind = items.schema[item_id].dataType
    parts = []
    for column in _searches(docs, items, text_col, item_id, item_text, min_score):
        rows = docs.select(F.col(id_col).alias(id_col), F.explode(column).alias("m"))
        parts.append(
            rows.select(
                id_col,
                F.col("m.item").cast(kind).alias(item_id),
                F.col("m.score").alias("score"),
                F.col("m.begin").alias("first_word"),
                F.col("m.end").alias("end_word"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def remove(
    docs: DataFrame,
    items: DataFrame,
    min_score: float = MIN_SCORE,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no item."""
    for column in _searches(docs, items, text_col, item_id, item_text, min_score):
        found = docs.select(F.struct("*").alias("row"), F.size(column).alias("found"))
        docs = found.filter(F.col("found") == 0).select("row.*")
    return docs
