"""Substring dedup over words by recompression.

Every window of ``WINDOW`` words that also starts in a document with a smaller id goes;
its words are marked, marks are merged, marked words go.

A round of recompression names maximal runs of one symbol, then splits the symbols by a
hash of their names into left and right ones and names each left-right pair. Names are
128-bit hashes of the parts' names, so equal parts have one name in every task, and the
inside of equal passages gets equal symbols whatever surrounds them. Names are used at
two heights:

- High symbols cover passages. Two neighbours after ``ROUNDS`` rounds that also occur as
  neighbours in a smaller document prove all windows inside repeated at once. The first
  document of a window is never settled this way, so settled windows need no further
  question: the first one stands for them.
- Symbols of the first round choose places. Of the symbols that a window alone
  determines, the one with the least name is its anchor, and the seven words on one side
  of the anchor are its key. Only windows whose key occurs in several documents are left,
  and these are compared by a 96-bit hash of all their words.

So equal windows always meet: they have the same anchor, key and hash.

Defined results: null texts have no words; a text shorter than a window stays whole;
rows that repeat an id do not remove each other's words; null ids come after all others;
no rows give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.arrays import blend, chain, hash_words, split_words
from quillstat.llm.chunks import (
    NOTE, TABLE, Asked, answered, as_sent, buckets_for, chunked, groups, least_of, ordered, table,
)

WINDOW = 13
ROUNDS = 10
_HIGH, _KEY, _WINDOW, _KNOWN, _OPEN = range(5)
# Two hashes of 96 bits together: among 10^13 windows two differ unnoticed with a chance of 1 in 1000.
_OCCURS = np.dtype([("one", "<u8"), ("two", "<u4"), ("id", "<i8")])
_SEEN = np.dtype([("one", "<u8"), ("several", "u1")])
_PLACE = np.dtype([("at", "<i4"), ("record", "<i4")])
_RUN = np.uint64(0x5275A3C1)


class Symbols:
    """Symbols of consecutive documents: two names, document, first word, and the span
    of words that determines each symbol wherever they occur."""

    def __init__(self, one, two, of, start, low, high) -> None:
        self.one, self.two, self.of, self.start = one, two, of, start
        self.low, self.high = low, high

    @classmethod
    def of_words(cls, one: np.ndarray, two: np.ndarray, of: np.ndarray) -> Symbols:
        place = np.arange(len(one))
        return cls(one, two, of, place, place, place)

    def _runs(self) -> Symbols:
        new = np.ones(len(self.one), bool)
        new[1:] = (self.one[1:] != self.one[:-1]) | (self.of[1:] != self.of[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(new)) - 1
        length = (last - at + 1).astype(np.uint64)
        one, two = self.one[at], self.two[at]
        some = np.flatnonzero(length > 1)
        one[some] = chain(one[some] ^ _RUN, length[some])
        two[some] = chain(two[some] ^ _RUN, length[some])
        # That a run ends is seen in its neighbours; at a document's edge nothing shows it.
        low = np.where(at > 0, self.low[at - 1], -1)
        after = np.minimum(last + 1, len(new) - 1)
        high = np.where(last + 1 < len(new), self.high[after], self.high[-1] + 1)
        return Symbols(one, two, self.of[at], self.start[at], low, high)

    def _pairs(self, salt: int) -> Symbols:
        right = (blend(self.one ^ np.uint64(0xA24BAED4 * (salt + 1))) >> np.uint64(63)).astype(bool)
        meet = ~right[:-1] & right[1:] & (self.of[1:] == self.of[:-1])
        first = np.flatnonzero(meet)
        one, two = self.one.copy(), self.two.copy()
        one[first] = chain(one[first], one[first + 1])
        two[first] = chain(two[first], two[first + 1])
        # An unpaired symbol depends on the neighbour it was not paired with.
        low, high = self.low.copy(), self.high.copy()
        low[1:] = np.where(right[1:], np.minimum(low[1:], self.low[:-1]), low[1:])
        high[:-1] = np.where(~right[:-1], np.maximum(high[:-1], self.high[1:]), high[:-1])
        low[first], high[first] = self.low[first], self.high[first + 1]
        keep = np.ones(len(one), bool)
        keep[first + 1] = False
        return Symbols(one[keep], two[keep], self.of[keep], self.start[keep], low[keep], high[keep])

    def round(self, salt: int) -> Symbols:
        return self._runs()._pairs(salt) if len(self.one) else self


def least_name(names: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The leftmost place of the least name in each ``[begin, end)``, none of them empty."""
    width = end - begin
    best = np.empty(len(begin), np.int64)
    place, step = np.arange(len(names)), 1
    left = np.ones(len(begin), bool)
    while left.any():
        now = left & (width < 2 * step)
        a, b = place[begin[now]], place[end[now] - step]
        best[now] = np.where(names[a] <= names[b], a, b)
        left &= ~now
        if len(place) > step:
            a, b = place[:-step], place[step:]
            place = np.where(names[a] <= names[b], a, b)
        step *= 2
    return best


def _spread(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any ``[start, end)``."""
    marks = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(marks)[:size] > 0


def _leaders(columns: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row with the least id of each kind, and the kind of each row."""
    order = np.lexsort([ids, *columns[::-1]])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for column in columns:
            new[1:] |= column[order][1:] != column[order][:-1]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def _records(dtype: np.dtype, rows: np.ndarray, **columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), dtype)
    for name, values in columns.items():
        out[name] = values[rows]
    return out


class _Chunk:
    """The words of a chunk, and what it asks about them."""

    def __init__(self, pdf: pd.DataFrame, window: int, buckets: int) -> None:
        _, ids, texts = ordered(pdf)
        laid = split_words(texts)
        self.first, self.window, self.buckets = laid.first, window, buckets
        self.one, self.two = hash_words(laid, 0), hash_words(laid, 1)
        self.of = laid.of
        self.id = ids[self.of]
        words = len(self.of)
        self.starts = np.flatnonzero(self.of[: max(0, words - window + 1)] == self.of[window - 1 :])
        symbols = Symbols.of_words(self.one, self.two, self.of).round(0)
        self.low = symbols
        for salt in range(1, ROUNDS):
            symbols = symbols.round(salt)
        self._ask_high(symbols)
        self._ask_keys(self.low)

    def _ask_high(self, s: Symbols) -> None:
        end = np.append(s.start[1:], len(self.of))
        pair = np.flatnonzero(s.of[:-1] == s.of[1:])
        self.from_, self.to = s.start[pair], end[pair + 1]
        long = self.to - self.from_ >= self.window
        pair, self.from_, self.to = pair[long], self.from_[long], self.to[long]
        one, two = chain(s.one[pair], s.one[pair + 1]), chain(s.two[pair], s.two[pair + 1])
        self.pair_id = self.id[self.from_]
        leaders, self.pair_kind = _leaders([one, two], self.pair_id)
        records = _records(_OCCURS, leaders, one=one, two=two, id=self.pair_id)
        self.high = Asked(_HIGH, records, "one", self.buckets)

    def _ask_keys(self, s: Symbols) -> None:
        at, window = self.starts, self.window
        words = len(self.of)
        before = np.concatenate([[0], np.cumsum(np.bincount(s.low + 1, minlength=words + 1))])
        inside = np.concatenate([[0], np.cumsum(np.bincount(s.high, minlength=words + 1))])
        begin, end = before[at + 1], inside[at + window]
        some = begin < end
        key = np.zeros(len(at), np.uint64)
        if some.any():
            anchor = s.start[least_name(s.one, begin[some], end[some])]
            half = window // 2 + 1
            reach = self.one.copy()
            for place in range(1, half):
                reach = chain(reach[: words - place], self.one[place:])
            # Seven words from the anchor on, or up to it, whichever the window holds.
            right = anchor - at[some] <= window - half
            start = np.where(right, anchor, anchor - half + 1)
            key[some] = blend(reach[start] + right.astype(np.uint64))
        bare = ~some
        if bare.any():
            key[bare] = self._whole(self.one, at[bare])
        self.window_key = key
        text = self.of[at]
        leaders, self.key_kind = _leaders([key], text)
        several = np.zeros(len(leaders), bool)
        np.logical_or.at(several, self.key_kind, text != text[leaders][self.key_kind])
        records = _records(_SEEN, leaders, one=key)
        records["several"] = several
        self.keys = Asked(_KEY, records, "one", self.buckets)

    def _whole(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        name = words[at]
        for place in range(1, self.window):
            name = chain(name, words[at + place])
        return name

    def ask_windows(self, replies: pd.DataFrame) -> tuple[Asked, np.ndarray, np.ndarray]:
        """The question about open windows, the words known to go, and the open places."""
        elsewhere = self.high.answers(replies) > 0
        least = self.high.records["id"][self.pair_kind]
        proven = elsewhere[self.pair_kind] | (self.pair_id > least)
        words = len(self.of)
        gone = _spread(self.from_[proven], self.to[proven], words)
        settled = _spread(self.from_[proven], self.to[proven] - self.window + 1, words)
        shared = self.keys.answers(replies)[self.key_kind] > 0
        at = self.starts[shared & ~settled[self.starts]]
        one, two = self._whole(self.one, at), self._whole(self.two, at)
        leaders, kind = _leaders([one, two], self.id[at])
        records = _records(_OCCURS, leaders, one=one, two=two, id=self.id[at])
        later = self.id[at] > records["id"][kind]
        gone |= _spread(at[later], at[later] + self.window, words)
        places = np.zeros(int((~later).sum()), _PLACE)
        asked = Asked(_WINDOW, records, "one", self.buckets)
        places["at"], places["record"] = at[~later], asked.sent[kind[~later]]
        return asked, gone, places


def _decide(kind: int, records: np.ndarray, message: np.ndarray) -> np.ndarray:
    if kind == _KEY:
        order, group = groups(records["one"])
        none = least_of(order, group, 1 - records["several"].astype(np.int64))
        low = least_of(order, group, message)
        high = -least_of(order, group, -message)
        return (none == 0) | (low < high)
    order, group = groups(records["one"], records["two"])
    return records["id"] > least_of(order, group, records["id"])


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept`` words as text."""
    chunks, size = chunked(docs, id_col, text_col)
    buckets = buckets_for(size, size)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk(pdf, window, buckets)
        number = int(pdf["chunk"].iloc[0])
        return table(chunk.high.messages(number) + chunk.keys.messages(number))

    def ask_windows(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return table([])
        number = int(pdf["chunk"].iloc[0])
        asked, gone, places = _Chunk(pdf, window, buckets).ask_windows(replies)
        notes = [
            (NOTE - number, number, _KNOWN, np.packbits(gone).tobytes()),
            (NOTE - number, number, _OPEN, places.tobytes()),
        ]
        return table(asked.messages(number) + notes)

    def finish(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=["id", "n_words", "n_removed", "kept"])
        given, _, texts = ordered(pdf)
        note = {k: d for k, d in zip(replies["kind"], replies["data"], strict=True) if k != _WINDOW}
        answer = as_sent(replies, _WINDOW)[:, 0]
        places = np.frombuffer(note[_OPEN], _PLACE)
        gone_at = places["at"][answer[places["record"]] > 0].astype(np.int64)
        split = [t.split() for t in texts]
        counts = np.array([len(w) for w in split])
        total = int(counts.sum())
        gone = np.unpackbits(np.frombuffer(note[_KNOWN], np.uint8), count=total).astype(bool)
        gone |= _spread(gone_at, gone_at + window, total)
        ends = np.cumsum(counts)
        removed, kept = [], []
        for words, end, n in zip(split, ends, counts, strict=True):
            stays = ~gone[end - n : end]
            removed.append(int(n - stays.sum()))
            kept.append(b" ".join(compress(words, stays.tolist()) if removed[-1] else words))
        return pd.DataFrame(
            {"id": pd.array(given, dtype="Int64"), "n_words": counts, "n_removed": removed, "kept": kept}
        )

    first = chunks.groupBy("chunk").applyInPandas(ask, TABLE)
    replies = answered(first, {_HIGH: _OCCURS, _KEY: _SEEN}, _decide)
    second = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(ask_windows, TABLE)
    answers = answered(second, {_WINDOW: _OCCURS}, _decide)
    done = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        finish, "id long, n_words long, n_removed long, kept binary"
    )
    return done.select(
        F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").cast("string").alias("kept")
    )
