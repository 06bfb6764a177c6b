"""Substring dedup over bytes by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else, in
another document or the same, goes.

A hash rolled over eight bytes triggers about every sixteenth place and so cuts the
texts into phrases that depend on their content alone. A string of ``LENGTH`` bytes
holds some triggers; the one with the least hash is its anchor, so equal strings
have equal anchors at equal offsets. Then:

1. Dictionary. The half of a string on one side of its anchor is a phrase of the
   dictionary. Chunks of the corpus ask which phrases occur more than once.
2. Parse. Around each anchor whose phrase does, the text is a suffix of one phrase
   followed by others. These contexts meet by phrase, and sorting the strings in
   them by hash, anchor offset by anchor offset, gives the same neighbours as a suffix
   array of the corpus would for prefixes of ``LENGTH``: equal strings lie side by side.
3. Each chunk learns which offsets of its contexts are repeated, marks their bytes,
   merges the marks into spans and cuts them out.

A phrase that occurs more than ``hot`` times is not gathered: its strings are sent
one by one, each once per chunk, and spread by their own hash. Strings without a trigger
(they have short periods) take that way from the start.

The suffix array is never laid out as one file: equal strings of one length only need
to be neighbours, and a global order of all suffixes would cost several times the input.

Defined results: null and empty texts have no bytes; a text shorter than ``LENGTH``
stays whole; removal may cut a character in two, so the kept text is bytes; rows that
repeat an id, or id and text, are documents of their own; no rows give no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.arrays import blend, distinct, hash_spans
from quillstat.llm.chunks import (
    NOTE, TABLE, Asked, answered, as_sent, buckets_for, chunked, groups, ordered, table,
)
from quillstat.llm.recompression import least_name

LENGTH = 200
TRIGGER = 8
EVERY = 16
HOT = 4096
_PHRASE, _CONTEXT, _PLACES = range(3)
_SEEN = np.dtype([("key", "<u8"), ("times", "<u2")])
_PLACE = np.dtype([("start", "<i8"), ("from", "<i2"), ("to", "<i2"), ("record", "<i4")])
_MOST = np.iinfo(np.uint16).max


def _context(length: int) -> np.dtype:
    """A context: the bytes around an anchor, and the offsets of the strings asked about."""
    return np.dtype(
        [("key", "<u8"), ("from", "<i2"), ("to", "<i2"), ("times", "<u2"), ("bytes", "u1", 2 * length - 1)]
    )


class _Chunk:
    """The strings of a chunk, as runs of starts that share an anchor.

    ``begin`` and ``end`` bound the starts of a run, ``anchor`` is their trigger and
    ``key`` the phrase that all of them hold on one side of it. A string without a
    trigger is a run of its own, its own anchor and its own key.
    """

    def __init__(self, pdf: pd.DataFrame, length: int) -> None:
        self.given, _, self.texts = ordered(pdf)
        self.length = length
        raw = b"".join(self.texts)
        self.size = len(raw)
        self.buf = np.frombuffer(raw + bytes(TRIGGER), np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts], dtype=np.int64)
        self.begins = self.ends - np.array([len(t) for t in self.texts], np.int64)
        self._triggers()
        self._runs()

    def _triggers(self) -> None:
        eight = np.ndarray((self.size,), "<u8", self.buf, strides=(1,))
        parts = []
        for at in range(0, self.size, 1 << 20):
            rolled = blend(eight[at : at + (1 << 20)])
            parts.append(np.flatnonzero(rolled < np.uint64(2**64 // EVERY)) + at)
        self.trigger = np.concatenate([np.zeros(0, np.int64), *parts])
        self.name = blend(blend(eight[self.trigger]))

    def _runs(self) -> None:
        # All strings of a document start in [begins, last).
        first = self.begins[self.ends - self.begins >= self.length]
        last = self.ends[self.ends - self.begins >= self.length] - self.length + 1
        reach = self.length - TRIGGER
        # The triggers inside a string change only where one comes or goes.
        edges = distinct(np.concatenate([first, last, self.trigger + 1, self.trigger - reach]))
        edges = edges[(edges >= 0) & (edges <= self.size)]
        inside = np.searchsorted(first, edges, "right") > np.searchsorted(last, edges, "right")
        begin = edges[inside]
        end = np.append(edges[1:], self.size)[inside]
        low = np.searchsorted(self.trigger, begin)
        high = np.searchsorted(self.trigger, begin + reach, "right")
        some = low < high
        anchor = self.trigger[least_name(self.name, low[some], high[some])]
        begin_, end_ = begin[some], end[some]
        # Neighbouring runs with one anchor are one; the middle divides the sides.
        half = self.length // 2
        middle = anchor - half
        pieces = [
            (begin_, np.minimum(end_, middle), anchor, 0),
            (np.maximum(begin_, middle), end_, anchor, 1),
        ]
        bare = np.repeat(begin[~some], (end - begin)[~some])
        shift = np.arange(len(bare)) - np.repeat(
            np.cumsum((end - begin)[~some]) - (end - begin)[~some], (end - begin)[~some]
        )
        bare = bare + shift
        pieces.append((bare, bare + 1, bare, 2))
        columns = []
        for b, e, a, side in pieces:
            real = b < e
            columns.append((b[real], e[real], a[real], np.full(int(real.sum()), side)))
        begin, end, anchor, side = (np.concatenate(c) for c in zip(*columns, strict=True))
        order = np.argsort(begin)
        begin, end, anchor, side = begin[order], end[order], anchor[order], side[order]
        new = np.ones(len(begin), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (side[1:] != side[:-1]) | (begin[1:] != end[:-1])
        at = np.flatnonzero(new)
        self.begin, self.anchor, self.side = begin[at], anchor[at], side[at]
        self.end = end[np.append(at[1:], len(end)) - 1] if len(end) else end
        # Half a length up to the anchor's trigger, or from the anchor on, or all of it.
        start = np.where(self.side == 0, self.anchor - half + TRIGGER, self.anchor)
        span = np.where(self.side == 2, self.length, half)
        self.key = blend(hash_spans(self.buf, start, span) + self.side.astype(np.uint64))

    def contexts(self, runs: np.ndarray) -> np.ndarray:
        """The bytes around each run's anchor; what its strings do not reach is zero."""
        length = self.length
        out = np.zeros(len(runs), _context(length))
        out["key"] = self.key[runs]
        anchor, begin, end = self.anchor[runs], self.begin[runs], self.end[runs]
        # Offset of a string: how far its start lies before the anchor.
        out["from"], out["to"] = anchor - end + 1, anchor - begin
        out["times"] = 1
        place = np.arange(2 * length - 1) - (length - 1)
        for at in range(0, len(runs), 4096):
            part = slice(at, at + 4096)
            where = anchor[part, None] + place
            known = (where >= begin[part, None]) & (where < (end[part] + length - 1)[:, None])
            out["bytes"][part] = np.where(known, self.buf[np.where(known, where, 0)], 0)
        return out

    def asked(self, buckets: int) -> tuple[Asked, np.ndarray]:
        """The phrases of the chunk with the number of their runs, and the phrase of each run."""
        key, phrase, times = np.unique(self.key, return_inverse=True, return_counts=True)
        records = np.zeros(len(key), _SEEN)
        records["key"], records["times"] = key, np.minimum(times, _MOST)
        return Asked(_PHRASE, records, "key", buckets), phrase

    def ask_contexts(self, replies: pd.DataFrame, buckets: int) -> tuple[Asked, np.ndarray]:
        """The contexts of repeated phrases, and for each run that has one its number.

        Contexts of equal bytes are sent once; runs of single strings follow the others.
        """
        asked, phrase = self.asked(buckets)
        code = asked.answers(replies)[phrase]
        whole = np.flatnonzero((code == 1) & (self.side < 2))
        single = np.flatnonzero((code == 2) | ((code == 1) & (self.side == 2)))
        sent = self.contexts(whole)
        # Hot phrases: every string becomes a context of its own, with its own key.
        count = self.end[single] - self.begin[single]
        run = np.repeat(single, count)
        start = self.begin[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        key = blend(hash_spans(self.buf, start, np.full(len(start), self.length), 1))
        key, first, kind, times = np.unique(
            key, return_index=True, return_inverse=True, return_counts=True
        )
        alone = np.zeros(len(key), _context(self.length))
        alone["key"], alone["times"] = key, np.minimum(times, _MOST)
        place = np.arange(self.length)
        for at in range(0, len(key), 4096):
            part = slice(at, at + 4096)
            where = start[first[part]][:, None] + place
            alone["bytes"][part, self.length - 1 :] = self.buf[where]
        # Contexts that agree in key, offsets and bytes are one, with the sum of their times.
        prints = [_prints(sent["bytes"], seed) for seed in (0, 1)]
        order, group = groups(sent["key"], sent["from"], sent["to"], *prints)
        same = np.empty(len(order), np.int64)
        same[order] = group
        distinct = sent[order[np.flatnonzero(np.diff(group, prepend=-1))]]
        distinct["times"] = np.minimum(np.bincount(same, minlength=len(distinct)), _MOST)
        places = np.zeros(len(whole) + len(run), _PLACE)
        places["start"][: len(whole)] = self.anchor[whole]
        places["from"][: len(whole)], places["to"][: len(whole)] = sent["from"], sent["to"]
        asked = Asked(_CONTEXT, np.concatenate([distinct, alone]), "key", buckets)
        places["record"][: len(whole)] = asked.sent[same]
        places["start"][len(whole) :] = start
        places["record"][len(whole) :] = asked.sent[kind + len(distinct)]
        return asked, places


def _prints(rows: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each row of bytes."""
    flat = np.concatenate([np.ascontiguousarray(rows).ravel(), np.zeros(TRIGGER, np.uint8)])
    width = rows.shape[1]
    return hash_spans(flat, np.arange(len(rows)) * width, np.full(len(rows), width), seed)


_BYTE = [blend(np.arange(256, dtype=np.uint64) + np.uint64(1000 * s + 1)) for s in (1, 2)]
_BASE = (np.uint64(0x9E6D62D06F6A9A9B), np.uint64(0xC2B2AE3D27D4EB4F))


def _string_hashes(contexts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For every string of every context: context, offset and two polynomial hashes."""
    rows = contexts["bytes"]
    found = []
    for values, base in zip(_BYTE, _BASE, strict=True):
        prefix = np.zeros((rows.shape[1] + 1, len(rows)), np.uint64)
        power = np.uint64(1)
        for column in range(rows.shape[1]):
            prefix[column + 1] = prefix[column] * base + values[rows[:, column]]
            if column < length:
                power = np.uint64(int(power) * int(base) % 2**64)
        # The string at offset o starts o places before the anchor.
        begin = np.arange(length - 1, -1, -1)
        found.append(prefix[begin + length] - prefix[begin] * power)
    offset = np.arange(length)[:, None]
    wanted = (offset >= contexts["from"]) & (offset <= contexts["to"])
    offsets, context = np.nonzero(wanted)
    return context, offsets, found[0][wanted], found[1][wanted]


def _decide(length: int, hot: int):
    """For phrases 0 once, 1 repeated, 2 hot; for contexts their repeated offsets as bits."""

    def decide(kind: int, records: np.ndarray, message: np.ndarray) -> np.ndarray:
        if kind == _CONTEXT:
            return _repeated(records, length)
        order, group = groups(records["key"])
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        times = np.add.reduceat(records["times"][order].astype(np.int64), starts)[group]
        code = np.empty(len(records), np.uint8)
        code[order] = np.where(times > hot, 2, np.where(times > 1, 1, 0))
        return code

    return decide


def _repeated(records: np.ndarray, length: int) -> np.ndarray:
    """For each context which of its offsets are of repeated strings, one bit each."""
    bits = np.zeros((len(records), length), bool)
    # Contexts of one phrase, or of one string, are neighbours; lots end between them.
    order = np.argsort(records["key"], kind="stable")
    key = records["key"][order]
    edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    at = 0
    while at < len(edges) - 1:
        stop = max(at + 1, np.searchsorted(edges, edges[at] + 4096, "right") - 1)
        rows = order[edges[at] : edges[stop]]
        context, offset, one, two = _string_hashes(records[rows], length)
        line, group = groups(offset, one, two)
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        times = records["times"][rows].astype(np.int64)[context[line]]
        many = np.add.reduceat(times, starts)[group] > 1 if len(line) else np.zeros(0, bool)
        bits[rows[context[line[many]]], offset[line[many]]] = True
        at = stop
    return np.packbits(bits, axis=1)


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` bytes."""
    chunks, size = chunked(docs, id_col, text_col)
    buckets = buckets_for(size, size)
    width = -(-length // 8)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        asked, _ = _Chunk(pdf, length).asked(buckets)
        return table(asked.messages(int(pdf["chunk"].iloc[0])))

    def ask_contexts(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return table([])
        number = int(pdf["chunk"].iloc[0])
        asked, places = _Chunk(pdf, length).ask_contexts(replies, buckets)
        note = (NOTE - number, number, _PLACES, places.tobytes())
        return table([*asked.messages(number), note])

    def finish(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=["id", "n_bytes", "n_removed", "n_spans", "kept"])
        given, _, texts = ordered(pdf)
        note = dict(zip(replies["kind"], replies["data"], strict=True))
        places = np.frombuffer(note[_PLACES], _PLACE)
        answer = as_sent(replies, _CONTEXT, width)
        sizes = np.array([len(t) for t in texts], np.int64)
        total = int(sizes.sum())
        marks = np.zeros(total + 1, np.int64)
        for at in range(0, len(places), 8192):
            part = places[at : at + 8192]
            bits = np.unpackbits(answer[part["record"]], axis=1, count=length)
            row, offset = np.nonzero(bits)
            start = part["start"][row] - offset
            np.add.at(marks, start, 1)
            np.add.at(marks, start + length, -1)
        gone = np.cumsum(marks)[:-1] > 0
        ends = np.cumsum(sizes)
        removed, spans, kept = [], [], []
        for text, end, n in zip(texts, ends, sizes, strict=True):
            own = gone[end - n : end]
            removed.append(int(own.sum()))
            if removed[-1]:
                spans.append(int(own[0]) + int((own[1:] & ~own[:-1]).sum()))
                text = np.frombuffer(text, np.uint8)[~own].tobytes()
            else:
                spans.append(0)
            kept.append(text)
        return pd.DataFrame(
            {"id": pd.array(given, dtype="Int64"), "n_bytes": sizes, "n_removed": removed,
             "n_spans": spans, "kept": kept}
        )

    decide = _decide(length, hot)
    first = chunks.groupBy("chunk").applyInPandas(ask, TABLE)
    replies = answered(first, {_PHRASE: _SEEN}, decide)
    second = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(ask_contexts, TABLE)
    answers = answered(second, {_CONTEXT: _context(length)}, decide)
    done = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        finish, "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return done.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
