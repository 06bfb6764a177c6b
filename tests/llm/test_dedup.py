"""The three deduplications by position, against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tables_of_texts import edge_texts, prose, rows

from quillstat.llm import chunks, lines, parsing, recompression
from quillstat.llm.recompression import Symbols, least_name

LAST = 2**63


def order(pair):
    return LAST if pair[0] is None else pair[0]


def brute_windows(pairs, units, window):
    """Units covered by a window that occurs with a smaller id."""
    least = {}
    split = [units(t) for _, t in pairs]
    for pair, own in zip(pairs, split, strict=True):
        for k in range(len(own) - window + 1):
            w = tuple(own[k : k + window])
            least[w] = min(least.get(w, LAST + 1), order(pair))
    out = []
    for pair, own in zip(pairs, split, strict=True):
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if least[tuple(own[k : k + window])] < order(pair):
                gone[k : k + window] = [True] * window
        out.append((pair[0], own, gone))
    return out


def brute_lines(pairs, window=3):
    first = {}
    split = [(t or "").split("\n") for _, t in pairs]
    for pair, own in zip(pairs, split, strict=True):
        for k in range(len(own) - window + 1):
            w = tuple(own[k : k + window])
            first[w] = min(first.get(w, (LAST + 1, 0)), (order(pair), k))
    out = []
    for pair, own in zip(pairs, split, strict=True):
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if first[tuple(own[k : k + window])] < (order(pair), k):
                gone[k : k + window] = [True] * window
        kept = "\n".join(x for x, g in zip(own, gone, strict=True) if not g)
        out.append((pair[0], len(own), sum(gone), kept))
    return out


def brute_bytes(pairs, length):
    count = Counter()
    texts = [(t or "").encode() for _, t in pairs]
    for t in texts:
        count.update(t[k : k + length] for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(pairs, texts, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, kept))
    return out


def test_lines(edges, chunk_size):
    want = sorted(brute_lines(edge_texts()), key=repr)
    assert rows(lines.dedup(edges), "doc_id", "n_lines", "n_removed", "kept") == want
    assert sum(r[2] for r in want) > 0


def test_words(edges, chunk_size):
    import re

    found = brute_windows(edge_texts(), lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or ""), 13)
    want = sorted(
        (
            (i, len(w), sum(g), " ".join(x for x, y in zip(w, g, strict=True) if not y))
            for i, w, g in found
        ),
        key=repr,
    )
    got = recompression.dedup(edges)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("hot", [parsing.HOT, 3])
def test_bytes(edges, chunk_size, hot):
    def digest(found):
        return [(i, n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in found]

    got = parsing.dedup(edges, hot=hot).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got]
    want = brute_bytes(edge_texts(), 200)
    assert sorted(digest(found), key=repr) == sorted(digest(want), key=repr)
    assert sum(r[2] for r in want) > 0


def test_nothing(empty):
    assert lines.dedup(empty).count() == 0
    assert recompression.dedup(empty).count() == 0
    assert parsing.dedup(empty).count() == 0


def test_only_short_texts(table):
    docs = table([(1, None), (2, ""), (3, "a b"), (4, "a b")])
    assert {r.n_removed for r in lines.dedup(docs).collect()} == {0}
    assert {r.n_removed for r in recompression.dedup(docs).collect()} == {0}
    assert {r.n_removed for r in parsing.dedup(docs).collect()} == {0}


def test_symbols_are_determined_by_their_span():
    """Equal words over a symbol's span give the symbol, whatever lies around them."""
    rng = np.random.default_rng(3)
    words = rng.integers(0, 4, 3000).astype(np.uint64)
    symbols = Symbols.of_words(words, words, np.zeros(3000, np.int64)).round(0)
    seen = defaultdict(set)
    end = np.append(symbols.start[1:], 3000)
    for k in range(1, len(symbols.one) - 1):
        low, high = symbols.low[k], symbols.high[k]
        if low >= 0 and high < 3000 and high - low < 12:
            offset = symbols.start[k] - low
            seen[tuple(words[low : high + 1]), offset].add((symbols.one[k], end[k] - symbols.start[k]))
    assert len(seen) > 50
    # A span holds the symbol that starts at this offset, and no other.
    assert all(len(found) == 1 for found in seen.values())


def test_symbols_expand_to_equal_words():
    text = prose(11, 400).split()
    ids = {w: i for i, w in enumerate(dict.fromkeys(text))}
    words = np.array([ids[w] for w in text * 2], np.uint64)
    of = np.repeat([0, 1], len(text))
    symbols = Symbols.of_words(words, words, of)
    for salt in range(6):
        symbols = symbols.round(salt)
        end = np.append(symbols.start[1:], len(words))
        meaning = {}
        for name, begin, stop in zip(symbols.one, symbols.start, end, strict=True):
            assert meaning.setdefault(name, words[begin:stop].tolist()) == words[begin:stop].tolist()


def test_least_name():
    rng = np.random.default_rng(5)
    names = rng.integers(0, 9, 200).astype(np.uint64)
    begin = rng.integers(0, 190, 300)
    end = begin + rng.integers(1, 10, 300)
    want = [b + int(names[b:e].argmin()) for b, e in zip(begin, end, strict=True)]
    assert least_name(names, begin, end).tolist() == want


@pytest.mark.parametrize("operator", ["lines", "words", "bytes"])
def test_a_thousand_copies_of_a_row(table, monkeypatch, operator):
    """Copies of one row, with and without an id, in many chunks and input partitions."""
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 20_000)
    passage = prose(60, 60)
    pairs = [(7, passage)] * 1000 + [(None, passage)] * 1000 + [(3, prose(61, 12) + "\n" + passage)]
    df = table(pairs).repartition(16)
    if operator == "lines":
        got = rows(lines.dedup(df), "doc_id", "n_lines", "n_removed", "kept")
        want = brute_lines(pairs)
    elif operator == "words":
        got = rows(recompression.dedup(df), "doc_id", "n_words", "n_removed")
        want = [(i, len(own), sum(gone)) for i, own, gone in brute_windows(pairs, lambda t: t.split(), 13)]
    else:
        got = rows(parsing.dedup(df), "doc_id", "n_bytes", "n_removed")
        # Every byte of the passage repeats, and none of the words before it.
        want = [(i, len(t), len(passage)) for i, t in pairs]
        assert len(passage) >= 200
    assert got == sorted(want, key=repr)


def test_equal_rows_spread_over_chunks(spark):
    df = spark.range(0, 200_000, 1, 64).selectExpr("CAST(NULL AS BIGINT) AS doc_id", f"'{prose(1, 40)}' AS text")
    spread, size = chunks.chunked(df, "doc_id", "text")
    wanted = -(-size // chunks.CHUNK_BYTES)
    assert wanted > 10
    used = spread.groupBy("chunk").count().collect()
    assert len(used) >= 0.8 * wanted and max(r["count"] for r in used) < 200_000 / 4
