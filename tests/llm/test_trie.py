"""The trie of conversation prefixes against dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillstat.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, depth string, n string"


def brute(rows, graft):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, sequence in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if graft else 0
        made[c] = tuple(own.get(c - c % 20, [])[:h] + sequence[h:])
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    kids, leaves, saved = (defaultdict(int) for _ in range(3))
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs) - 1) * words
            leaves[path[:d]] += kids[path] == 0
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(made[c]) == len(path))
        out.append((
            convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), kids[path],
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def found(df, graft):
    return sorted((tuple(r) for r in trie.prefixes(df, graft=graft).collect()), key=repr)


def shared(seed, conversations, first=0):
    """Conversations that begin alike, some of them the same throughout."""
    rng = random.Random(seed)
    rows = []
    for c in range(first, first + conversations):
        for turn in range(rng.choice((1, 2, 3, 6))):
            text = rng.choice(("hello", "hello there", "well  then,\tno"))
            rows.append((c, turn, "user" if turn % 2 else "system", text if turn else "hi"))
    rng.shuffle(rows)
    return rows


def edge_rows():
    return [
        (1, 0, "user", "a b"),
        (1, 1, "", "c"),
        (2, 1, None, "c"),  # null and empty are one
        (2, 0, "user", "a b"),
        (3, None, None, None),  # a null turn comes first
        (3, -5, "user", "a b"),
        (20, 0, "user", "a b"),
        (20, 0, "user", "a b"),  # a repeated row is a turn
        (21, 0, "us", "era b"),  # not the same as "user" and "a b"
        (33, 0, "user", ""),  # its own turns are all replaced
        (34, 7, "user", "x"),
        (43, 0, "user", "only one, and no first of the block"),
        (46, 0, "user", "another"),
        (-19, 0, "user", "a b"),
        (-20, 0, "user", "a b"),
        (None, 0, "user", "a b"),  # no conversation
        (2**40, 0, "user", "word " * 5000),
        (2**40 + 1, 0, "user", "word " * 5000),
        *[(60, i, "user", "again") for i in range(70)],
        *[(61, i, "user", "again") for i in range(67)],
    ]


@pytest.fixture(params=[(16_384, 4096), (4, 3)], ids=["one shard", "many shards"])
def shards(request, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", request.param[0])
    monkeypatch.setattr(trie, "SHARD_CONVERSATIONS", request.param[1])
    monkeypatch.setattr(trie, "TASK_TURNS", request.param[0] * 4)
    monkeypatch.setattr(trie, "ENDS_ROWS", request.param[0] * 4)


# Negative ids keep Spark's remainder, which is negative too, out of the comparison.
@pytest.mark.parametrize("graft", [False, True])
def test_edges(spark, graft):
    rows = [r for r in edge_rows() if not graft or (r[0] or 0) >= 0]
    assert found(table(spark, rows), graft) == brute(rows, graft)
    assert found(table(spark, rows).limit(0), graft) == []


def test_conversations_without_turns(spark):
    """An id whose turns are all replaced by those of a missing conversation stays a member."""
    lonely = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4][:4]
    rows = [(c, 0, "user", "gone") for c in lonely]
    (root,) = found(table(spark, rows), True)
    assert root[:5] == (lonely[0], 0, None, len(lonely), 0)
    assert found(table(spark, rows), True) == brute(rows, True)


@pytest.mark.parametrize("graft", [False, True])
def test_shared_prefixes(spark, shards, graft):
    rows = shared(1, 60) + shared(2, 30, 1000)
    assert found(table(spark, rows), graft) == brute(rows, graft)


def test_a_common_conversation(spark, shards):
    """A conversation that many ids hold, as ends of one node in the order of ids."""
    rows = [(c * 7, t, "user", f"t{t}") for c in range(200) for t in range(3)] + shared(3, 20, 5000)
    assert found(table(spark, rows), False) == brute(rows, False)


def test_many_conversations(spark):
    """More conversations than a batch, all alike, in several shards."""
    df = spark.range(20_000).select(
        F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text")
    )
    root, leaf = found(df, False)
    ends = ",".join(map(str, range(20_000)))
    assert root[:6] == (0, 0, None, 20_000, 1, 1)
    assert leaf == (0, 1, 0, 20_000, 0, 1, 19_999, hashlib.sha256(ends.encode()).hexdigest())


def test_a_long_conversation(spark):
    """Subtree sums along a chain of more than two thousand turns."""
    rows = [(c, t, "user", f"w{t % 5}") for c in (1, 2) for t in range(2100 + c)]
    out = {(r.conv_id, r.depth): r for r in trie.prefixes(table(spark, rows)).collect()}
    assert len(out) == 2103
    assert out[1, 0].saved_tokens == 2101 and out[1, 1000].saved_tokens == 2101 - 999
    assert out[2, 2102].n_convs == 1 and out[1, 0].n_leaves == 1
