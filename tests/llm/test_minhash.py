"""Near-duplicates and components, against brute force."""

from __future__ import annotations

import pathlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from tables_of_texts import edge_texts, prose, rows

import corpus_pipeline
from quillstat.llm import minhash
from quillstat.llm.stars import components


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[k : k + 2]) for k in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} - {()}


def brute(pairs):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(pairs):
        least[root(k)].append(i)
    out = []
    for k, (i, _) in enumerate(pairs):
        known = [x for x in least[root(k)] if x is not None]
        name = (min(known) if known else None) if sets[k] else i
        out.append((i, len(sets[k]), name, i == name))
    return out


def near_copies(seed, copies, words=60, edits=6):
    """Copies of one text with a few words changed: some pairs are links, some are not."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_edges(edges):
    want = sorted(brute(edge_texts()), key=repr)
    assert rows(minhash.link(edges), "doc_id", "n_shingles", "component_id", "kept") == want


@pytest.mark.parametrize("block", [1024, 16])
def test_large_group_of_near_copies(table, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "PARTNERS", 50)
    monkeypatch.setattr(minhash, "LOT_ROWS", 100)
    texts = near_copies(21, 150) + near_copies(22, 100, edits=14) + [prose(s, 40) for s in range(60)]
    pairs = [(1000 - k, t) for k, t in enumerate(texts)]
    want = sorted(brute(pairs), key=repr)
    assert rows(minhash.link(table(pairs)), "doc_id", "n_shingles", "component_id", "kept") == want
    assert 1 < len({r[2] for r in want}) < len(want)


def test_bucket_with_several_components(table):
    """Links between texts that are both far from the pivot are found."""
    texts = near_copies(31, 250, words=80, edits=18)
    pairs = list(enumerate(texts))
    got = rows(minhash.link(table(pairs)), "doc_id", "component_id")
    assert got == sorted(((i, c) for i, _, c, _ in brute(pairs)), key=repr)


def test_keep_first(edges):
    kept = minhash.keep_first(edges)
    assert kept.columns == edges.columns
    want = {(i, t) for (i, t), r in zip(edge_texts(), brute(edge_texts()), strict=True) if r[3]}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert set(got) == want and len(got) == len(want)


def test_one_of_a_group_stays_without_ids_of_their_own(table):
    """Near-copies whose ids are null, or one and the same, leave one row."""

    def copies(seed, n):
        words = prose(seed, 90).split()
        return [" ".join([*words[:k], f"v{k}", *words[k + 1 :]]) for k in range(10, 10 + n)]

    groups = [
        [(None, t) for t in copies(1, 6)],
        [(7, t) for t in copies(2, 6)],
        [(None, t) for t in copies(3, 3)] + [(9, t) for t in copies(3, 6)[3:]] + [(8, copies(3, 7)[6])],
        [(None, "alone"), (None, None), (7, "another")],
    ]
    docs = table([row for group in groups for row in group])
    kept = [(r.doc_id, r.text) for r in minhash.keep_first(docs).collect()]
    assert [sum(row in group for row in kept) for group in groups] == [1, 1, 1, 3]
    assert [i for i, t in kept if (i, t) in groups[2]] == [8]
    again = minhash.keep_first(docs.repartition(7)).collect()
    assert {(r.doc_id, r.text) for r in again} == set(kept) and len(again) == len(kept)


def test_the_stage_compares_five_words(table):
    """Two texts over 80 % alike by two words and under it by five are both kept by the stage."""
    words = [f"u{k}" for k in range(100)]
    edited = list(words)
    for k in (10, 30, 50, 70, 90):
        edited[k] = f"v{k}"
    close = list(words)
    close[50] = "v50"
    docs = table([(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(close)), (4, "a b C"), (5, "a B c")])

    def alike(a, b, size):
        a, b = ({tuple(t[k : k + size]) for k in range(len(t) - size + 1)} for t in (a, b))
        return len(a & b) / len(a | b)

    assert alike(words, edited, 2) > 0.8 > alike(words, edited, 5)
    assert alike(words, close, 5) > 0.8
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert [i for i, in rows(stage(docs.sparkSession, docs, ""), "doc_id")] == [1, 2, 4]
    assert [i for i, in rows(minhash.keep_first(docs), "doc_id")] == [1, 4]
    links = minhash.link(docs, shingle=5)
    assert rows(links, "doc_id", "n_shingles", "component_id") == [
        (1, 96, 1), (2, 96, 2), (3, 96, 1), (4, 1, 4), (5, 1, 4)
    ]


def test_nothing(empty):
    assert minhash.link(empty).count() == 0
    assert minhash.keep_first(empty).count() == 0


def test_nothing_alike(table):
    docs = table([(k, prose(300 + k, 30)) for k in range(5)] + [(9, None)])
    assert all(r.kept for r in minhash.link(docs).collect())


def test_no_pair_at_the_threshold_is_missed():
    """Sets at 80 % share a bucket, and the bits of their minima do not rule them out."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        items = np.unique(rng.integers(0, 2**63, 120).astype(np.uint64))
        a, b = np.sort(items[:100]), np.sort(np.concatenate([items[:89], items[100:111]]))
        found = minhash.minima([a, b])
        keys = minhash.band_keys(found)
        assert (keys[0] == keys[1]).any()
        bits = minhash.low_bits(found)
        differ = sum(bin(int(x) & (2**64 - 1)).count("1") for x in bits[0] ^ bits[1])
        assert differ <= minhash.MOST_BITS


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(k, k + 1) for k in range(100, 140)]  # a path
    edges += [(7, k) for k in range(200, 240)]  # a star
    edges += [(rng.randrange(500, 560), rng.randrange(500, 560)) for _ in range(45)]
    edges += [(3, 3), (7, 200)]
    rng.shuffle(edges)
    parent: dict[int, int] = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {n: root(n) for n in parent if root(n) != n}
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.label for r in found} == want and len(found) == len(want)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_small_tables_take_few_files(spark, table):
    """With many shuffle partitions, a small step is not written in a file for each."""
    settings = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "llm")
    docs = table(list(enumerate(near_copies(41, 150, words=80, edits=18)))).coalesce(1)
    old = {key: spark.conf.get(key) for key in settings}
    before = set(shared.glob("*"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = minhash.link(docs)
        assert got.rdd.getNumPartitions() == 1
        assert got.count() == 150
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    files = {p.name: len(list(p.glob("part-*"))) for p in set(shared.glob("*")) - before}
    assert len(files) > 10 and max(files.values()) <= 5, files
