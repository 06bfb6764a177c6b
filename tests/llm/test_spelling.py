"""Spelling variants against deletion neighbourhoods, and the numbering of trie nodes."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillstat.llm import spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, slip):
    counts = Counter()
    for doc, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOW)
            if slip and doc is not None and (h := zlib.crc32(f"{doc}:{word}".encode())) % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    short = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            short[i, w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for (_, s), words in short.items():
        for w in words:
            near[w] |= words - {w}
            if s in counts:
                near[w].add(s)
                near[s].add(w)
    form = {}
    for w in counts:
        if near[w]:
            best = min(near[w], key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return sorted(out)


def found(df, slip=None):
    return sorted(tuple(r) for r in spelling.group(df, slip=slip).collect())


def misspelled(seed, documents=30):
    """Words and one-letter edits of them, with repeated and accented letters."""
    rng = random.Random(seed)
    stems = ["letter", "aaaaaa", "Ärgerlich", "banana", "élève", "mississippi", "committee", "ÿpsilon"]
    rows = []
    for i in range(documents):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w = rng.choice((w[:k] + w[k + 1 :], w[:k] + "b" + w[k + 1 :], w[:k] + w[k] + w[k:]))
            words.append(rng.choice((w, w.upper(), w.capitalize())))
        rows.append((i, " ".join(words) + rng.choice(("", "!", "-x", "7abcde"))))
    return rows


def edge_rows():
    return [
        (1, None),
        (2, ""),
        (3, " 12 ... ß日本語"),
        (4, "longer Longer LONGER langer langer langer langer langer langer"),
        (5, "abcde×abcde÷abcde"),  # both signs lie between À and ÿ
        (None, "slipping slipping slipping"),
        (None, None),
        (6, ("x" * 3000 + " ") * 3 + ("x" * 2999 + "y ") * 7),
        (7, "tiess tiess tiess tiest tiest tiest tiesu tiesu tiesu ties ties ties"),
        (7, "tiess tiess tiess tiest tiest tiest tiesu tiesu tiesu ties ties ties"),
        (8, "chain chain chain " + "chains " * 6 + "chainsy " * 12 + "chainsyz " * 24 + "rchainsyz " * 48),
    ]


def docs(table, rows):
    return table(rows).withColumn("word", F.lit("w")).withColumn("form", F.lit("f"))


@pytest.mark.parametrize("slip", [None, 3, 97])
def test_edges(table, slip):
    assert found(docs(table, edge_rows()), slip) == brute(edge_rows(), slip)
    assert found(docs(table, [])) == [] and found(docs(table, [(1, "rare words")])) == []


@pytest.mark.parametrize("words", [50_000, 7, 1], ids=["one range", "some ranges", "a range a word"])
def test_edits(table, monkeypatch, words):
    monkeypatch.setattr(spelling, "RANGE_WORDS", words)
    rows = misspelled(words, 30 if words > 1 else 4)
    assert found(docs(table, rows), 11) == brute(rows, 11)


def test_words_that_meet_are_not_collected(spark):
    """Lists of them made more objects than an executor's heap had room for."""
    met = "struct<rank: long, n: long, skips: boolean, first: boolean>"
    rows = [(1, 2, (r, n, s, f)) for r, n, s, f in [
        (5, 9, True, True), (6, 9, True, False), (7, 3, True, True), (8, 4, False, True),
    ]] + [(1, 3, (5, 9, True, True)), (2, 2, (6, 9, False, True)), (2, 2, (7, 3, True, False))]
    near = spelling.neighbours(spark.createDataFrame(rows, f"prefix long, suffix long, met {met}"))
    assert "collect_list" not in near._jdf.queryExecution().optimizedPlan().toString()
    out = {r.rank: (r.n_near, r.best.n, -r.best.order) for r in near.collect()}
    assert out == {5: (3, 9, 6), 6: (2, 9, 5), 7: (3, 9, 5), 8: (2, 9, 5)}


def test_chains_end_at_the_root(table):
    out = {r[0]: r for r in found(docs(table, edge_rows()))}
    assert out["chain"][1:3] == ("chains", "rchainsyz")
    assert out["rchainsyz"][1:3] == (None, "rchainsyz")


def test_numbers_stand_for_prefixes():
    """Equal prefixes have equal numbers, others others, however the ranges are cut."""
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(90)})
    for size in (1, 2, 5, 200):
        ranges = [words[i : i + size] for i in range(0, len(words), size)]
        edges = [(3 * i, own[0], own[-1]) for i, own in enumerate(ranges)]
        known = spelling.carried(edges)
        names, strings = {}, set()
        for (part, _, _), own in zip(edges, ranges, strict=True):
            for word, path in zip(own, spelling.number(own, part, *known[part]), strict=True):
                assert len(path) == len(word) + 1
                for depth, node in enumerate(path):
                    assert names.setdefault(word[:depth], node) == node
                    strings.add(word[:depth])
        assert len(set(names.values())) == len(strings)
