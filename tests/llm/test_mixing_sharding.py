"""Mixing and sharding: laws on small tables, and the plan of the native one."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tables_of_texts import edge_texts, prose

from quillstat.llm import mixing, sharding


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Water-filling by repeated clamping."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


def source_of(k):
    return ("b", "a", None, "é", "b", "b")[k % 6]


def test_mix(edges):
    sizes = defaultdict(int)
    for k, (_, t) in enumerate(edge_texts()):
        sizes[source_of(k)] += words(t)
    want = targets(sizes)
    got = mixing.mix(edges).collect()
    assert len(got) == len(edge_texts())
    assert sorted(r.size for r in got) == sorted(words(t) for _, t in edge_texts())
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        by_target[r.target] += r.taken
    assert sorted(by_target) == pytest.approx(sorted(set(want.values())))
    largest = max(words(t) for _, t in edge_texts())
    for target, taken in by_target.items():
        assert abs(taken - target) <= largest / 2 + 1


def test_targets_of_skewed_sources(table, spark):
    rng = random.Random(1)
    for _ in range(3):
        size = {f"s{k:02}": rng.choice([0, 3, 10, 500, 4000]) for k in range(11)}
        sources = spark.createDataFrame(list(size.items()), "source string, size long")
        found = mixing.water_fill(mixing.cyclic_weights(sources)).collect()
        assert {r.source: r.target for r in found} == pytest.approx(targets(size))


def test_near_the_target(table):
    """Every source is within half a document of its target, and reruns agree."""
    docs = table([(k, prose(k, 5 + k % 40)) for k in range(600)])
    first = mixing.mix(docs).collect()
    taken = defaultdict(int)
    for r in first:
        taken[r.source_size, r.target] += r.taken
    assert len(taken) == 4
    assert all(abs(n - target) <= 23 for (_, target), n in taken.items())
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(first) == sorted(again)


@pytest.mark.parametrize("same", [None, 7])
def test_rows_that_share_an_id_are_not_one_block(table, same):
    """A third of the rows without an id, or with one id, are taken one by one."""
    docs = table([(same if k % 3 == 0 else k, prose(k, 20 + k % 5)) for k in range(240)])
    docs = docs.withColumn("source", F.when(F.crc32(F.col("text").cast("binary")) % 2 == 0, "a").otherwise("b"))
    got = mixing.mix(docs).collect()
    for target, size in {(r.target, r.source_size) for r in got}:
        taken = sum(r.taken for r in got if r.target == target)
        assert abs(taken - target) <= 24, (target, size)


def test_repeat_follows_mix(edges):
    copies = sum(r.copies for r in mixing.mix(edges).collect())
    out = mixing.repeat(edges)
    assert out.columns == edges.columns and out.count() == copies


def test_mix_is_native(edges):
    plan = mixing.mix(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_nothing(empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.repeat(empty).count() == 0
    assert sharding.assign(empty).count() == 0
    assert sharding.deal(empty).count() == 0


def check_shards(found, pairs):
    assert len(found) == len(pairs)
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        shard_of[r.size, r.text_crc32].add(r.shard)
    assert all(0 <= s < 24 for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in pairs)
    assert sorted((r.size, r.text_crc32) for r in found) == want


def test_assign(edges):
    check_shards(sharding.assign(edges).collect(), edge_texts())


def test_shards_are_even(table):
    pairs = [(k, prose(k % 900, 10 + k % 70)) for k in range(1500)]
    pairs += [(5000 + k, "the same text again") for k in range(500)]  # a large group
    found = sharding.assign(table(pairs)).collect()
    check_shards(found, pairs)
    loads = defaultdict(int)
    for r in found:
        loads[r.shard] += r.size
    mean = sum(loads.values()) / 24
    assert len(loads) == 24 and max(loads.values()) < 1.03 * mean and min(loads.values()) > 0.97 * mean


def test_a_group_larger_than_a_shard(table):
    pairs = [(k, "x" * 50) for k in range(400)] + [(k, prose(k, 12)) for k in range(300)]
    found = sharding.assign(table(pairs)).collect()
    check_shards(found, pairs)
    loads = defaultdict(int)
    for r in found:
        loads[r.shard] += r.size
    rest = sorted(loads.values())[:-1]
    largest = max(r.size for r in found if r.size > 58)
    assert max(rest) - min(rest) <= largest


def test_deal_keeps_the_rows(edges):
    out = sharding.deal(edges.withColumnRenamed("label", "slot"))
    assert set(out.columns) == (set(edges.columns) - {"label"}) | {"shard", "slot"}
    assert out.count() == edges.count()


def test_best_fit_against_plain_search():
    rng = random.Random(2)
    for capacity in (50, 100, 1000):
        sizes = sorted((rng.randint(1, 60) for _ in range(3000)), reverse=True)
        rooms, want = [], []
        for size in sizes:
            fits = [(room, k) for k, room in enumerate(rooms) if room >= size]
            if fits:
                room, k = min(fits)
            else:
                k = len(rooms)
                rooms.append(max(capacity, size))
            rooms[k] -= size
            want.append(k)
        assert sharding.best_fit(sizes, capacity) == want


def test_fewest_shards_of_a_capacity(spark):
    groups = spark.createDataFrame([(f"k{k}", 10 + k % 7) for k in range(1000)], "key string, size long")
    packed = sharding.pack(groups, capacity=130).join(groups, "key").collect()
    loads = defaultdict(int)
    for r in packed:
        loads[r.shard] += r.size
    total = sum(loads.values())
    assert len(packed) == 1000 and max(loads.values()) <= 130
    assert len(loads) <= 1.1 * total / 130 + 1
