from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quillstat.operators import skew
from quillstat.operators.joins import fan_out, lookup, pair, restrict_to
from quillstat.operators.ranking import first_by, not_first
from quillstat.operators.skew import Hot, Parts

PARTS = Parts({"a": 16, "b": 256})


@pytest.fixture
def left(spark):
    data = [("a", i) for i in range(300)] + [("b", i % 3) for i in range(60)]
    data += [("c", 1), ("d", 2), ("z", 3), (None, 4), (None, 5)]
    return spark.createDataFrame(data, "k string, v int").repartition(3)


@pytest.fixture
def right(spark):
    data = [("a", 10), ("a", 11), ("c", 12), ("d", 13), ("d", 13), (None, 14), ("y", 15)]
    data += [("b", i) for i in range(40)]
    return spark.createDataFrame(data, "k2 string, w int").repartition(3)


def brute(left, right, how):
    r = right.collect()
    out = Counter()
    for row in left.collect():
        hits = [x for x in r if row.k is not None and x.k2 == row.k]
        for hit in hits:
            out[tuple(row) + tuple(hit)] += 1
        if not hits and how == "left":
            out[tuple(row) + (None, None)] += 1
    return out


@pytest.mark.parametrize("hot", [skew.NONE, Hot(PARTS)])
@pytest.mark.parametrize("null_keys", [False, True])
def test_lookup_is_a_left_join(left, right, hot, null_keys):
    got = lookup(left, right, "k", "k2", hot, null_keys)
    assert Counter(map(tuple, got.collect())) == brute(left, right, "left")


@pytest.mark.parametrize("hot_left", [Parts(), PARTS])
@pytest.mark.parametrize("hot_right", [Parts(), PARTS])
def test_pair_and_fan_out(left, right, hot_left, hot_right):
    hot = Hot(hot_left, hot_right)
    got = pair(left, right, "k", "k2", hot)
    assert Counter(map(tuple, got.collect())) == brute(left, right, "inner")
    got = fan_out(left, right, "k", "k2", hot)
    assert Counter(map(tuple, got.collect())) == brute(left, right, "left")
    got = fan_out(left, right, "k", "k2", hot, right.select("k2"), True)
    assert Counter(map(tuple, got.collect())) == brute(left, right, "left")


def test_hot_keys_are_a_share_of_the_rows(spark):
    data = [("a",)] * 3000 + [("b",)] * 700 + [(str(i),) for i in range(500)] + [(None,)] * 999
    df = spark.createDataFrame(data, "k string")
    found = skew.find_hot({"x": [(df, "k")], "y": [(df.filter("k <> 'a'"), "k")]}, 1.0, 2, 10)
    assert found["x"].left.keys == {"a": 8, "b": 2}
    assert found["y"].left.keys == {"b": 6}
    assert not found["x"].right
    parts = skew.row_part(df, found["x"].left.of(F.col("k")))
    used = df.withColumn("part", parts).groupBy("k").agg(F.count_distinct("part").alias("n"))
    # Equal rows are told apart by their partition.
    assert {r.k: r.n for r in used.collect()}["a"] >= 2


def test_thousands_of_hot_keys_are_all_found(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    df = keys.crossJoin(spark.range(3)).select("k")
    found = skew.find_hot({"x": [(df, "k")]}, 1.0, 2, 6000)["x"]
    assert len(found.left.keys) == 5000 and set(found.left.keys.values()) == {2}


def test_a_key_hot_in_the_product_alone(spark):
    """A tenth of either side, but nearly all rows of the join."""
    def side(name):
        hot = spark.range(1000).select(F.lit("hot").alias(name), "id")
        return hot.unionByName(spark.range(9000).select(F.concat(F.lit("c"), "id").alias(name), "id"))

    left, right = side("l"), side("r").withColumnRenamed("id", "id2")
    assert not skew.find_hot({"x": [(left, "l")]}, 1.0, 2, 8)["x"]
    hot = skew.find_hot({"x": [(left, "l"), (right, "r")]}, 1.0, 2, 8)["x"]
    lefts, rights = hot.left.keys["hot"], hot.right.keys["hot"]
    assert lefts * rights >= 8 and set(hot.left.keys) == {"hot"}
    joined = pair(left, right, "l", "r", hot)
    assert joined.count() == 1000 * 1000 + 9000
    left = left.withColumn("p", F.when(F.col("l") == "hot", skew.row_part(left, F.lit(lefts))))
    largest = left.groupBy("p").count().filter("p is not null").agg(F.max("count")).first()[0]
    assert largest < 2 * 1000 / lefts


def test_parts_of_three_tables(spark):
    one = spark.createDataFrame([("a",)] * 20 + [("b",)] * 20, "k string")
    two = spark.createDataFrame([("a",)] * 30 + [("b",)], "k string")
    found = skew.find_hot({"x": [(one, "k"), (two, "k"), (two, "k")]}, 1.0, 2, 10)["x"]
    assert set(found.left.keys) | set(found.right.keys) == {"a"}
    assert found.left.keys.get("a", 1) * found.right.keys["a"] >= 10


@pytest.mark.parametrize(("wanted", "left", "right"), [(16, 100, 1), (16, 100, 100), (7, 1, 1e6), (1, 5, 5)])
def test_divide(wanted, left, right):
    a, b = skew.divide(wanted, left, right)
    assert 1 <= a <= wanted and a * b >= wanted and a * (b - 1) < wanted
    assert a >= b or right > left


def test_parts_survive_a_retry_with_rows_in_another_order(spark):
    df = spark.range(2000).repartition(4, "id").select((F.col("id") % 50).alias("v"), "id")
    ways = [df.sortWithinPartitions("id"), df.sortWithinPartitions(F.desc("id"))]
    parts = [rows(d.select("id", skew.row_part(d, F.lit(64)).alias("part"))) for d in ways]
    assert parts[0] == parts[1]
    assert len({p for _, p in parts[0]}) == 64


def test_null_keys_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(4000).select(
            F.when(F.col("id") < 5, F.col("id").cast("string")).alias("k"), "id"
        )
        right = spark.range(5).select(F.col("id").cast("string").alias("k2"))
        joined = lookup(left, right, "k", "k2", null_keys=True)
        assert joined.count() == 4000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "Union" in plan
        assert "Filter (id" in plan  # the rows without a key, beside the join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_restrict_to_never_repeats_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "id string, v int")
    ids = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    want = [("a", 1), ("a", 3)]
    assert rows(restrict_to(df, ids, "id")) == want
    swapped = df.select("v", "id")
    assert restrict_to(swapped, ids, "id").columns == ["v", "id"]
    assert rows(restrict_to(df, ["a", "a"], "id")) == want
    assert restrict_to(df, None, "id") is df


def test_ids_of_a_selection_cut_a_large_table_before_its_shuffle(spark, tmp_path):
    path, number = str(tmp_path / "large"), 6_000_000
    spark.range(number).select("id", F.rand(1).alias("v")).write.parquet(path)
    large = spark.read.parquet(path).select(F.col("id").cast("string").alias("k"), "v")
    ids = spark.read.parquet(path).filter((F.col("id") % 1000).isin(3, 7)).select(
        F.col("id").cast("string").alias("k")
    )
    kept = restrict_to(large, ids, "k", few=True)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "might_contain" in kept._jdf.queryExecution().optimizedPlan().toString()
        found = kept.agg(F.count(F.lit(1)), F.sum(F.col("k").cast("bigint") % 1000)).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert tuple(found) == (number // 500, number // 1000 * 10)


@pytest.mark.parametrize("few", [False, True])
def test_restrict_to_with_repeated_and_missing_ids(spark, left, few):
    ids = spark.createDataFrame([("a",), ("a",), ("c",), (None,), ("q",)], "k string")
    kept = restrict_to(left, ids, "k", few)
    assert rows(kept) == rows(left.filter(F.col("k").isin("a", "c")))


@pytest.mark.parametrize("partitions", [1, 7])
def test_first_by(spark, partitions):
    data = [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "q"), ("b", 0, "r")]
    data += [(None, 5, "n")]
    df = spark.createDataFrame(data, "k string, t int, name string").repartition(partitions)
    got = first_by(df, "k", [F.col("t").desc_nulls_last(), F.col("name").desc_nulls_last()])
    assert rows(got) == [("a", 3, "z"), ("b", 0, "r")]


def test_first_by_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("k"), "id")
    plan = first_by(df, "k", [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("partitions", [1, 5])
def test_not_first_flags_all_but_one_row_of_each_key(spark, partitions):
    rng = random.Random(3)
    keys = ["a", "a", "a", "b", None]
    data = [(rng.choice(keys), rng.choice(keys), rng.choice([0, 1, 2, None])) for _ in range(300)]
    data += [("copies", "x", 1)] * 50 + [("one", None, 1)]
    df = spark.createDataFrame(data, "k string, other string, t int").repartition(partitions)
    got = not_first(df, {"later": ("k", ["t", "k"]), "late": ("other", ["t", "k"])}).collect()
    assert Counter((r.k, r.other, r.t) for r in got) == Counter(data)

    def rank(t):
        return (t is not None, t or 0)

    for place, flag in ((0, "later"), (1, "late")):
        for key in {row[place] for row in data}:
            first = [r.t for r in got if r[place] == key and not r[flag]]
            assert first == [min((row[2] for row in data if row[place] == key), key=rank)]


@pytest.mark.parametrize("sample", [0.2, 1.0])
def test_a_sample_of_distinct_rows_is_drawn_before_the_shuffle(spark, sample):
    df = spark.range(6000).select((F.col("id") % 2000).cast("string").alias("k"), F.lit("x").alias("c"))
    drawn = skew.sample_once(df, sample)
    got = rows(drawn)
    assert len(got) == len(set(got)) and abs(len(got) - 2000 * sample) <= 100
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert sample == 1.0 or "xxhash64" in below


def test_equal_rows_of_a_side_count_once(spark):
    """100 rows of one pair are one row of the join's product, 100 pairs are 100."""
    left = spark.range(200).select((F.col("id") % 2).cast("string").alias("k"))
    pairs = spark.range(200).select(
        (F.col("id") % 2).cast("string").alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("c")
    )
    hot = skew.find_hot({"j": [(left, "k"), (pairs, "k", True)]}, sample=1.0, sure=2, partitions=8)["j"]
    assert hot.right.keys.get("0", 1) > 1 and hot.right.keys.get("1", 1) == 1
