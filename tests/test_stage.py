from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from quillstat.fixed_values import ALLOWLIST, CURRENCIES
from quillstat.operators.joins import lookup
from quillstat.operators.skew import Hot, Parts
from quillstat.plans import stage
from quillstat.plans.facts import collects_v1, ledger_of
from quillstat.sources.sinks import export_times

USDC = next(c.address for c in CURRENCIES if c.label == "USDC")
WETH = next(c.address for c in CURRENCIES if c.label == "WETH")
TIME = ts("2024-03-17 10:00:00")


def world(sources):
    return sources(
        post_v1=[
            {"profile_id": "1", "post_id": "p", "block_timestamp": TIME},
            {"profile_id": "1", "post_id": "bare", "block_timestamp": TIME},
            {"profile_id": "2", "post_id": "uncollected", "block_timestamp": TIME},
        ],
        collect_module_v1=[
            {"publication_id": "p", "currency": USDC, "amount": "2500000", "referral_fee": 0.1},
            {"publication_id": "p", "currency": "0xx", "amount": "3", "referral_fee": 0.2},
            {"publication_id": "uncollected", "currency": USDC, "amount": "10000000"},
            {"publication_id": "no such post", "currency": USDC, "amount": "1"},
        ],
        collect_record_v1=[
            {"publication_id": "p", "block_timestamp": TIME, "collected_by": "w", "referral_id": "r1"},
            {"publication_id": "p", "block_timestamp": TIME, "collected_by": "?", "referral_id": "r2"},
            {"publication_id": "p", "block_timestamp": TIME, "collected_by": None, "referral_id": "r3"},
            {"publication_id": "bare", "block_timestamp": TIME, "collected_by": "w", "referral_id": "r4"},
        ],
        profile_v1=[
            {"profile_id": "7", "owned_by": "w", "handle": "seven"},
            {"profile_id": "8", "owned_by": "w", "handle": "eight"},
            {"profile_id": "9", "owned_by": None, "handle": "nobody"},
        ],
        profile_stats_v1=[
            {"profile_id": "7", "total_collects": None},
            {"profile_id": "8", "total_collects": 3},
        ],
    )


def test_allowlist(spark):
    ids = stage.allowlist(spark)
    assert rows(ids) == sorted((i,) for i in ALLOWLIST)
    assert ids.count() == 12


def test_wallet_goes_to_the_profile_with_most_collects(sources):
    src = world(sources)
    top = stage.top_profile_per_owner(src.profile_v1, src.profile_stats_v1)
    assert rows(top) == [("w", "8", "eight")]


def test_ledger_keeps_posts_without_modules_or_collects(sources):
    ledger = ledger_of(world(sources))
    got = rows(ledger, "post_id", "currency", "amount", "referral_id", "profile_id_collected")
    usd, raw = Decimal("2.50"), Decimal("3.00")
    assert got == sorted(
        [
            ("p", "USDC", usd, "r1", "8"),
            ("p", "USDC", usd, "r2", None),
            ("p", "USDC", usd, "r3", None),
            ("p", "0xx", raw, "r1", "8"),
            ("p", "0xx", raw, "r2", None),
            ("p", "0xx", raw, "r3", None),
            ("bare", None, None, "r4", "8"),
            ("uncollected", "USDC", Decimal("10.00"), None, None),
        ],
        key=repr,
    )


def test_ledger_with_hot_keys_is_the_same(sources):
    src = world(sources)
    parts = Parts({"p": 16, "w": 16})
    hot = Hot(parts, parts)
    args = (
        src.post_v1,
        src.collect_module_v1,
        src.collect_record_v1,
        src.profile_v1,
        src.profile_stats_v1,
    )
    plain = stage.collect_ledger(*args)
    names = ("ledger_posts", "ledger_modules", "ledger_wallets")
    salted = stage.collect_ledger(*args, CURRENCIES, {name: hot for name in names})
    assert rows(salted) == rows(plain)


def test_revenue_without_building_the_ledger(sources):
    src = world(sources)
    direct = stage.revenue_v1_from_raw(src.post_v1, src.collect_module_v1, src.collect_record_v1)
    assert direct.schema["amount"].dataType.simpleString() == "decimal(38,2)"
    assert rows(direct) == rows(stage.revenue_v1(ledger_of(src)))
    assert ("uncollected", "USDC", Decimal("10.00")) in rows(direct)
    assert ("p", "USDC", Decimal("7.50")) in rows(direct)
    assert ("bare", None, None) in rows(direct)


def test_v1_collects_after_the_hop(sources):
    src = world(sources)
    hop = export_times(ledger_of(src))
    assert dict(hop.dtypes)["collect_date"] == "bigint"
    got = rows(
        collects_v1(hop),
        "publication_id",
        "interaction_time",
        "interaction_profile_id",
        "interaction_type",
        "amount_USD",
    )
    time = "10:00:00.000000"
    assert len(got) == 7
    assert ("p", time, "8", "PAID COLLECT", Decimal("2.500000")) in got
    assert ("p", time, "8", "PAID COLLECT", Decimal("3.000000")) in got
    assert ("bare", time, "8", "FREE COLLECT", Decimal("0.000000")) in got
    assert not [r for r in got if r[0] == "uncollected"]


def test_ledger_of_creators(sources):
    src = world(sources)
    everyone = [r for r in rows(ledger_of(src)) if r[0] == "1"]
    assert rows(ledger_of(src, ["1"])) == everyone


@pytest.mark.parametrize("crowded", [Parts(), Parts({"1": 4, "gone": 2})])
def test_sums_by_key_are_the_sums_and_move_rows_once(spark, crowded):
    ledger = spark.range(400).repartition(5).select(
        F.when(F.col("id") % 9 != 0, (F.col("id") % 4).cast("string")).alias("post_id"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 3).cast("string")).alias("currency"),
        F.when(F.col("id") % 7 != 0, F.col("id") / 4).cast("decimal(38,2)").alias("amount"),
    )
    want = rows(stage.revenue_v1(ledger))
    assert len(want) > 16 and rows(stage.revenue_v1(ledger, crowded)) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        posts = spark.range(4).select(F.col("id").cast("string").alias("k"))
        joined = lookup(posts, stage.revenue_v1(ledger, crowded), "k", "post_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Posts, and the ledger by post; crowded posts are summed before.
    assert plan.count("Exchange hashpartitioning") == 2 + bool(crowded)


@pytest.mark.parametrize("crowded", [Parts(), Parts({"1": 4})])
def test_revenue_of_crowded_publications(sources, crowded):
    modules = [
        {"publication_id": key, "currency": currency, "amount": amount}
        for key in ("1", "1", "2", None)
        for currency in (USDC, WETH, "0xx", None)
        for amount in ("2500000", None)
    ]
    table = sources(action_module=modules).action_module
    assert rows(stage.revenue_v2(table, CURRENCIES, crowded)) == rows(stage.revenue_v2(table))
