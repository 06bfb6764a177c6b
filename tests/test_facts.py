from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from quillstat.fixed_values import CURRENCIES
from quillstat.operators.rows import at_most, repeated
from quillstat.operators.skew import Hot, Parts, find_hot
from quillstat.plans import dimensions, facts, stage
from quillstat.schemas import INTERACTION, INTERACTION_LOG, PROFILE, PUBLICATION, check

ADDRESS = {c.label: c.address for c in CURRENCIES}
TIME = ts("2024-03-17 22:13:20.123456")
DAY = dt.date(2024, 3, 17)


def test_date_dimension(spark):
    days = dimensions.date_dimension(spark)
    assert days.count() == 1461
    assert days.filter("date = date'2024-02-29'").count() == 1


def test_profile_with_latest_name_and_login(raw):
    profiles = dimensions.profile_dimension(
        raw(
            "profile_record",
            {"profile_id": "1", "owned_by": "w", "is_burnt": False, "block_timestamp": TIME},
            {"profile_id": "1", "owned_by": "w", "is_burnt": False, "block_timestamp": TIME},
            {"profile_id": "2", "owned_by": "w", "is_burnt": True, "block_timestamp": TIME},
        ),
        raw(
            "profile_metadata",
            {"profile_id": "1", "name": "old", "block_timestamp": ts("2020-01-01")},
            {"profile_id": "1", "name": "x", "block_timestamp": TIME},
            {"profile_id": "1", "name": "y", "block_timestamp": TIME},
        ),
        raw(
            "profile_last_logged_in",
            {"profile_id": "1", "last_logged_in": TIME},
            {"profile_id": "1", "last_logged_in": ts("2023-01-01")},
        ),
        raw("profile_stats", {"profile_id": "1", "total_posts": 5}),
        raw("follower_stats", {"profile_id": "1", "total_followers": 6, "total_following": 7}),
        raw("profile_quality", {"profile_id": "2", "score": 0.5}),
    )
    check(profiles, PROFILE)
    got = rows(
        profiles,
        "profile_id",
        "profile_name",
        "profile_last_logged_in_date",
        "profile_last_logged_in_time",
        "profile_creation_date",
        "profile_posts",
        "profile_followers",
        "profile_following",
        "score",
    )
    assert got == [
        ("1", "y", DAY, "22:13:20.123456", DAY, 5, 6, 7, None),
        ("2", None, None, None, DAY, None, None, None, 0.5),
    ]


def test_currency_and_amount_fall_back_separately(spark, raw):
    records = raw(
        "publication_record",
        {"publication_id": "a", "block_timestamp": TIME},
        {"publication_id": "b", "block_timestamp": TIME},
        {"publication_id": "c", "block_timestamp": TIME},
    )
    revenue = spark.createDataFrame(
        [("a", "WETH", None, None), ("b", "DAI", Decimal("1"), None), ("b", "NCT", None, None)],
        "publication_id string, currency string, amount decimal(38,2), amount_USD decimal(38,6)",
    )
    first = spark.createDataFrame(
        [("a", "USDC", Decimal("5")), ("c", "USDC", Decimal("6"))],
        "post_id string, currency string, amount decimal(38,2)",
    )
    fact = facts.publication_fact(
        records, raw("publication_metadata"), revenue, raw("publication_stats"), first
    )
    check(fact, PUBLICATION)
    got = rows(fact, "publication_id", "publication_currency", "publication_revenue")
    assert got == sorted(
        [
            ("a", "WETH", Decimal("5.00")),
            ("b", "DAI", Decimal("1.00")),
            ("b", "NCT", None),
            ("c", "USDC", Decimal("6.00")),
        ],
        key=repr,
    )
    assert {r[0] for r in rows(fact, "publication_date_year_month")} == {dt.date(2024, 3, 1)}


def family(raw):
    return raw(
        "publication_record",
        {"publication_id": "p", "profile_id": "1", "publication_type": "POST", "block_timestamp": TIME},
        {
            "publication_id": "c",
            "profile_id": "2",
            "publication_type": "COMMENT",
            "parent_publication_id": "p",
            "app": "app",
            "block_timestamp": TIME,
        },
        {
            "publication_id": "orphan",
            "profile_id": "3",
            "publication_type": "QUOTE",
            "parent_publication_id": "gone",
            "block_timestamp": TIME,
        },
    )


def test_children_of_missing_parents_stay(raw):
    records = family(raw)
    metadata = raw("publication_metadata", {"publication_id": "c", "language": "en"})
    for hot in (Hot(), Hot(Parts({"p": 16, "gone": 16}))):
        got = facts.derivatives(records, metadata, facts.owners_of(records), hot=hot)
        chosen = rows(
            got,
            "publication_id",
            "profile_id",
            "interaction_profile_id",
            "interaction_publication_id",
            "interaction_app",
            "interaction_language",
            "interaction_type",
        )
        assert chosen == [
            ("p", "1", "2", "c", "app", "en", "COMMENT"),
            (None, None, "3", "orphan", None, None, "QUOTE"),
        ]
    owned = facts.derivatives(records, metadata, facts.owners_of(records, ["1"]), True)
    assert rows(owned, "publication_id") == [("p",)]


def acted_world(raw):
    acted = raw(
        "acted_record",
        {"publication_id": "p", "acted_profile_id": "5", "is_collect": True, "block_timestamp": TIME},
        {"publication_id": "p", "acted_profile_id": "6", "is_collect": False, "block_timestamp": TIME},
        {"publication_id": "p", "acted_profile_id": "7", "is_collect": None, "block_timestamp": TIME},
        {"publication_id": "c", "acted_profile_id": "5", "is_collect": True, "block_timestamp": TIME},
        {"publication_id": "?", "acted_profile_id": "5", "is_collect": True, "block_timestamp": TIME},
    )
    modules = raw(
        "action_module",
        {"publication_id": "p", "currency": ADDRESS["DAI"], "amount": "5" + "0" * 18},
        {"publication_id": "p", "currency": ADDRESS["NCT"], "amount": "0"},
        {"publication_id": "c", "currency": ADDRESS["DAI"], "amount": None},
    )
    return acted, modules


def test_collect_rows_multiply_by_modules_and_currencies(raw):
    records = family(raw)
    acted, modules = acted_world(raw)
    revenue = stage.revenue_v2(modules)
    five, zero = Decimal("5.000000"), Decimal("0.000000")
    want = []
    for actor, kinds in {
        "5": ("PAID COLLECT", "FREE COLLECT"),
        "6": (None, None),
        "7": (None, None),
    }.items():
        want += [("p", "1", actor, kind, usd) for kind in kinds for usd in (five, zero)]
    want += [("c", "2", "5", "FREE COLLECT", None), ("?", None, "5", "FREE COLLECT", None)]
    columns = (
        "publication_id",
        "profile_id",
        "interaction_profile_id",
        "interaction_type",
        "amount_USD",
    )
    parts = Parts({"p": 16, "c": 16})
    for hot in (Hot(), Hot(parts, parts)):
        got = facts.collects_v2(
            acted, facts.owners_of(records), modules, revenue, False, {"acted": hot, "modules": hot}
        )
        assert rows(got, *columns) == sorted(want, key=repr)
    owned = facts.collects_v2(acted, facts.owners_of(records, ["2"]), modules, revenue, True)
    assert rows(owned, *columns) == [("c", "2", "5", "FREE COLLECT", None)]


def test_modules_and_revenue_are_independent(raw):
    """A publication may be in one of the two tables alone."""
    records = family(raw)
    acted = raw(
        "acted_record",
        {"publication_id": "p", "acted_profile_id": "5", "is_collect": True, "block_timestamp": TIME},
    )
    module = {"publication_id": "p", "currency": ADDRESS["DAI"], "amount": "5" + "0" * 18}
    none, some = raw("action_module"), raw("action_module", module)
    five = Decimal("5.000000")
    for modules, staged, want in (
        (some, none, ("PAID COLLECT", None)),
        (none, some, ("FREE COLLECT", five)),
        (some, some, ("PAID COLLECT", five)),
        (none, none, ("FREE COLLECT", None)),
    ):
        for parts in (Parts(), Parts({"p": 4})):
            hot = {"acted": Hot(parts), "modules": Hot(parts, parts)}
            got = facts.collects_v2(
                acted, facts.owners_of(records), modules, stage.revenue_v2(staged), False, hot
            )
            assert rows(got, "interaction_type", "amount_USD") == [want]


def test_mention_takes_author_and_language_if_found(raw):
    got = facts.mentions(
        raw(
            "mention",
            {"profile_id": "9", "publication_id": "c", "timestamp": TIME},
            {"profile_id": "9", "publication_id": "unknown", "timestamp": TIME},
        ),
        family(raw),
        raw(
            "publication_metadata",
            {"publication_id": "c", "language": "en"},
            {"publication_id": "unknown", "language": "de"},
        ),
    )
    chosen = rows(
        got,
        "publication_id",
        "profile_id",
        "interaction_profile_id",
        "interaction_publication_id",
        "interaction_language",
        "interaction_type",
    )
    assert chosen == sorted(
        [
            (None, "9", "2", "c", "en", "MENTION"),
            (None, "9", None, "unknown", None, "MENTION"),
        ],
        key=repr,
    )


def test_log_is_the_union_of_its_branches(raw):
    records = family(raw)
    acted, modules = acted_world(raw)
    owners = facts.owners_of(records)
    branches = [
        facts.follows(raw("follower", {"profile_id": "1", "block_timestamp": TIME})),
        facts.collects_v2(acted, owners, modules, stage.revenue_v2(modules)),
        facts.reactions(raw("reaction", {"publication_id": "p", "action_at": TIME}), owners),
    ]
    log = facts.interaction_log(branches)
    check(log, INTERACTION_LOG)
    assert log.count() == sum(b.count() for b in branches)
    assert rows(log.select("interaction_date", "interaction_date_year_month").distinct()) == [
        (DAY, dt.date(2024, 3, 1))
    ]
    # Cents survive the union with branches that have none.
    assert log.filter("amount_USD = 5").count() == 6
    check(log.drop("interaction_date_year_month"), INTERACTION)


def at(day):
    return ts(f"2024-01-0{day}")


def history(raw, profiles, make=dimensions.handle_history):
    return make(
        raw(
            "ownership_history",
            {"profile_id": "1", "owned_by": "w1", "block_timestamp": at(1)},
            {"profile_id": "1", "owned_by": "w1", "block_timestamp": at(3)},
            {"profile_id": "1", "owned_by": "w2", "block_timestamp": at(2)},
            {"profile_id": "2", "owned_by": "w2", "block_timestamp": at(4)},
            {"profile_id": "3", "owned_by": "w3", "block_timestamp": at(5)},
            {"profile_id": "4", "owned_by": "w4", "block_timestamp": at(6)},
        ),
        raw(
            "handle_history",
            {"owned_by": "w1", "handle": "h", "block_timestamp": at(1)},
            {"owned_by": "w2", "handle": "h", "block_timestamp": at(1)},
        ),
        raw("profile_record", {"profile_id": "1", "owned_by": "w1"}),
        profiles,
    )


COLUMNS = (
    "profile_id",
    "ownership_owner",
    "handle",
    "profile_record_id",
    "profile_changed_flag",
    "address_changed_flag",
)


def test_history_flags(raw):
    assert rows(history(raw, None), *COLUMNS) == sorted(
        [
            ("1", "w2", "h", None, False, False),
            ("1", "w1", "h", "1", True, True),
            ("2", "w2", "h", None, False, True),
            ("3", "w3", None, None, False, False),
            ("4", "w4", None, None, False, True),  # missing handles count as one
        ],
        key=repr,
    )


def test_history_flags_count_the_chosen_profiles_only(raw):
    assert rows(history(raw, ["2", "4"]), *COLUMNS) == [
        ("2", "w2", "h", None, False, False),
        ("4", "w4", None, None, False, False),
    ]


def test_history_order(raw):
    # Only the query result is sorted; the product, a stored table, has no order.
    got = [(r.profile_id, r.handle) for r in history(raw, None, dimensions.sorted_history).collect()]
    assert [g[0] for g in got] == ["1", "1", "2", "3", "4"]


def by_hand(owners, handles, records):
    """The history's rows and flags, numbered one after another as the source system does."""
    owned = {}
    for profile, wallet, time in owners:
        owned[profile, wallet] = max(owned.get((profile, wallet), time), time)
    out = []
    for (profile, wallet), time in owned.items():
        mine = [h for h in handles if wallet is not None and h[0] == wallet]
        for handle in mine or [(None, None, None)]:
            ids = [r[0] for r in records if handle[0] is not None and r[1] == handle[0]]
            out += [(time, profile, wallet, handle[1], handle[2], i) for i in ids or [None]]
    out.sort(key=lambda r: [(x is not None, x) for x in r])
    seen, rows_ = set(), []
    for time, profile, wallet, handle, at_, record in out:
        later = ("profile", profile) in seen, ("handle", handle) in seen
        seen |= {("profile", profile), ("handle", handle)}
        rows_.append((profile, record, wallet, handle, time, *later))
    return sorted(rows_, key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("dividing", [False, True])
def test_flags_of_random_histories(raw, seed, dividing):
    """Few values, so that times, wallets, handles and whole rows repeat; some are missing."""
    rng = random.Random(seed)

    def some(*values):
        return rng.choice(values)

    wallets = ("a", "b", "c", "d", None)
    owners = [(some("1", "2", "3", "4"), some(*wallets), at(rng.randint(1, 4))) for _ in range(14)]
    handles = [(some(*wallets), some("h", "i", None), at(rng.randint(1, 2))) for _ in range(8)]
    records = [(some("1", "2", "3", "4", "5"), some(*wallets)) for _ in range(8)]
    parts = Parts({"a": 3, "b": 2})
    hot = {"handles": Hot(parts, parts), "owners": Hot(parts, parts)} if dividing else {}
    got = dimensions.handle_history(
        raw("ownership_history", *[dict(zip(("profile_id", "owned_by", "block_timestamp"), r)) for r in owners]),
        raw("handle_history", *[dict(zip(("owned_by", "handle", "block_timestamp"), r)) for r in handles]),
        raw("profile_record", *[dict(zip(("profile_id", "owned_by"), r)) for r in records]),
        None,
        hot,
    )
    columns = ("profile_id", "profile_record_id", "ownership_owner", "handle", "block_timestamp",
               "profile_changed_flag", "address_changed_flag")
    assert rows(got, *columns) == by_hand(owners, handles, records)


def test_a_hot_publication_stays_divided_along_the_joins(spark, raw):
    """Acts, then modules, then currencies: no task ever has more than its share."""
    acts, modules, currencies, partitions = 60, 50, 30, 16
    acted = spark.range(acts).select(
        F.lit("p").alias("publication_id"),
        F.col("id").cast("string").alias("acted_profile_id"),
        F.lit(True).alias("is_collect"),
        F.lit(TIME).alias("block_timestamp"),
    )
    module = spark.range(modules).select(
        F.lit("p").alias("publication_id"), F.lit("x").alias("currency"), F.col("id").cast("string").alias("amount")
    )
    revenue = spark.range(currencies).select(
        F.lit("p").alias("publication_id"), F.col("id").cast("decimal(38,6)").alias("amount_USD")
    )
    sides = [(t, "publication_id") for t in (acted, module, revenue)]
    joins = {"acted": sides[:1], "modules": sides[:2], "revenue": sides}
    hot = find_hot(joins, sample=1.0, sure=2, partitions=partitions)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": str(partitions)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = facts.collects_v2(acted, facts.owners_of(family(raw)), module, revenue, False, hot)
        tasks = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == acts * modules * currencies
    assert max(tasks) <= 4 * sum(tasks) / partitions


def test_rows_of_a_publication_are_made_after_the_shuffle(raw, spark, tmp_path):
    """40 acts on a publication with 60 modules are 40 rows until they are written."""
    acted = [
        {"publication_id": "p", "acted_profile_id": str(i), "is_collect": True, "block_timestamp": TIME}
        for i in range(40)
    ]
    modules = [
        {"publication_id": "p", "currency": ADDRESS["DAI"], "amount": "0" if i % 3 else "9" + "0" * 18}
        for i in range(60)
    ]
    tables = raw("acted_record", *acted), facts.owners_of(family(raw)), raw("action_module", *modules)
    revenue = stage.revenue_v2(tables[2])
    packed = facts.collects_v2.packed(*tables, revenue)
    assert packed.count() == 80  # paid and free ones
    got = facts.collects_v2(*tables, revenue)
    kinds = {r["interaction_type"]: r["count"] for r in got.groupBy("interaction_type").count().collect()}
    assert kinds == {"PAID COLLECT": 40 * 20, "FREE COLLECT": 40 * 40}


def test_rows_that_stand_for_very_many_are_divided(spark):
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 35)], "k string, n bigint")
    parts = at_most(df, "n", 10)
    assert rows(parts) == sorted(
        [("a", 1), ("b", 10), ("c", 10), ("c", 1), ("d", 10), ("d", 10), ("d", 10), ("d", 5)], key=repr
    )
    assert rows(repeated(parts, "n").groupBy("k").count()) == rows(df)


def test_packed_publications_are_the_publications(spark, raw):
    """With and without own currency and amount, and currencies of the first generation."""
    ids = [str(i) for i in range(12)]
    records = raw(
        "publication_record",
        *[{"publication_id": i, "profile_id": "1", "block_timestamp": at(1 + int(i) % 5)} for i in ids],
        {"publication_id": "3", "profile_id": "2", "block_timestamp": TIME},
        {"publication_id": None, "profile_id": "2", "block_timestamp": TIME},
        {"publication_id": "4", "profile_id": "2"},
    )
    own = [(i, c, a) for i in ids for c, a in [("x", 1), ("y", None), (None, 2), ("z", 3)][: int(i) % 5]]
    first = [(i, c, a) for i in ids for c, a in [("u", 5), ("v", None), (None, 6)][: int(i) % 4]]
    # Equal currencies and posts without an id.
    own += [(None, "x", 7), ("2", "x", 1)]
    first += [(None, "u", 7), ("5", "u", 5), ("5", "u", 8)]
    revenue = spark.createDataFrame(own, "publication_id string, currency string, amount long")
    posts = spark.createDataFrame(first, "post_id string, currency string, amount long")
    money = F.col("amount").cast("decimal(38,2)")
    tables = (
        records,
        raw("publication_metadata", {"publication_id": "1", "language": "en"}),
        revenue.withColumn("amount", money),
        raw("publication_stats", {"publication_id": "1", "total_reactions": 3}),
        posts.withColumn("amount", money),
    )
    packed = facts.packed_publications(*tables)
    want = rows(facts.publication_fact(*tables))
    assert rows(facts.unpacked_publications(packed)) == want
    assert packed.count() < len(want)
