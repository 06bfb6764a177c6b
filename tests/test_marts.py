from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quillstat.functions.calendar import from_micros, time_text, to_micros, weekday_label
from quillstat.plans import marts
from quillstat.operators.skew import Hot, Parts
from quillstat.schemas import INTERACTION_LOG, PRODUCTS, PROFILE, PUBLICATION, check, struct

D17, D10 = dt.date(2024, 3, 17), dt.date(2024, 3, 10)


@pytest.fixture
def table(spark):
    def make(spec, *dicts):
        schema = struct(spec)
        return spark.createDataFrame([tuple(d.get(c) for c in schema.names) for d in dicts], schema)

    return make


def act(kind, user="u", creator="c", date=D17, usd=None, publication=None, time="10:30:00.000000"):
    return {
        "profile_id": creator,
        "interaction_profile_id": user,
        "interaction_type": kind,
        "interaction_date": date,
        "interaction_time": time,
        "publication_id": publication,
        "amount_USD": None if usd is None else Decimal(usd),
    }


@pytest.mark.parametrize(
    ("day", "label"),
    [(17, "7-Sunday"), (18, "1-Monday"), (19, "2-Tuesday"), (20, "3-Wednesday")]
    + [(21, "4-Thursday"), (22, "5-Friday"), (23, "6-Saturday")],
)
def test_weekday(spark, day, label):
    df = spark.createDataFrame([(dt.date(2024, 3, day),)], "d date")
    assert df.select(weekday_label(F.weekday("d"))).first()[0] == label


def test_micros(spark):
    df = spark.createDataFrame([(1700000000123456,)], "us bigint")
    back = df.select(from_micros(F.col("us")).alias("t"), "us")
    row = back.select(time_text(F.col("t")), to_micros(F.col("t")), "t").first()
    assert row[0] == "22:13:20.123456"
    assert row[1] == 1700000000123456
    assert row[2] == dt.datetime(2023, 11, 14, 22, 13, 20, 123456)


def test_user_analysis(table):
    interactions = table(
        INTERACTION_LOG,
        *[act("COMMENT", usd="0.25")] * 3,
        act("QUOTE", date=D10, usd="0.50"),
        act("UPVOTE"),
        act("MENTION"),
        act(None, usd="7"),
        act("DOWNVOTE", user="v"),
        act("FOLLOW", user="nameless"),
        act("FOLLOW", user=None),
    )
    profiles = table(
        PROFILE,
        {"profile_id": "u", "profile_name": "U"},
        {"profile_id": "v", "profile_name": "V"},
        {"profile_id": "nameless"},
    )
    got = marts.user_analysis(interactions, profiles)
    check(got, PRODUCTS["L3_user_analysis"])
    assert rows(got) == sorted(
        [
            ("u", "U", "c", D10, D17, 2, "high_value", 225, 1.25),
            ("u", "U", "c", D17, D17, 2, "low_value", 30, 7.0),
            ("v", "V", "c", D17, D17, 1, "low_value", 0, None),
        ],
        key=repr,
    )


def test_a_repeated_profile_multiplies_sums(table):
    interactions = table(INTERACTION_LOG, act("COMMENT", usd="1"), act("COMMENT", usd="1"))
    profile = {"profile_id": "u", "profile_name": "U"}
    got = marts.user_analysis(
        interactions, table(PROFILE, profile, {**profile, "profile_posts": 1}, {**profile, "profile_name": "W"})
    )
    chosen = rows(got, "profile_name", "number_interaction", "user_score", "amount_USD")
    assert chosen == [("U", 1, 240, 4.0), ("W", 1, 120, 2.0)]


def test_monthly_and_hourly_rollups_count_everything_once(table):
    interactions = table(
        INTERACTION_LOG,
        act("COMMENT", usd="0.1"),
        act("COMMENT", usd="0.2"),
        act("COMMENT", user="v", date=dt.date(2024, 4, 1), time="23:59:59.999999"),
        act(None, user=None),
    )
    month = marts.interactions_by_month(interactions)
    check(month, PRODUCTS["L3_interaction_year_month"])
    assert rows(month) == sorted(
        [
            ("c", "2024-03", "COMMENT", 1, 2, 0.3),
            ("c", "2024-04", "COMMENT", 1, 1, None),
            ("c", "2024-03", None, 0, 1, None),
        ],
        key=repr,
    )
    hour = marts.interaction_weekday_hour(interactions)
    check(hour, PRODUCTS["L3_interaction_weekday_hour"])
    assert ("c", "COMMENT", "1-Monday", 23, 1, 1, None) in rows(hour)
    assert hour.agg(F.sum("number_interaction")).first()[0] == interactions.count()


@pytest.mark.parametrize("hot", [Hot(), Hot(Parts({"p": 8}))])
def test_age(table, hot):
    interactions = table(
        INTERACTION_LOG,
        act("COMMENT", publication="p"),
        act("COMMENT", publication="p", user="v"),
        act("FOLLOW"),
        act("UPVOTE", publication="undated"),
    )
    publications = table(
        PUBLICATION,
        {"publication_id": "p", "publication_date": D10, "publication_currency": "DAI"},
        {"publication_id": "p", "publication_date": D10, "publication_currency": "NCT"},
    )
    got = marts.interactions_by_age(interactions, publications, hot)
    check(got, PRODUCTS["L3_publication_analysis"])
    assert rows(got) == sorted(
        [
            ("c", "p", "COMMENT", 7, 2, 2, None),
            ("c", None, "FOLLOW", None, 1, 1, None),
            ("c", "undated", "UPVOTE", None, 1, 1, None),
        ],
        key=repr,
    )


def test_publications_by_month(table):
    got = marts.publications_by_month(
        table(
            PUBLICATION,
            {"profile_id": "c", "publication_type": "POST", "publication_date": D10},
            {"profile_id": "c", "publication_type": "POST", "publication_date": D17},
        )
    )
    check(got, PRODUCTS["L3_publication_year_month"])
    assert rows(got) == [("c", "2024-03", "POST", 2)]
