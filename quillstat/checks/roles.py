"""The driver's tables seen as the raw tables of the pipelines.

Every role uses every row of its table. Rows that must not match something (a
missing parent, a profile without metadata) get an id that does not exist.
``oracle.ROLES`` says the same in SQL.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.fixed_values import CURRENCIES
from quillstat.sources.tables import Sources

# The creators of the demo; profiles 0 to 99 write all publications.
CREATORS = tuple(str(i) for i in range(12))
# The profiles of the handle-history probe.
PROBED = ("1", "2", "3", "4")

_ADDRESS = {c.label: c.address for c in CURRENCIES}
# Return flag and line status of a line item stand for a currency; NF is unlisted.
CODES = {
    "AO": _ADDRESS["WETH"],
    "AF": _ADDRESS["NCT"],
    "RO": _ADDRESS["WMATIC"],
    "RF": _ADDRESS["DAI"],
    "NO": _ADDRESS["USDC"],
}


# Columns the roles use; declared, so that no job reads footers to infer them.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "part": "p_partkey bigint, p_brand string, p_size int",
    "documents": "doc_id bigint, lang string, source string, n_chars bigint",
}


def load(spark: SparkSession, sf_dir: str) -> Sources:
    @cache
    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    cust, order, line = F.col("c_custkey"), F.col("o_orderkey"), F.col("l_orderkey")
    event, user = F.col("event_id"), F.col("user_id")

    # A fifth of the customers has no statistics.
    statistics_id = F.when(cust % 5 == 0, F.concat(F.lit("x"), cust)).otherwise(_text(cust))

    code = F.concat("l_returnflag", "l_linestatus")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    noise = (F.col("l_partkey") % 10).cast("string")
    address = F.lit("0xunlisted")
    for key, listed in CODES.items():
        address = F.when(code == key, listed).otherwise(address)
    # Units of 10^-6 or 10^-18. The digit after the cents makes exact half-cent ties.
    amount = (
        F.when(code == "NF", cents)
        .when(code == "NO", F.concat(cents, noise, F.lit("0" * 3)))
        .otherwise(F.concat(cents, noise, F.lit("0" * 15)))
    )

    parent = (
        F.when(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), F.lit(None))
        .when(F.col("o_orderstatus") == "P", order + 1000000000)
        .otherwise(F.floor(order / 3))
    )
    kind = (
        F.when(F.col("o_orderpriority") == "2-HIGH", "COMMENT")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "MIRROR")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "QUOTE")
        .otherwise("POST")
    )
    collector = (
        F.when(user % 11 == 0, F.lit(None))
        .when(user % 5 == 0, F.concat(F.lit("u"), user))
        .otherwise(F.concat(F.lit("w"), user))
    )

    frames = {
        "post_v1": lambda: table("orders").select(
            _text(F.col("o_custkey") % 100).alias("profile_id"),
            _text(order).alias("post_id"),
            F.col("o_orderdate").alias("block_timestamp"),
        ),
        "collect_module_v1": lambda: table("lineitem").select(
            _text(line + 7).alias("publication_id"),
            address.alias("currency"),
            amount.alias("amount"),
            F.col("l_tax").alias("referral_fee"),
        ),
        "collect_record_v1": lambda: table("events").select(
            _text(F.floor(event / 2)).alias("publication_id"),
            F.col("ts").alias("block_timestamp"),
            collector.alias("collected_by"),
            _text(event).alias("referral_id"),
        ),
        "profile_v1": lambda: table("customer").select(
            _text(cust).alias("profile_id"),
            F.concat(F.lit("w"), F.floor(cust / 2)).alias("owned_by"),
            F.col("c_name").alias("handle"),
        ),
        "profile_stats_v1": lambda: table("customer").select(
            statistics_id.alias("profile_id"),
            F.when(F.col("c_mktsegment") != "BUILDING", F.floor("c_acctbal")).alias(
                "total_collects"
            ),
        ),
        "profile_record": lambda: table("customer").select(
            _text(cust).alias("profile_id"),
            F.concat(F.lit("w"), F.floor(cust / 2)).alias("owned_by"),
            (F.col("c_acctbal") < 0).alias("is_burnt"),
            _day("1995-01-01", cust % 700).alias("block_timestamp"),
        ),
        "profile_metadata": lambda: table("orders").select(
            F.when(F.col("o_custkey") % 7 == 0, F.concat(F.lit("x"), F.col("o_custkey")))
            .otherwise(_text(F.col("o_custkey")))
            .alias("profile_id"),
            F.when(
                order % 9 != 0, F.concat(F.col("o_orderpriority"), F.lit("#"), order)
            ).alias("name"),
            F.col("o_orderdate").alias("block_timestamp"),
        ),
        "profile_last_logged_in": lambda: table("events").select(
            _text(user).alias("profile_id"), F.col("ts").alias("last_logged_in")
        ),
        "profile_stats": lambda: table("customer").select(
            statistics_id.alias("profile_id"),
            *[
                (cust % n).alias(f"total_{name}")
                for name, n in [
                    ("posts", 101),
                    ("comments", 103),
                    ("mirrors", 107),
                    ("quotes", 109),
                    ("publications", 113),
                    ("reacted", 127),
                    ("reactions", 131),
                    ("collects", 137),
                    ("acted", 139),
                ]
            ],
        ),
        "follower_stats": lambda: table("customer").select(
            statistics_id.alias("profile_id"),
            (cust % 149).alias("total_followers"),
            (cust % 151).alias("total_following"),
        ),
        "profile_quality": lambda: table("customer").select(
            statistics_id.alias("profile_id"), (cust % 1000 / 8).alias("score")
        ),
        "publication_record": lambda: table("orders").select(
            _text(order).alias("publication_id"),
            _text(F.col("o_custkey") % 100).alias("profile_id"),
            kind.alias("publication_type"),
            _text(parent).alias("parent_publication_id"),
            F.col("o_orderstatus").alias("app"),
            (F.col("o_totalprice") < 50000).alias("is_hidden"),
            (order % 3 == 0).alias("is_momoka"),
            (order % 17 == 0).alias("gardener_flagged"),
            F.col("o_orderdate").alias("block_timestamp"),
        ),
        "publication_metadata": lambda: table("documents").select(
            _text(F.col("doc_id")).alias("publication_id"),
            F.col("lang").alias("language"),
            F.when(F.col("n_chars") >= 500, F.lit("LONG")).alias("content_warning"),
            F.col("source").alias("main_content_focus"),
            F.col("source").alias("tags_vector"),
            (F.col("n_chars") % 2 == 0).alias("is_encrypted"),
        ),
        "publication_stats": lambda: table("lineitem")
        .groupBy(_text(line).alias("publication_id"))
        .agg(
            F.count(F.lit(1)).alias("total_amount_of_collects"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("total_amount_of_mirrors"),
            F.max("l_linenumber").alias("total_amount_of_comments"),
            F.min("l_linenumber").alias("total_amount_of_quotes"),
            F.sum("l_suppkey").alias("total_reactions"),
            F.sum("l_partkey").alias("total_bookmarks"),
            F.max("l_suppkey").alias("total_amount_of_acted"),
            F.min("l_partkey").alias("total_amount_of_comments_gardeners"),
        ),
        "action_module": lambda: table("lineitem").select(
            _text(line).alias("publication_id"),
            address.alias("currency"),
            amount.alias("amount"),
        ),
        "acted_record": lambda: table("events").select(
            _text(event * 2).alias("publication_id"),
            _text(user).alias("acted_profile_id"),
            F.when(F.col("event_type") != "error", F.col("event_type").isin("purchase", "click"))
            .alias("is_collect"),
            F.col("ts").alias("block_timestamp"),
        ),
        "follower": lambda: table("events").select(
            _text(event % 100).alias("profile_id"),
            _text(user).alias("profile_follower_id"),
            F.col("ts").alias("block_timestamp"),
        ),
        "reaction": lambda: table("events").select(
            _text(event * 2).alias("publication_id"),
            _text(user).alias("actioned_by_profile_id"),
            F.col("event_type").alias("app"),
            F.when(F.col("event_type") == "error", "DOWNVOTE").otherwise("UPVOTE").alias("type"),
            F.col("ts").alias("action_at"),
        ),
        "mention": lambda: table("events").select(
            _text(event % 100).alias("profile_id"),
            _text(event * 2).alias("publication_id"),
            F.col("ts").alias("timestamp"),
        ),
        "ownership_history": lambda: table("lineitem").select(
            _text(F.col("l_suppkey")).alias("profile_id"),
            F.concat(F.lit("w"), F.col("l_partkey")).alias("owned_by"),
            F.col("l_shipdate").alias("block_timestamp"),
        ),
        "handle_history": lambda: table("part").select(
            F.concat(F.lit("w"), F.floor(F.col("p_partkey") / 3)).alias("owned_by"),
            F.concat(F.col("p_brand"), F.lit("#"), F.col("p_size")).alias("handle"),
            _day("2000-01-01", F.col("p_partkey") % 3000).alias("block_timestamp"),
        ),
    }
    return Sources(frames)


def _text(column: Column) -> Column:
    return column.cast("string")


def _day(first: str, offset: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), offset.cast("int")).cast("timestamp_ntz")
