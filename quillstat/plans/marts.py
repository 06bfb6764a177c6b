"""Creator marts. Each takes products that are already limited to the creators.

Counts of users are exact. Spark plans them as a distinct on group and user
before the count per group, so a group with very many rows is spread by user.
Labels are formatted after grouping, once per group instead of once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.functions.calendar import hour_of, month_start, weekday_label, year_month
from quillstat.functions.labels import engagement_points, value_tier
from quillstat.operators.joins import Ids, lookup, restrict_to
from quillstat.operators.skew import NONE, Hot
from quillstat.schemas import PRODUCTS, align


def of_creators(product: DataFrame, creators: Ids) -> DataFrame:
    """Rows of the listed creators, from a written product."""
    return restrict_to(product, creators, "profile_id")


def profile_mart(profiles: DataFrame) -> DataFrame:
    """All profiles: the marts look up acting users, who may be anyone."""
    return profiles


def interactions_by_month(interactions: DataFrame) -> DataFrame:
    month = month_start(F.col("interaction_date")).alias("month")
    rollup = interactions.groupBy("profile_id", month, "interaction_type").agg(*_measures())
    labelled = rollup.withColumn("year_month", year_month(F.col("month")))
    return align(labelled, PRODUCTS["L3_interaction_year_month"])


def publications_by_month(publications: DataFrame) -> DataFrame:
    month = month_start(F.col("publication_date")).alias("month")
    rollup = publications.groupBy("profile_id", month, "publication_type").agg(
        F.count(F.lit(1)).alias("number_publication")
    )
    labelled = rollup.withColumn("year_month", year_month(F.col("month")))
    return align(labelled, PRODUCTS["L3_publication_year_month"])


def user_analysis(interactions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per acting user, creator and value tier: dates, score and revenue.

    ``number_interaction`` counts distinct types, as in the source system. Users
    without a name are left out. Interactions are reduced to one row per user,
    creator and type before names are joined, so a busy user meets the profiles
    once per creator and type. A name listed n times for a profile counts n times,
    which is what joining the single rows would give.
    """
    per_type = (
        interactions.filter(F.col("interaction_profile_id").isNotNull())
        .groupBy(F.col("interaction_profile_id").alias("user_id"), "profile_id", "interaction_type")
        .agg(
            F.min("interaction_date").alias("first_date"),
            F.max("interaction_date").alias("last_date"),
            F.count(F.lit(1)).alias("interactions"),
            F.sum("amount_USD").alias("usd"),
        )
    )
    names = (
        profiles.filter(F.col("profile_name").isNotNull())
        .groupBy(F.col("profile_id").alias("named_id"), "profile_name")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    kind, copies = F.col("interaction_type"), F.col("copies")
    scored = per_type.join(names, F.col("user_id") == F.col("named_id"))
    rollup = scored.groupBy(
        "user_id", "profile_name", "profile_id", value_tier(kind).alias("interaction_category")
    ).agg(
        F.min("first_date").alias("first_interaction_date"),
        F.max("last_date").alias("last_interaction_date"),
        F.count("interaction_type").alias("number_interaction"),
        F.sum(engagement_points(kind) * F.col("interactions") * copies).alias("user_score"),
        F.sum(F.col("usd") * copies.cast("decimal(20,0)")).alias("amount_USD"),
    )
    return align(rollup, PRODUCTS["L3_user_analysis"])


def interaction_weekday_hour(interactions: DataFrame) -> DataFrame:
    rollup = interactions.groupBy(
        "profile_id",
        "interaction_type",
        F.weekday("interaction_date").alias("weekday"),
        hour_of(F.col("interaction_time")).alias("hour"),
    ).agg(*_measures())
    labelled = rollup.withColumn("weekday", weekday_label(F.col("weekday")))
    return align(labelled, PRODUCTS["L3_interaction_weekday_hour"])


def interactions_by_age(
    interactions: DataFrame, publications: DataFrame, hot: Hot = NONE
) -> DataFrame:
    """Interactions by days since the publication appeared.

    Follows and mentions have no publication, hence no age, and meet no date.
    """
    dates = publications.select(
        F.col("publication_id").alias("dated_id"), "publication_date"
    ).distinct()
    needed = interactions.select(
        "profile_id",
        "publication_id",
        "interaction_type",
        "interaction_date",
        "interaction_profile_id",
        "amount_USD",
    )
    dated = lookup(needed, dates, "publication_id", "dated_id", hot, null_keys=True)
    age = F.datediff("interaction_date", "publication_date").alias("day_since_creation")
    rollup = dated.groupBy("profile_id", "publication_id", "interaction_type", age).agg(
        *_measures()
    )
    return align(rollup, PRODUCTS["L3_publication_analysis"])


def _measures() -> list[Column]:
    return [
        F.count_distinct("interaction_profile_id").alias("number_user"),
        F.count(F.lit(1)).alias("number_interaction"),
        F.sum("amount_USD").alias("revenue_USD"),
    ]
