"""The registered queries: every product on the driver's tables.

Results use plain types so that another engine can show the same: money as DOUBLE
rounded to cents, timestamps as text. The products themselves keep exact decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.checks.roles import CREATORS, PROBED, load
from quillstat.functions.money import currency_label, token_amount
from quillstat.operators.joins import Ids, restrict_to
from quillstat.operators.rows import days
from quillstat.operators.skew import find_hot
from quillstat.plans import dimensions, facts, marts, stage
from quillstat.plans.refresh import refresh
from quillstat.schemas import INTERACTION, align
from quillstat.session import run_dir, tune
from quillstat.sources.sinks import export_times, import_times, write_files
from quillstat.sources.tables import Sources, read_product


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = F.round(column, 2).cast("double")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "double" and name in ("amount_USD", "revenue_USD"):
            column = F.round(column, 2)
        columns.append(column.alias(name))
    return df.select(*columns)


def date_dimension(src: Sources) -> DataFrame:
    span = src.publication_record.agg(
        F.to_date(F.min("block_timestamp")).alias("first"),
        F.to_date(F.max("block_timestamp")).alias("last"),
    )
    return days(span, F.col("first"), F.col("last"))


def creator_allowlist(src: Sources) -> DataFrame:
    spark = src.profile_record.sparkSession
    listed = restrict_to(src.profile_record, stage.allowlist(spark, CREATORS), "profile_id")
    return listed.select("profile_id", "owned_by", "is_burnt")


def fx_rates(src: Sources) -> DataFrame:
    return stage.currency_check(src.action_module)


def amount_scaling(src: Sources) -> DataFrame:
    return src.action_module.select(
        "publication_id",
        currency_label(F.col("currency")).alias("currency"),
        token_amount(F.col("currency"), F.col("amount")).alias("amount"),
    )


def revenue_v2(src: Sources) -> DataFrame:
    return stage.revenue_v2(src.action_module)


def latest_profile_metadata(src: Sources) -> DataFrame:
    return dimensions.latest_metadata(src.profile_metadata)


def top_profile_per_owner(src: Sources) -> DataFrame:
    return stage.top_profile_per_owner(src.profile_v1, src.profile_stats_v1).select(
        "owned_by", "profile_id", "handle"
    )


def collect_ledger_v1(src: Sources) -> DataFrame:
    return export_times(facts.ledger_of(src))


def revenue_v1(src: Sources) -> DataFrame:
    return stage.revenue_v1_from_raw(src.post_v1, src.collect_module_v1, src.collect_record_v1)


def profile_dimension(src: Sources) -> DataFrame:
    return profiles_of(src, None)


def profiles_of(src: Sources, ids: Ids | None) -> DataFrame:
    """The profile dimension, of all profiles or of those in ``ids``."""
    return dimensions.profile_dimension(
        restrict_to(src.profile_record, ids, "profile_id"),
        src.profile_metadata,
        src.profile_last_logged_in,
        src.profile_stats,
        src.follower_stats,
        src.profile_quality,
    )


def publication_fact(src: Sources) -> DataFrame:
    return facts.publications_of(src)


def interaction_follow(src: Sources) -> DataFrame:
    return align(facts.follows(src.follower), INTERACTION)


def interaction_derivative(src: Sources) -> DataFrame:
    owners = facts.owners_of(src.publication_record)
    rows = facts.derivatives(src.publication_record, src.publication_metadata, owners)
    return align(rows, INTERACTION)


def interaction_collect_v2(src: Sources) -> DataFrame:
    owners = facts.owners_of(src.publication_record)
    rows = facts.collects_v2(src.acted_record, owners, src.action_module, revenue_v2(src))
    return align(rows, INTERACTION)


def interaction_collect_v1(src: Sources) -> DataFrame:
    return align(facts.collects_v1(collect_ledger_v1(src)), INTERACTION)


def interaction_reaction(src: Sources) -> DataFrame:
    owners = facts.owners_of(src.publication_record)
    return align(facts.reactions(src.reaction, owners), INTERACTION)


def interaction_mention(src: Sources) -> DataFrame:
    rows = facts.mentions(src.mention, src.publication_record, src.publication_metadata)
    return align(rows, INTERACTION)


def interaction_log(src: Sources) -> DataFrame:
    return facts.interactions_of(src, hot=find_hot(facts.log_joins(src)))


def interaction_log_partitioned(src: Sources) -> DataFrame:
    spark = src.publication_record.sparkSession
    path = run_dir(spark, "L2_interaction")
    packed = facts.interactions_of(src, packed=True)
    write_files(packed, path, "interaction_date_year_month", unpack=facts.unpacked_interactions)
    return read_product(spark, path, "L2_interaction")


def micros_roundtrip(src: Sources) -> DataFrame:
    spark = src.collect_record_v1.sparkSession
    records = src.collect_record_v1.select("referral_id", "block_timestamp")
    path = write_files(export_times(records), run_dir(spark, "collect_record_hop"))
    return import_times(spark.read.parquet(path), ["block_timestamp"])


def creator_publications(src: Sources) -> DataFrame:
    return facts.publications_of(src, CREATORS)


def creator_interactions(src: Sources) -> DataFrame:
    return facts.interactions_of(src, CREATORS)


def profile_check(src: Sources) -> DataFrame:
    return dimensions.profile_check(profile_dimension(src))


def collect_v2_staged_apart(src: Sources) -> DataFrame:
    """Revenue staged from other rows than the modules are: each may be missing alone."""
    number = F.col("publication_id").cast("bigint") + 3
    staged = src.action_module.withColumn("publication_id", number.cast("string"))
    owners = facts.owners_of(src.publication_record)
    rows = facts.collects_v2(src.acted_record, owners, src.action_module, stage.revenue_v2(staged))
    return align(rows, INTERACTION)


def written(df: DataFrame, name: str) -> DataFrame:
    """A product written to the shared folder and read back, as the marts get it."""
    path = write_files(df, run_dir(df.sparkSession, name))
    return read_product(df.sparkSession, path, name)


def refreshed_interactions_by_month(src: Sources) -> DataFrame:
    """A mart as the full refresh leaves it."""
    spark = src.publication_record.sparkSession
    done = refresh(spark, src, run_dir(spark, "refresh"), CREATORS, history=PROBED)
    return done["L3_interaction_year_month"]


def profile_mart(src: Sources) -> DataFrame:
    return marts.profile_mart(profile_dimension(src))


def interactions_by_month(src: Sources) -> DataFrame:
    return marts.interactions_by_month(written(creator_interactions(src), "L3_interaction"))


def publications_by_month(src: Sources) -> DataFrame:
    # Three columns of the records are read, without the joins of the rest.
    return marts.publications_by_month(creator_publications(src))


def user_analysis(src: Sources) -> DataFrame:
    interactions = written(creator_interactions(src), "L3_interaction")
    # Only the acting users are looked up, so only theirs are built.
    acting = interactions.select("interaction_profile_id")
    return marts.user_analysis(interactions, profiles_of(src, acting))


def interaction_weekday_hour(src: Sources) -> DataFrame:
    return marts.interaction_weekday_hour(written(creator_interactions(src), "L3_interaction"))


def interactions_by_age(src: Sources) -> DataFrame:
    # Of the publications only ids and dates are read, without the joins of the rest.
    interactions = written(creator_interactions(src), "L3_interaction")
    return marts.interactions_by_age(interactions, creator_publications(src))


def handle_history(src: Sources) -> DataFrame:
    """All profiles."""
    tables = (src.ownership_history, src.handle_history, src.profile_record)
    hot = find_hot(dimensions.history_joins(*tables))
    return dimensions.handle_history(*tables, None, hot)


def handle_history_probe(src: Sources) -> DataFrame:
    """The operator's own list of profiles, sorted; flags are relative to these."""
    tables = (src.ownership_history, src.handle_history, src.profile_record)
    return dimensions.sorted_history(*tables, PROBED)


_QUERIES = (
    date_dimension,
    creator_allowlist,
    fx_rates,
    amount_scaling,
    revenue_v2,
    latest_profile_metadata,
    top_profile_per_owner,
    collect_ledger_v1,
    revenue_v1,
    profile_dimension,
    publication_fact,
    interaction_follow,
    interaction_derivative,
    interaction_collect_v2,
    collect_v2_staged_apart,
    interaction_collect_v1,
    interaction_reaction,
    interaction_mention,
    interaction_log,
    interaction_log_partitioned,
    micros_roundtrip,
    creator_publications,
    creator_interactions,
    profile_check,
    profile_mart,
    interactions_by_month,
    refreshed_interactions_by_month,
    publications_by_month,
    user_analysis,
    interaction_weekday_hour,
    interactions_by_age,
    handle_history,
    handle_history_probe,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Sources], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(query(load(tune(spark), sf_dir)))

    return {query.__name__: bind(query) for query in _QUERIES}
