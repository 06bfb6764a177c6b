"""Schemas of the raw tables and of the tables the pipelines produce.

A spec is ``"name type, name type, ..."`` as Spark DDL. Times of day are text
``HH:mm:ss.SSSSSS`` because Spark 4.1 cannot cast a timestamp to TIME; the text
sorts in time order.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = "decimal(38,2)"  # token amounts after scaling
USD = "decimal(38,6)"  # a MONEY amount times a decimal(18,6) rate

# Columns of the raw tables.
RAW_V1 = {
    "post_v1": "profile_id string, post_id string, block_timestamp timestamp_ntz",
    "collect_module_v1": (
        "publication_id string, currency string, amount string, referral_fee double"
    ),
    "collect_record_v1": (
        "publication_id string, block_timestamp timestamp_ntz, collected_by string,"
        " referral_id string"
    ),
    "profile_v1": "profile_id string, owned_by string, handle string",
    "profile_stats_v1": "profile_id string, total_collects bigint",
}

RAW_V2 = {
    "profile_record": (
        "profile_id string, owned_by string, is_burnt boolean, block_timestamp timestamp_ntz"
    ),
    "profile_metadata": "profile_id string, name string, block_timestamp timestamp_ntz",
    "profile_last_logged_in": "profile_id string, last_logged_in timestamp_ntz",
    "profile_stats": (
        "profile_id string, total_posts bigint, total_comments bigint, total_mirrors bigint,"
        " total_quotes bigint, total_publications bigint, total_reacted bigint,"
        " total_reactions bigint, total_collects bigint, total_acted bigint"
    ),
    "follower_stats": "profile_id string, total_followers bigint, total_following bigint",
    "profile_quality": "profile_id string, score double",
    "publication_record": (
        "publication_id string, profile_id string, publication_type string,"
        " parent_publication_id string, app string, is_hidden boolean, is_momoka boolean,"
        " gardener_flagged boolean, block_timestamp timestamp_ntz"
    ),
    "publication_metadata": (
        "publication_id string, language string, content_warning string,"
        " main_content_focus string, tags_vector string, is_encrypted boolean"
    ),
    "publication_stats": (
        "publication_id string, total_amount_of_collects bigint, total_amount_of_mirrors bigint,"
        " total_amount_of_comments bigint, total_amount_of_quotes bigint, total_reactions bigint,"
        " total_bookmarks bigint, total_amount_of_acted bigint,"
        " total_amount_of_comments_gardeners bigint"
    ),
    "action_module": "publication_id string, currency string, amount string",
    "acted_record": (
        "publication_id string, acted_profile_id string, is_collect boolean,"
        " block_timestamp timestamp_ntz"
    ),
    "follower": "profile_id string, profile_follower_id string, block_timestamp timestamp_ntz",
    "reaction": (
        "publication_id string, actioned_by_profile_id string, app string, type string,"
        " action_at timestamp_ntz"
    ),
    "mention": "profile_id string, publication_id string, timestamp timestamp_ntz",
    "ownership_history": "profile_id string, owned_by string, block_timestamp timestamp_ntz",
    "handle_history": "owned_by string, handle string, block_timestamp timestamp_ntz",
}

RAW = {**RAW_V1, **RAW_V2}

# Names and columns of the products, in their order. The spelling of
# publication_total_reactios is one of them.
INTERACTION = (
    "publication_id string, profile_id string, interaction_date date, interaction_time string,"
    " interaction_profile_id string, interaction_publication_id string, interaction_app string,"
    f" interaction_language string, interaction_type string, amount_USD {USD}"
)
INTERACTION_LOG = INTERACTION + ", interaction_date_year_month date"
# The log before its largest shuffle: a timestamp for date and time, and a number of equal rows.
COPIES = "_copies"
PACKED = f"_at timestamp_ntz, {COPIES} bigint"
_UNDATED = INTERACTION.replace(" interaction_date date, interaction_time string,", "")
PACKED_INTERACTION = f"{_UNDATED}, {PACKED}"
PACKED_LOG = f"{PACKED_INTERACTION}, interaction_date_year_month date"

PROFILE = (
    "profile_id string, profile_name string, profile_address string, profile_burnt_flag boolean,"
    " profile_last_logged_in_date date, profile_last_logged_in_time string,"
    " profile_creation_date date, profile_posts bigint, profile_comments bigint,"
    " profile_mirrors bigint, profile_quotes bigint, profile_publications bigint,"
    " profile_reacted bigint, profile_reactions bigint, profile_collects bigint,"
    " profile_acted bigint, profile_followers bigint, profile_following bigint, score double"
)

PUBLICATION = (
    "publication_id string, profile_id string, publication_type string,"
    " publication_hidden_flag boolean, publication_momoka_flag boolean,"
    " publication_gardener_flagged_flag boolean, publication_app string,"
    " publication_language string, publication_content_warning string,"
    " publication_main_content_focus string, publication_tags_vector string,"
    " publication_encryption_flag boolean, publication_currency string,"
    f" publication_revenue {MONEY}, publication_date date, publication_time string,"
    " publication_total_collects bigint, publication_total_mirrors bigint,"
    " publication_total_comments bigint, publication_total_quotes bigint,"
    " publication_total_reactios bigint, publication_total_bookmarks bigint,"
    " publication_total_acted bigint, publication_total_comments_gardeners bigint,"
    " publication_date_year_month date"
)
PACKED_PUBLICATION = (
    PUBLICATION.replace(" publication_date date, publication_time string,", "") + f", {PACKED}"
)

# The ledger crosses a storage hop that keeps timestamps as integer microseconds.
COLLECT_LEDGER = (
    "profile_id string, post_id string, publication_date timestamp_ntz,"
    " collect_date timestamp_ntz, profile_id_collected string, collected_by string,"
    f" currency string, amount {MONEY}, referral_fee_pct double, referral_id string"
)
COLLECT_LEDGER_HOP = COLLECT_LEDGER.replace("timestamp_ntz", "bigint")

PRODUCTS = {
    "md_allowlist": "profile_id string",
    "publication_collect": COLLECT_LEDGER,
    "stage_v1_publication_collect": COLLECT_LEDGER_HOP,
    "stage_currency_exchange": (
        "currency_address string, currency string, value decimal(18,6), factor bigint"
    ),
    "stage_v2_publication_collect": (
        f"publication_id string, currency string, amount {MONEY}, amount_USD {USD}"
    ),
    # Products of our own: what was set aside, and checks of what was built.
    "quarantined_amount": (
        "raw_table string, publication_id string, currency string, amount string"
    ),
    "currency_check": (
        "currency string, modules bigint, rate decimal(18,6), rate_known boolean"
    ),
    "profile_check": "number_row bigint, number_profile bigint, number_repeated bigint",
    "L2_date": "date date",
    "L2_profile": PROFILE,
    "L2_publication": PUBLICATION,
    "L2_interaction": INTERACTION_LOG,
    "handle_history": (
        "profile_id string, profile_record_id string, ownership_owner string, handle_owner string,"
        " record_owner string, handle string, block_timestamp timestamp_ntz,"
        " profile_changed_flag boolean, address_changed_flag boolean"
    ),
    "L3_publication": PUBLICATION,
    "L3_interaction": INTERACTION_LOG,
    "L3_profile": PROFILE,
    "L3_interaction_year_month": (
        "profile_id string, year_month string, interaction_type string, number_user bigint,"
        " number_interaction bigint, revenue_USD double"
    ),
    "L3_publication_year_month": (
        "profile_id string, year_month string, publication_type string, number_publication bigint"
    ),
    "L3_user_analysis": (
        "user_id string, profile_name string, profile_id string, first_interaction_date date,"
        " last_interaction_date date, number_interaction bigint, interaction_category string,"
        " user_score bigint, amount_USD double"
    ),
    "L3_interaction_weekday_hour": (
        "profile_id string, interaction_type string, weekday string, hour int,"
        " number_user bigint, number_interaction bigint, revenue_USD double"
    ),
    "L3_publication_analysis": (
        "profile_id string, publication_id string, interaction_type string,"
        " day_since_creation int, number_user bigint, number_interaction bigint,"
        " revenue_USD double"
    ),
}


@cache
def struct(spec: str) -> T.StructType:
    return T.StructType.fromDDL(spec)


def align(df: DataFrame, spec: str) -> DataFrame:
    """Select the columns of ``spec`` in its order, each with its type.

    Every branch of a union and every product passes through here, so that a
    column never gets its type from whatever it happens to be unioned with:
    Spark would widen decimal(38,6) with decimal(38,0) to decimal(38,0) and drop
    the cents without an error.
    """
    return df.to(struct(spec))


def check(df: DataFrame, spec: str) -> DataFrame:
    """Fail before a job starts if names, order or types differ from ``spec``."""
    want = [(f.name, f.dataType) for f in struct(spec)]
    have = [(f.name, f.dataType) for f in df.schema]
    if want != have:
        raise ValueError(f"schema is {have}, expected {want}")
    return df
