"""Date and profile dimensions, and the ownership history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.fixed_values import FIRST_DAY, HISTORY_PROFILES, LAST_DAY
from quillstat.functions.calendar import time_text
from quillstat.operators.joins import Ids, fan_out, lookup, pair, restrict_to
from quillstat.operators.ranking import first_by, not_first
from quillstat.operators.rows import days
from quillstat.operators.skew import NO_HOT, NONE, Hot, Sides
from quillstat.schemas import PRODUCTS, PROFILE, align, struct


def date_dimension(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    return days(spark.range(1), F.lit(first).cast("date"), F.lit(last).cast("date"))


def latest_metadata(metadata: DataFrame) -> DataFrame:
    """Per profile the name set last; equal times go to the higher name."""
    order = [F.col("block_timestamp").desc_nulls_last(), F.col("name").desc_nulls_last()]
    return first_by(metadata, "profile_id", order).select("profile_id", "name")


def profile_dimension(
    records: DataFrame,
    metadata: DataFrame,
    logins: DataFrame,
    stats: DataFrame,
    followers: DataFrame,
    quality: DataFrame,
) -> DataFrame:
    """One row per distinct set of profile attributes, with the last login.

    Logins are reduced to one row per profile before the join. All joins are on
    the profile, so the records are shuffled once, and the final ``distinct``,
    whose keys include it, not at all.
    """
    last_login = logins.groupBy(F.col("profile_id").alias("login_id")).agg(
        F.max("last_logged_in").alias("last_logged_in")
    )
    wide = records.select(
        "profile_id",
        F.col("owned_by").alias("profile_address"),
        F.col("is_burnt").alias("profile_burnt_flag"),
        F.to_date("block_timestamp").alias("profile_creation_date"),
    )
    sides = {
        "metadata_id": latest_metadata(metadata).select(
            F.col("profile_id").alias("metadata_id"), F.col("name").alias("profile_name")
        ),
        "login_id": last_login,
        "stats_id": _prefixed(stats, "stats_id"),
        "followers_id": _prefixed(followers, "followers_id"),
        "quality_id": quality.select(F.col("profile_id").alias("quality_id"), "score"),
    }
    for key, side in sides.items():
        wide = lookup(wide, side, "profile_id", key)
    wide = wide.withColumn("profile_last_logged_in_date", F.to_date("last_logged_in")).withColumn(
        "profile_last_logged_in_time", time_text(F.col("last_logged_in"))
    )
    return align(wide, PROFILE).distinct()


def profile_check(profiles: DataFrame) -> DataFrame:
    """Rows, profiles, and profiles that the dimension lists more than once."""
    copies = profiles.groupBy("profile_id").agg(F.count(F.lit(1)).alias("copies"))
    checked = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("number_row"),
        F.count(F.lit(1)).alias("number_profile"),
        F.count_if(F.col("copies") > 1).alias("number_repeated"),
    )
    return align(checked, PRODUCTS["profile_check"])


def _prefixed(stats: DataFrame, key: str) -> DataFrame:
    """``total_posts`` becomes ``profile_posts`` and so on."""
    totals = [c for c in stats.columns if c.startswith("total_")]
    return stats.select(
        F.col("profile_id").alias(key),
        *[F.col(c).alias(c.replace("total_", "profile_", 1)) for c in totals],
    )


def handle_rows(
    ownership: DataFrame,
    handles: DataFrame,
    records: DataFrame,
    profiles: Ids | None = HISTORY_PROFILES,
    hot: Mapping[str, Hot] = NO_HOT,
) -> DataFrame:
    """Owners a profile had, the handles and profiles of these wallets, and
    whether the row is a later one of its profile or of its handle.

    Only the chosen profiles (``None``: all) take part in the flags. The flag
    names follow the source system: ``profile_changed_flag`` numbers the rows of a
    profile, ``address_changed_flag`` those of a handle. A missing handle counts
    as one handle. A wallet may own many handles and many profiles; all
    combinations are kept, and made once: as rows are numbered by owner, then handle,
    then record, which row of the product is a first one follows from the first rows of
    each side, found before the product is made.
    """
    owners = (
        restrict_to(ownership, profiles, "profile_id")
        .groupBy("profile_id", F.col("owned_by").alias("ownership_owner"))
        .agg(F.max("block_timestamp").alias("block_timestamp"))
    )
    wallets = owners.groupBy(F.col("ownership_owner").alias("slot_owner")).agg(
        F.min(F.struct("block_timestamp", "profile_id")).alias("seen")
    )
    held_by = hot.get("handles", NONE)
    slots = _slots(handles, wallets, held_by)
    with_handles = slots.filter(F.col("handle_owner").isNotNull()).select("handle_owner").distinct()
    kept = records.select(
        F.col("owned_by").alias("record_owner"), F.col("profile_id").alias("profile_record_id")
    ).join(with_handles, F.col("record_owner") == F.col("handle_owner"), "left_semi")
    kept = not_first(kept, {"later_record": ("record_owner", ("profile_record_id",))})
    by_time = ("block_timestamp", "ownership_owner")
    owners = not_first(owners, {"later_owner": ("profile_id", by_time)}, unique=True)
    # Wallets without handles have no records here, so they need no check against them.
    held = fan_out(slots, kept, "slot_owner", "record_owner", held_by)
    owned = pair(owners, held, "ownership_owner", "slot_owner", hot.get("owners", NONE))
    # At most one row, that of the missing wallet; it has neither handles nor records.
    nowhere = slots.filter(F.col("slot_owner").isNull())
    same = F.col("ownership_owner").eqNullSafe(F.col("slot_owner"))
    astray = owners.filter(F.col("ownership_owner").isNull()).join(F.broadcast(nowhere), same)
    rows = owned.unionByName(astray, allowMissingColumns=True)
    later_record = F.coalesce("later_record", F.lit(False))
    later_profile = F.struct("block_timestamp", "profile_id") != F.col("seen")
    return rows.select(
        "profile_id",
        "ownership_owner",
        "block_timestamp",
        "handle_owner",
        "handle",
        "handle_time",
        "record_owner",
        "profile_record_id",
        (F.col("later_owner") | F.col("later_slot") | later_record).alias("profile_changed_flag"),
        (later_profile | F.col("later_handle") | later_record).alias("address_changed_flag"),
    )


def _slots(handles: DataFrame, wallets: DataFrame, hot: Hot) -> DataFrame:
    """The handles of the wallets that owners have, an empty one for wallets without, each with
    the first owner row that its wallet was ``seen`` in.

    ``later_slot`` is false on the first of each wallet, ``later_handle`` on the one that the
    first row of each handle is made of: of the wallets with it, that whose first owner row
    is first.
    """
    listed = handles.select(
        F.col("owned_by").alias("handle_owner"), "handle", F.col("block_timestamp").alias("handle_time")
    ).filter(F.col("handle_owner").isNotNull())
    found = lookup(listed, wallets, "handle_owner", "slot_owner", hot)
    having = listed.select("handle_owner").distinct()
    empty = wallets.join(having, F.col("slot_owner") == F.col("handle_owner"), "left_anti")
    slots = found.filter(F.col("slot_owner").isNotNull()).unionByName(empty, allowMissingColumns=True)
    flags = {
        "later_handle": ("handle", ("seen", "slot_owner", "handle_time")),
        "later_slot": ("slot_owner", ("handle", "handle_time")),
    }
    return not_first(slots, flags)


def handle_history(*args, **kwargs) -> DataFrame:
    """The rows of ``handle_rows`` as a product. A stored table has no order."""
    return align(handle_rows(*args, **kwargs), PRODUCTS["handle_history"])


def sorted_history(*args, **kwargs) -> DataFrame:
    """The rows of ``handle_rows`` and their ``handle_time`` in reading order."""
    rows = handle_rows(*args, **kwargs)
    columns = [*struct(PRODUCTS["handle_history"]).names, "handle_time"]
    ordered = rows.orderBy("profile_id", "handle", F.desc("handle_time"))
    return ordered.select(*columns)


def history_joins(ownership: DataFrame, handles: DataFrame, records: DataFrame) -> dict[str, Sides]:
    """The history's joins in which a wallet may be hot."""
    return {
        "handles": [(handles, "owned_by"), (records, "owned_by")],
        "owners": [(ownership, "owned_by"), (handles, "owned_by"), (records, "owned_by")],
    }
