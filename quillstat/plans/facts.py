"""Publication fact and the interaction log.

Both can be built for all profiles, or for some creators only. In the second case
the creators' publications are selected first and the big tables meet just these;
filtering the finished log would shuffle every table in full, because the creator
is known only after a left join.

Building a product starts no job. A caller that expects publications with very many
interactions measures them first (``log_joins`` with ``find_hot``) and passes them on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import wraps
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.fixed_values import CURRENCIES, Currency
from quillstat.functions.calendar import from_micros, month_start, time_text
from quillstat.functions.labels import FREE, PAID, paid_or_free
from quillstat.functions.money import currency_label, raw_amount, usd
from quillstat.operators.joins import Ids, fan_out, lookup, pair, restrict_to
from quillstat.operators.rows import at_most, repeated, union_as
from quillstat.operators.skew import NO_HOT, NONE, Hot, Sides
from quillstat.plans.stage import (
    collect_ledger,
    ledger_joins,
    revenue_v1_from_raw,
    revenue_v2,
    with_rate,
)
from quillstat.schemas import (
    COPIES,
    INTERACTION,
    INTERACTION_LOG,
    PACKED_INTERACTION,
    PACKED_LOG,
    PACKED_PUBLICATION,
    PUBLICATION,
    align,
)
from quillstat.sources.sinks import export_times
from quillstat.sources.tables import Sources

# Rows that stand for more are divided before they are shuffled.
MOST_COPIES = 10_000


def publication_fact(
    records: DataFrame,
    metadata: DataFrame,
    revenue: DataFrame,
    stats: DataFrame,
    first_revenue: DataFrame,
) -> DataFrame:
    """One row per publication and revenue currency.

    Currency and amount fall back to the first generation separately, as in the
    source system. All five tables meet on the publication id.
    """
    firsts = first_revenue.select(
        "post_id", F.col("currency").alias("currency_v1"), F.col("amount").alias("amount_v1")
    )
    wide = lookup(_described(records, metadata, revenue, stats), firsts, "publication_id", "post_id")
    return align(_named(wide), PUBLICATION)


def packed_publications(
    records: DataFrame,
    metadata: DataFrame,
    revenue: DataFrame,
    stats: DataFrame,
    first_revenue: DataFrame,
) -> DataFrame:
    """The publication fact before ``unpacked_publications``.

    A currency of the first generation repeats rows that have currency and amount without
    changing them, so these meet the first one only, and are counted.
    """
    by_post = Window.partitionBy("post_id").orderBy("currency")
    number = F.count(F.lit(1)).over(
        by_post.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    firsts = first_revenue.filter(F.col("post_id").isNotNull()).select(
        "post_id",
        F.col("currency").alias("currency_v1"),
        F.col("amount").alias("amount_v1"),
        number.alias("number_v1"),
        F.row_number().over(by_post).alias("rank_v1"),
    )
    described = _described(records, metadata, revenue, stats)
    lacking = F.col("currency").isNull() | F.col("amount").isNull()
    same = F.col("publication_id") == F.col("post_id")
    wide = described.join(firsts, same & (lacking | (F.col("rank_v1") == 1)), "left")
    copies = F.when(lacking, 1).otherwise(F.coalesce("number_v1", F.lit(1)))
    packed = _named(wide.withColumn(COPIES, copies).withColumn("_at", F.col("block_timestamp")))
    return align(packed, PACKED_PUBLICATION)


def unpacked_publications(packed: DataFrame) -> DataFrame:
    day, time = _when("_at", "publication")
    whole = repeated(packed.withColumns({"publication_date": day, "publication_time": time}), COPIES)
    return align(whole, PUBLICATION)


def _described(
    records: DataFrame, metadata: DataFrame, revenue: DataFrame, stats: DataFrame
) -> DataFrame:
    sides = {
        "metadata_id": metadata.withColumnRenamed("publication_id", "metadata_id"),
        "revenue_id": revenue.select(
            F.col("publication_id").alias("revenue_id"), "currency", "amount"
        ),
        "stats_id": stats.withColumnRenamed("publication_id", "stats_id"),
    }
    wide = records
    for key, side in sides.items():
        wide = lookup(wide, side, "publication_id", key)
    return wide


def _named(wide: DataFrame) -> DataFrame:
    """The columns of the fact, and those that a packed one has beside them."""
    day, time = _when("block_timestamp", "publication")
    return wide.select(
        "publication_id",
        "profile_id",
        "publication_type",
        F.col("is_hidden").alias("publication_hidden_flag"),
        F.col("is_momoka").alias("publication_momoka_flag"),
        F.col("gardener_flagged").alias("publication_gardener_flagged_flag"),
        F.col("app").alias("publication_app"),
        F.col("language").alias("publication_language"),
        F.col("content_warning").alias("publication_content_warning"),
        F.col("main_content_focus").alias("publication_main_content_focus"),
        F.col("tags_vector").alias("publication_tags_vector"),
        F.col("is_encrypted").alias("publication_encryption_flag"),
        F.coalesce("currency", "currency_v1").alias("publication_currency"),
        F.coalesce("amount", "amount_v1").alias("publication_revenue"),
        day,
        time,
        F.col("total_amount_of_collects").alias("publication_total_collects"),
        F.col("total_amount_of_mirrors").alias("publication_total_mirrors"),
        F.col("total_amount_of_comments").alias("publication_total_comments"),
        F.col("total_amount_of_quotes").alias("publication_total_quotes"),
        F.col("total_reactions").alias("publication_total_reactios"),
        F.col("total_bookmarks").alias("publication_total_bookmarks"),
        F.col("total_amount_of_acted").alias("publication_total_acted"),
        F.col("total_amount_of_comments_gardeners").alias("publication_total_comments_gardeners"),
        month_start(F.to_date("block_timestamp")).alias("publication_date_year_month"),
        *[c for c in ("_at", COPIES) if c in wide.columns],
    )


def publications_of(
    sources: Sources, creators: Ids | None = None, currencies: Sequence[Currency] = CURRENCIES
) -> DataFrame:
    """Publication fact from the raw tables, of all profiles or of ``creators``."""
    records = restrict_to(sources.publication_record, creators, "profile_id")
    ids = None if creators is None else records.select("publication_id")

    def of(table: DataFrame, key: str = "publication_id") -> DataFrame:
        return restrict_to(table, ids, key, few=True)

    return publication_fact(
        records,
        of(sources.publication_metadata),
        revenue_v2(of(sources.action_module), currencies),
        of(sources.publication_stats),
        revenue_v1_from_raw(
            of(sources.post_v1, "post_id"),
            of(sources.collect_module_v1),
            of(sources.collect_record_v1),
            currencies,
        ),
    )


def owners_of(records: DataFrame, creators: Ids | None = None) -> DataFrame:
    """Publication and its creator, the side all interactions are joined with.

    Every branch joins the same two columns, so Spark shuffles or broadcasts them
    once for all branches.
    """
    return restrict_to(records, creators, "profile_id").select(
        F.col("publication_id").alias("owned_id"), "profile_id"
    )


def _branch(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A kind of interactions in the columns of the log; ``packed`` is as ``make`` has it."""

    @wraps(make)
    def whole(*args, **kwargs) -> DataFrame:
        return _unpacked(_packed(make(*args, **kwargs)), INTERACTION)

    whole.packed = make
    return whole


def _packed(rows: DataFrame) -> DataFrame:
    """Rows of a branch that has no number of copies stand for themselves."""
    counted = rows if COPIES in rows.columns else rows.withColumn(COPIES, F.lit(1))
    return align(counted, PACKED_INTERACTION)


def _unpacked(packed: DataFrame, spec: str) -> DataFrame:
    day, time = _when("_at", "interaction")
    whole = repeated(packed.withColumns({"interaction_date": day, "interaction_time": time}), COPIES)
    return align(whole, spec)


@_branch
def follows(followers: DataFrame) -> DataFrame:
    return followers.select(
        _null("publication_id"),
        "profile_id",
        F.col("block_timestamp").alias("_at"),
        F.col("profile_follower_id").alias("interaction_profile_id"),
        _null("interaction_publication_id"),
        _null("interaction_app"),
        _null("interaction_language"),
        F.lit("FOLLOW").alias("interaction_type"),
        F.lit(0).alias("amount_USD"),
    )


@_branch
def derivatives(
    records: DataFrame,
    metadata: DataFrame,
    owners: DataFrame,
    only_owned: bool = False,
    hot: Hot = NONE,
) -> DataFrame:
    """Comments, mirrors and quotes, seen from the parent publication.

    A child whose parent is missing keeps its row without publication and profile.
    """
    children = _children(records)
    owned = _owned(children, owners, "parent_id", only_owned, hot)
    spoken = lookup(owned, _languages(metadata), "interaction_publication_id", "metadata_id")
    return spoken.select(
        F.col("owned_id").alias("publication_id"),
        "profile_id",
        F.col("block_timestamp").alias("_at"),
        "interaction_profile_id",
        "interaction_publication_id",
        "interaction_app",
        F.col("language").alias("interaction_language"),
        "interaction_type",
        F.lit(0).alias("amount_USD"),
    )


@_branch
def collects_v2(
    acted: DataFrame,
    owners: DataFrame,
    modules: DataFrame,
    revenue: DataFrame,
    only_owned: bool = False,
    hot: Mapping[str, Hot] = NO_HOT,
) -> DataFrame:
    """Acted records with the listed price of the publication.

    As in the source system a record appears once per module and revenue currency
    of its publication, and an act that is no collect keeps its row, without a
    type. Modules and revenue are looked up independently: a publication may be in
    one table and not in the other, where the revenue was staged earlier. Of its modules
    only the numbers of paid and free ones meet the acts; the rows are made of them at last.
    """
    price = F.coalesce(raw_amount(F.col("amount")), F.lit(0))
    terms = modules.groupBy(F.col("publication_id").alias("terms_id")).agg(
        F.count_if(price > 0).alias("paid"), F.count(F.lit(1)).alias("modules")
    )
    by_module = hot.get("modules", NONE)
    priced = lookup(
        _owned(acted, owners, "publication_id", only_owned, hot.get("acted", NONE)),
        terms,
        "publication_id",
        "terms_id",
        Hot(by_module.left),
    )
    # A publication's rows stand for its acts times its modules, on whichever side it is hot.
    valued = fan_out(
        priced,
        revenue.select(F.col("publication_id").alias("revenue_id"), "amount_USD"),
        "publication_id",
        "revenue_id",
        hot.get("revenue", NONE).after(by_module),
    )
    # A publication without modules has one row, which is free.
    modules_, paid = F.coalesce("modules", F.lit(1)), F.coalesce("paid", F.lit(0))
    no_kind = F.lit(None).cast("string")
    kinds = F.when(
        F.col("is_collect"), F.array(_kind(PAID, paid), _kind(FREE, modules_ - paid))
    ).otherwise(F.array(_kind(no_kind, modules_)))
    packed = valued.select(
        "publication_id",
        "profile_id",
        F.col("block_timestamp").alias("_at"),
        F.col("acted_profile_id").alias("interaction_profile_id"),
        _null("interaction_publication_id"),
        _null("interaction_app"),
        _null("interaction_language"),
        F.inline(F.filter(kinds, lambda kind: kind[COPIES] > 0)),
        "amount_USD",
    )
    return at_most(packed, COPIES, MOST_COPIES)


def _kind(name: Column | str, copies: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(name.alias("interaction_type"), copies.cast("bigint").alias(COPIES))


@_branch
def collects_v1(ledger: DataFrame, currencies: Sequence[Currency] = CURRENCIES) -> DataFrame:
    """Collects of the first-generation ledger as it is after the storage hop,
    with ``collect_date`` in microseconds."""
    collected = ledger.filter(F.col("collect_date").isNotNull()).withColumn(
        "collected_at", from_micros(F.col("collect_date"))
    )
    amount = F.coalesce(F.col("amount"), F.lit(0).cast("decimal(38,2)"))
    return with_rate(collected, currencies).select(
        F.col("post_id").alias("publication_id"),
        "profile_id",
        F.col("collected_at").alias("_at"),
        F.col("profile_id_collected").alias("interaction_profile_id"),
        _null("interaction_publication_id"),
        _null("interaction_app"),
        _null("interaction_language"),
        paid_or_free(amount).alias("interaction_type"),
        usd(amount, F.col("rate")).alias("amount_USD"),
    )


@_branch
def reactions(
    reacted: DataFrame, owners: DataFrame, only_owned: bool = False, hot: Hot = NONE
) -> DataFrame:
    return _owned(reacted, owners, "publication_id", only_owned, hot).select(
        "publication_id",
        "profile_id",
        F.col("action_at").alias("_at"),
        F.col("actioned_by_profile_id").alias("interaction_profile_id"),
        _null("interaction_publication_id"),
        F.col("app").alias("interaction_app"),
        _null("interaction_language"),
        F.col("type").alias("interaction_type"),
        F.lit(0).alias("amount_USD"),
    )


@_branch
def mentions(
    mentioned: DataFrame, records: DataFrame, metadata: DataFrame, hot: Hot = NONE
) -> DataFrame:
    """Mentions, seen from the mentioned profile.

    The language is that of the mentioning publication, if that is found. Authors
    meet their languages first, so the mentions are looked up once.
    """
    authors = lookup(
        records.select(
            F.col("publication_id").alias("author_id"),
            F.col("profile_id").alias("interaction_profile_id"),
            F.col("app").alias("interaction_app"),
        ),
        _languages(metadata),
        "author_id",
        "metadata_id",
    )
    spoken = lookup(
        mentioned.withColumnRenamed("publication_id", "mention_id"),
        authors,
        "mention_id",
        "author_id",
        hot,
        null_keys=True,
    )
    return spoken.select(
        _null("publication_id"),
        "profile_id",
        F.col("timestamp").alias("_at"),
        "interaction_profile_id",
        F.col("mention_id").alias("interaction_publication_id"),
        "interaction_app",
        F.col("language").alias("interaction_language"),
        F.lit("MENTION").alias("interaction_type"),
        F.lit(0).alias("amount_USD"),
    )


def interaction_log(branches: Sequence[DataFrame]) -> DataFrame:
    """All interactions in one schema, with the month they are partitioned by."""
    log = union_as(branches, INTERACTION).withColumn(
        "interaction_date_year_month", month_start(F.col("interaction_date"))
    )
    return align(log, INTERACTION_LOG)


def interactions_of(
    sources: Sources,
    creators: Ids | None = None,
    currencies: Sequence[Currency] = CURRENCIES,
    ledger: DataFrame | None = None,
    revenue: DataFrame | None = None,
    hot: Mapping[str, Hot] = NO_HOT,
    packed: bool = False,
) -> DataFrame:
    """Interaction log from the raw tables, of all profiles or of ``creators``.

    ``ledger`` and ``revenue`` are used where already written, otherwise built. With
    ``packed`` it is the log before ``unpacked_interactions``.
    """
    scope = _everything(sources) if creators is None else _of_creators(sources, creators)
    if ledger is None:
        built = collect_ledger(
            scope.posts,
            scope.modules_v1,
            scope.records_v1,
            sources.profile_v1,
            sources.profile_stats_v1,
            currencies,
            hot,
        )
        ledger = export_times(built)
    if revenue is None:
        revenue = revenue_v2(scope.modules, currencies)
    only_owned = creators is not None
    branches = [
        follows.packed(scope.followers),
        derivatives.packed(
            scope.records,
            scope.metadata_of_children,
            scope.owners,
            only_owned,
            hot.get("parents", NONE),
        ),
        collects_v2.packed(
            sources.acted_record, scope.owners, scope.modules, revenue, only_owned, hot
        ),
        collects_v1.packed(restrict_to(ledger, creators, "profile_id"), currencies),
        reactions.packed(sources.reaction, scope.owners, only_owned, hot.get("reacted", NONE)),
        mentions.packed(
            scope.mentioned,
            scope.authors,
            scope.metadata_of_authors,
            hot.get("mentioned", NONE),
        ),
    ]
    log = union_as([_packed(branch) for branch in branches], PACKED_INTERACTION)
    month = month_start(F.to_date("_at")).alias("interaction_date_year_month")
    made = align(log.select("*", month), PACKED_LOG)
    return made if packed else unpacked_interactions(made)


def unpacked_interactions(packed: DataFrame) -> DataFrame:
    return _unpacked(packed, INTERACTION_LOG)


def log_joins(sources: Sources) -> dict[str, Sides]:
    """The joins of the log, and of the ledger, in which a publication may be hot.

    Revenue has a row per currency of a publication's modules, which ``revenue_keys`` stands
    for; it meets acts times modules.
    """
    acted, modules = ((t, "publication_id") for t in (sources.acted_record, sources.action_module))
    return {
        "parents": [(sources.publication_record, "parent_publication_id")],
        "acted": [acted],
        "modules": [acted, modules],
        "priced": [modules],
        "revenue": [acted, modules, (revenue_keys(sources.action_module), "publication_id", True)],
        "reacted": [(sources.reaction, "publication_id")],
        "mentioned": [(sources.mention, "publication_id")],
        **ledger_joins(sources.post_v1, sources.collect_module_v1, sources.collect_record_v1),
    }


def revenue_keys(modules: DataFrame) -> DataFrame:
    """The publications and currencies of the revenue table, which has each pair once."""
    return modules.select("publication_id", currency_label(F.col("currency")).alias("currency"))


def ledger_of(
    sources: Sources,
    creators: Ids | None = None,
    currencies: Sequence[Currency] = CURRENCIES,
    hot: Mapping[str, Hot] = NO_HOT,
) -> DataFrame:
    """First-generation ledger from the raw tables, of all profiles or of ``creators``."""
    posts = restrict_to(sources.post_v1, creators, "profile_id")
    ids = None if creators is None else posts.select("post_id")
    return collect_ledger(
        posts,
        restrict_to(sources.collect_module_v1, ids, "publication_id", few=True),
        restrict_to(sources.collect_record_v1, ids, "publication_id", few=True),
        sources.profile_v1,
        sources.profile_stats_v1,
        currencies,
        hot,
    )


def _everything(sources: Sources) -> SimpleNamespace:
    records, metadata = sources.publication_record, sources.publication_metadata
    return SimpleNamespace(
        records=records,
        owners=owners_of(records),
        followers=sources.follower,
        mentioned=sources.mention,
        authors=records,
        metadata_of_authors=metadata,
        metadata_of_children=metadata,
        modules=sources.action_module,
        posts=sources.post_v1,
        modules_v1=sources.collect_module_v1,
        records_v1=sources.collect_record_v1,
    )


def _of_creators(sources: Sources, creators: Ids) -> SimpleNamespace:
    """The parts of the tables that the creators' interactions are made from.

    Large tables are cut by semi joins with the ids that occur; whether these are
    broadcast is left to Spark, which knows their size once they are computed.
    """
    records, metadata = sources.publication_record, sources.publication_metadata
    mentioned = restrict_to(sources.mention, creators, "profile_id")
    posts = restrict_to(sources.post_v1, creators, "profile_id")
    owners = owners_of(records, creators)
    mentions = mentioned.select("publication_id")
    posts_ids = posts.select("post_id")
    children = _children(records).join(
        owners, F.col("parent_id") == F.col("owned_id"), "left_semi"
    ).select("interaction_publication_id")
    return SimpleNamespace(
        records=records,
        owners=owners,
        followers=restrict_to(sources.follower, creators, "profile_id"),
        mentioned=mentioned,
        authors=restrict_to(records, mentions, "publication_id"),
        metadata_of_authors=restrict_to(metadata, mentions, "publication_id"),
        metadata_of_children=restrict_to(metadata, children, "publication_id"),
        modules=restrict_to(sources.action_module, owners, "publication_id", few=True),
        posts=posts,
        modules_v1=restrict_to(sources.collect_module_v1, posts_ids, "publication_id", few=True),
        records_v1=restrict_to(sources.collect_record_v1, posts_ids, "publication_id", few=True),
    )


def _children(records: DataFrame) -> DataFrame:
    return records.filter(F.col("parent_publication_id").isNotNull()).select(
        F.col("parent_publication_id").alias("parent_id"),
        F.col("profile_id").alias("interaction_profile_id"),
        F.col("publication_id").alias("interaction_publication_id"),
        F.col("app").alias("interaction_app"),
        F.col("publication_type").alias("interaction_type"),
        "block_timestamp",
    )


def _owned(
    rows: DataFrame, owners: DataFrame, key: str, only_owned: bool, hot: Hot
) -> DataFrame:
    """Add the owner; ``only_owned`` drops rows whose publication is not there."""
    if only_owned:
        return pair(rows, owners, key, "owned_id", hot)
    return lookup(rows, owners, key, "owned_id", hot)


def _languages(metadata: DataFrame) -> DataFrame:
    return metadata.select(F.col("publication_id").alias("metadata_id"), "language")


def _when(column: str, kind: str) -> tuple[Column, Column]:
    ts = F.col(column)
    return F.to_date(ts).alias(f"{kind}_date"), time_text(ts).alias(f"{kind}_time")


def _null(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)
