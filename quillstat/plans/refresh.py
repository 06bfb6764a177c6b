"""Full refresh of all products in dependency order.

Every product is written and read back, so later products start from files: a
lost executor costs the tasks it ran, not the chain before them. A refresh that broke off
goes on where it was when it is called again with the same folder and the same sources.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from quillstat.fixed_values import ALLOWLIST, CURRENCIES, HISTORY_PROFILES, Currency
from quillstat.functions.money import split_amounts
from quillstat.operators.joins import Ids
from quillstat.operators.skew import NONE, Hot, Parts, find_hot
from quillstat.plans import dimensions, facts, marts, stage
from quillstat.session import shuffles_removed
from quillstat.sources.runs import Run, publish, together
from quillstat.sources.sinks import export_times
from quillstat.sources.tables import Sources, with_tables

# Products partitioned by month, with their month column.
MONTHS = {
    "L2_publication": "publication_date_year_month",
    "L3_publication": "publication_date_year_month",
    "L2_interaction": "interaction_date_year_month",
    "L3_interaction": "interaction_date_year_month",
}


# Large products that are read by creator, and one that is read by publication: sorted, its ids
# take less room in files and shuffles.
CLUSTERS = {name: ("profile_id", "publication_id") for name in MONTHS} | {
    "stage_v2_publication_collect": ("publication_id",)
}


# Products that are shuffled by month before some of their columns and equal rows are made.
PACKED = {
    "L2_publication": facts.unpacked_publications,
    "L2_interaction": facts.unpacked_interactions,
}


def refresh(
    spark: SparkSession,
    sources: Sources,
    root: str,
    creators: Ids = ALLOWLIST,
    currencies: Sequence[Currency] = CURRENCIES,
    history: Ids | None = HISTORY_PROFILES,
    base: str | None = None,
) -> dict[str, DataFrame]:
    """Write all products below ``root`` and return them as read back.

    ``root`` is a new directory, or that of a run with the same arguments that did not come
    to its end; products that are finished there are not made again. With ``base`` the run is
    published there as a whole when it is done. Amounts no decimal can hold are set
    aside in a product of their own first, so one bad row stops nothing. Hot keys are
    measured once for all joins, when the first product asks for them. Products that do not
    depend on each other are written at the same time, but for the two largest; what was
    shuffled for a product goes when it is written.
    """
    with shuffles_removed(spark):
        return _refreshed(spark, sources, Run(spark, root), creators, currencies, history, base)


def _refreshed(
    spark: SparkSession,
    sources: Sources,
    run: Run,
    creators: Ids,
    currencies: Sequence[Currency],
    history: Ids | None,
    base: str | None,
) -> dict[str, DataFrame]:

    def put(name: str, build: Callable[[], DataFrame], gathered: bool = False) -> DataFrame:
        return run.put(
            name, build, MONTHS.get(name), CLUSTERS.get(name, ()), PACKED.get(name), gathered
        )

    split = {n: split_amounts(getattr(sources, n)) for n in ("action_module", "collect_module_v1")}
    put("quarantined_amount", lambda: stage.quarantined({n: bad for n, (_, bad) in split.items()}))
    # Keys are counted in the raw tables, which needs no amounts; rows set aside are few.
    raw, sources = sources, with_tables(sources, **{n: good for n, (good, _) in split.items()})
    owners = (sources.ownership_history, sources.handle_history, sources.profile_record)
    measuring = Lock()

    @cache
    def measured() -> Mapping[str, Hot]:
        return find_hot({**facts.log_joins(raw), **dimensions.history_joins(*owners)})

    def hot() -> Mapping[str, Hot]:
        with measuring:
            return measured()

    def staged() -> DataFrame:
        ledger = put("publication_collect", lambda: facts.ledger_of(sources, None, currencies, hot()))
        return put("stage_v1_publication_collect", lambda: export_times(ledger))

    def profiled() -> DataFrame:
        made = put(
            "L2_profile",
            lambda: dimensions.profile_dimension(
                sources.profile_record,
                sources.profile_metadata,
                sources.profile_last_logged_in,
                sources.profile_stats,
                sources.follower_stats,
                sources.profile_quality,
            ),
        )
        put("profile_check", lambda: dimensions.profile_check(made))
        return put("L3_profile", lambda: marts.profile_mart(made))

    listed, hop, revenue, profiles, *_ = together(
        lambda: put("md_allowlist", lambda: stage.allowlist_of(spark, creators)),
        staged,
        lambda: put(
            "stage_v2_publication_collect",
            lambda: stage.revenue_v2(sources.action_module, currencies, hot()["priced"].left),
        ),
        profiled,
        lambda: put("handle_history", lambda: dimensions.handle_history(*owners, history, hot())),
        lambda: put("stage_currency_exchange", lambda: stage.exchange_rates(spark, currencies)),
        lambda: put("L2_date", lambda: dimensions.date_dimension(spark)),
        lambda: put("currency_check", lambda: stage.currency_check(sources.action_module, currencies)),
    )
    # A short list reaches the scans as a predicate, a table is joined.
    by_table = isinstance(creators, DataFrame)
    chosen = listed if by_table else creators

    def crowded() -> Parts:
        return find_hot({"posts": [(hop, "post_id")]})["posts"].left

    def published() -> DataFrame:
        made = put(
            "L2_publication",
            lambda: facts.packed_publications(
                sources.publication_record,
                sources.publication_metadata,
                revenue,
                sources.publication_stats,
                stage.revenue_v1(hop, crowded()),
            ),
        )
        return put("L3_publication", lambda: marts.of_creators(made, chosen), not by_table)

    def logged() -> DataFrame:
        made = put(
            "L2_interaction",
            lambda: facts.interactions_of(sources, None, currencies, hop, revenue, hot(), True),
        )
        return put("L3_interaction", lambda: marts.of_creators(made, chosen), not by_table)

    # Both shuffle the large tables; at the same time they would need the disk of both.
    publications, interactions = published(), logged()
    acted = hot().get("acted", NONE) if not run.has("L3_publication_analysis") else NONE
    together(
        lambda: put("L3_interaction_year_month", lambda: marts.interactions_by_month(interactions)),
        lambda: put("L3_publication_year_month", lambda: marts.publications_by_month(publications)),
        lambda: put("L3_user_analysis", lambda: marts.user_analysis(interactions, profiles)),
        lambda: put(
            "L3_interaction_weekday_hour", lambda: marts.interaction_weekday_hour(interactions)
        ),
        lambda: put(
            "L3_publication_analysis",
            lambda: marts.interactions_by_age(interactions, publications, acted),
        ),
    )
    if base is not None:
        publish(spark, base, run.root)
    return run.products()
