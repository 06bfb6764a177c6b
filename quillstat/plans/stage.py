"""Reference lists and normalised revenue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.fixed_values import ALLOWLIST, CURRENCIES, Currency
from quillstat.functions.money import currency_label, exact_sum, token_amount, usd
from quillstat.operators.joins import Ids, fan_out, lookup
from quillstat.operators.ranking import first_by
from quillstat.operators.rows import literal_table, union_as
from quillstat.operators.skew import NO_HOT, NONE, Hot, Parts, Sides
from quillstat.schemas import COLLECT_LEDGER, PRODUCTS, align


def allowlist(spark: SparkSession, ids: Sequence[str] = ALLOWLIST) -> DataFrame:
    return literal_table(spark, {"profile_id": list(ids)}, PRODUCTS["md_allowlist"])


def allowlist_of(spark: SparkSession, creators: Ids) -> DataFrame:
    """The allowlist from a list of ids, or from the first column of a table."""
    if not isinstance(creators, DataFrame):
        return allowlist(spark, creators)
    return align(creators.toDF("profile_id", *creators.columns[1:]), PRODUCTS["md_allowlist"])


def exchange_rates(
    spark: SparkSession, currencies: Sequence[Currency] = CURRENCIES
) -> DataFrame:
    columns = {
        "currency_address": [c.address for c in currencies],
        "currency": [c.label for c in currencies],
        "value": [c.rate for c in currencies],
        "factor": [str(10**c.decimals) for c in currencies],
    }
    return literal_table(spark, columns, PRODUCTS["stage_currency_exchange"])


def with_rate(df: DataFrame, currencies: Sequence[Currency] = CURRENCIES) -> DataFrame:
    """Add ``rate`` by currency label, NULL for unlisted ones.

    The rates come from a literal list held by the driver, hence the broadcast.
    """
    rates = exchange_rates(df.sparkSession, currencies).select(
        F.col("currency").alias("rate_label"), F.col("value").alias("rate")
    )
    joined = df.join(F.broadcast(rates), F.col("currency") == F.col("rate_label"), "left")
    return joined.drop("rate_label")


def currency_check(
    modules: DataFrame, currencies: Sequence[Currency] = CURRENCIES
) -> DataFrame:
    """The currencies in use; those without a known rate are valued one to one."""
    label = currency_label(F.col("currency"), currencies).alias("currency")
    used = modules.groupBy(label).agg(F.count(F.lit(1)).alias("modules"))
    checked = with_rate(used, currencies).withColumn("rate_known", F.col("rate").isNotNull())
    return align(checked, PRODUCTS["currency_check"])


def quarantined(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows set aside from tables with amounts, with the name of their table."""
    return union_as(
        [df.withColumn("raw_table", F.lit(name)) for name, df in tables.items()],
        PRODUCTS["quarantined_amount"],
    )


def sums_by_key(rows: DataFrame, key: str, crowded: Parts) -> DataFrame:
    """Amounts per key and currency, where a join on the key finds all of a key's in one place.

    The rows are shuffled by the key alone, and so only once. Keys with more rows than one
    task's share, of which there are few, are summed before that, where they are read.
    """
    if crowded:
        many = F.coalesce(F.col(key).isin(sorted(crowded.keys)), F.lit(False))
        summed = rows.filter(many).groupBy(key, "currency").agg(exact_sum(F.col("amount")).alias("amount"))
        rows = rows.filter(~many).unionByName(summed)
    together = rows.repartition(key)
    return together.groupBy(key, "currency").agg(exact_sum(F.col("amount")).alias("amount"))


def revenue_v2(
    modules: DataFrame,
    currencies: Sequence[Currency] = CURRENCIES,
    crowded: Parts | None = None,
) -> DataFrame:
    """Revenue per publication and currency, scaled per row before summing.

    With ``crowded``, the publications with very many modules, the currencies of a
    publication end in one place (``sums_by_key``).
    """
    scaled = modules.select(
        "publication_id",
        currency_label(F.col("currency"), currencies).alias("currency"),
        token_amount(F.col("currency"), F.col("amount"), currencies).alias("amount"),
    )
    if crowded is None:
        revenue = scaled.groupBy("publication_id", "currency").agg(
            exact_sum(F.col("amount")).alias("amount")
        )
    else:
        revenue = sums_by_key(scaled, "publication_id", crowded)
    priced = with_rate(revenue, currencies).withColumn(
        "amount_USD", usd(F.col("amount"), F.col("rate"))
    )
    return align(priced, PRODUCTS["stage_v2_publication_collect"])


def top_profile_per_owner(profiles: DataFrame, stats: DataFrame) -> DataFrame:
    """Per wallet the profile with most collects; ties go to the lower id."""
    ranked = lookup(
        profiles.filter(F.col("owned_by").isNotNull()),
        stats.select(F.col("profile_id").alias("stats_id"), "total_collects"),
        "profile_id",
        "stats_id",
    )
    order = [
        F.col("total_collects").desc_nulls_last(),
        F.col("profile_id").asc_nulls_last(),
        F.col("handle").asc_nulls_last(),
    ]
    return first_by(ranked, "owned_by", order).select("owned_by", "profile_id", "handle")


def priced_posts(
    posts: DataFrame,
    modules: DataFrame,
    currencies: Sequence[Currency] = CURRENCIES,
    hot: Hot = NONE,
) -> DataFrame:
    """Posts by their collect modules; a post without a module stays."""
    terms = modules.select(
        F.col("publication_id").alias("module_id"),
        currency_label(F.col("currency"), currencies).alias("currency"),
        token_amount(F.col("currency"), F.col("amount"), currencies).alias("amount"),
        F.col("referral_fee").alias("referral_fee_pct"),
    )
    dated = posts.select(
        "profile_id", "post_id", F.col("block_timestamp").alias("publication_date")
    )
    priced = fan_out(dated, terms, "post_id", "module_id", hot)
    return priced.drop("module_id")


def collect_ledger(
    posts: DataFrame,
    modules: DataFrame,
    records: DataFrame,
    profiles: DataFrame,
    stats: DataFrame,
    currencies: Sequence[Currency] = CURRENCIES,
    hot: Mapping[str, Hot] = NO_HOT,
) -> DataFrame:
    """First-generation collects: post, its modules, its collects, the collector.

    The collector is looked up before the collects meet the posts: the wallet
    shuffle then carries narrow rows, and no rows of posts that nobody collected.
    The price is repeated on each collect and kept without any (as the source
    system has it), so revenue here is not bound to a collect.
    """
    wallets = top_profile_per_owner(profiles, stats).select(
        F.col("owned_by").alias("wallet"),
        F.col("profile_id").alias("profile_id_collected"),
        F.col("handle").alias("handle"),
    )
    collects = lookup(
        records.select(
            F.col("publication_id").alias("record_id"),
            F.col("block_timestamp").alias("collect_date"),
            F.col("collected_by").alias("collector"),
            "referral_id",
        ),
        wallets,
        "collector",
        "wallet",
        hot.get("ledger_wallets", NONE),
        null_keys=True,
    ).select(
        "record_id",
        "collect_date",
        "profile_id_collected",
        F.col("handle").alias("collected_by"),
        "referral_id",
    )
    ledger = fan_out(
        priced_posts(posts, modules, currencies, hot.get("ledger_posts", NONE)),
        collects,
        "post_id",
        "record_id",
        hot.get("ledger_modules", NONE),
        keys=records.select("publication_id"),
    )
    return align(ledger, COLLECT_LEDGER)


def ledger_joins(posts: DataFrame, modules: DataFrame, records: DataFrame) -> dict[str, Sides]:
    """The ledger's joins in which a key may be hot."""
    return {
        "ledger_posts": [(posts, "post_id"), (modules, "publication_id")],
        "ledger_modules": [(modules, "publication_id"), (records, "publication_id")],
        "ledger_wallets": [(records, "collected_by")],
    }


def revenue_v1(ledger: DataFrame, crowded: Parts | None = None) -> DataFrame:
    """Ledger amounts per post and currency.

    With ``crowded``, the posts with very many rows, the currencies of a post end in one
    place (``sums_by_key``).
    """
    amounts = ledger.select("post_id", "currency", "amount")
    if crowded is not None:
        return sums_by_key(amounts, "post_id", crowded)
    return amounts.groupBy("post_id", "currency").agg(exact_sum(F.col("amount")).alias("amount"))


def revenue_v1_from_raw(
    posts: DataFrame,
    modules: DataFrame,
    records: DataFrame,
    currencies: Sequence[Currency] = CURRENCIES,
) -> DataFrame:
    """What ``revenue_v1`` gives on the ledger, without building the ledger.

    A post's price counts once per collect, or once without any. So modules are
    summed and collects counted before the join: each key meets once, however
    many rows it had.
    """
    prices = (
        modules.select(
            F.col("publication_id").alias("module_id"),
            currency_label(F.col("currency"), currencies).alias("currency"),
            token_amount(F.col("currency"), F.col("amount"), currencies).alias("price"),
        )
        .groupBy("module_id", "currency")
        .agg(exact_sum(F.col("price")).alias("price"))
    )
    collects = records.groupBy(F.col("publication_id").alias("record_id")).agg(
        F.count(F.lit(1)).alias("collects")
    )
    copies = posts.groupBy("post_id").agg(F.count(F.lit(1)).alias("copies"))
    priced = lookup(copies, prices, "post_id", "module_id")
    joined = lookup(priced, collects, "post_id", "record_id")
    times = F.col("copies") * F.coalesce(F.col("collects"), F.lit(1))
    amount = (F.col("price") * times.cast("decimal(20,0)")).cast("decimal(38,2)")
    return joined.select("post_id", "currency", amount.alias("amount"))
