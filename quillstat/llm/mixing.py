"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source gets a share of all words by its weight, but never more than
``max_epochs`` times what it has. What a clamped source cannot take is reshared among
the others by weight until none is above its cap. A source is then taken as often in
whole as fits its target, and the rest comes from its documents in a seeded order, up
to the document that brings the total nearest the target.

No step gathers a source. Words are first summed per source and seeded bucket; the last
bucket that is partly taken is the only one whose rows are sorted, and what comes back
is one cutoff per source. So whether a row is taken depends on the row and its source's
cutoff alone.

Defined results: a null or wordless text has size 0 and takes no words; a null source is
a source of its own, last in order; a null id is ordered as the text ``null``; rows that
agree in id and text are taken or left together; a source without words has target 0; no
rows give no rows. Extra columns are ignored by ``mix`` and kept by ``repeat``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.tables import WORD, checked_broadcast, cut

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mixing"
# Hexadecimal digits of the order that name a bucket: 4096 per source.
BUCKET = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded_order(row_id: Column, text: Column, seed: str) -> Column:
    """A place in a random order that depends on the id and the text, so only equal rows tie."""
    known = (F.coalesce(row_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))
    return F.md5(F.concat(F.lit(f"{seed}:"), known[0], F.lit(":"), known[1]))


def cyclic_weights(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Weights dealt to the sources in code point order, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    dealt = F.get(F.array(*[F.lit(w) for w in weights]), place % len(weights))
    return sources.withColumn("weight", dealt.cast("bigint"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source with its ``size`` and ``weight``.

    Sources reach their caps in the order of cap over weight. If the first k are
    clamped, the others get ``level`` per weight; the right k is the first at which
    the next source stays below its cap.
    """
    cap = F.col("size") * max_epochs
    order = [cap / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = sources.withColumn("cap", cap)
    filled = filled.withColumn("place", F.row_number().over(Window.orderBy(*order)))
    filled = filled.withColumn("clamped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    filled = filled.withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    filled = filled.withColumn("total", F.sum("size").over(everything))
    filled = filled.withColumn("weights", F.sum("weight").over(everything))
    level = (F.col("total") - F.col("clamped")) / (F.col("weights") - F.col("used"))
    filled = filled.withColumn("level", level)
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    # The level at the first source that stays below its cap is the final one.
    final = F.min(F.when(fits, F.struct("place", "level"))).over(everything)
    filled = filled.withColumn("final", final["level"])
    share = F.col("final") * F.col("weight")
    target = F.when(share.isNull() | (share > F.col("cap")), F.col("cap").cast("double"))
    return filled.withColumn("target", target.otherwise(share)).select(*sources.columns, "target")


def cutoffs(
    measured: DataFrame, max_epochs: int = MAX_EPOCHS, weights: Sequence[int] = WEIGHTS
) -> DataFrame:
    """Per source: ``source_size``, ``target``, ``whole`` repetitions and the ``cutoff``.

    ``measured`` has ``source``, ``size`` and ``order`` of every row. Rows whose order is
    at most the cutoff are taken once more than ``whole``; a null cutoff takes none.
    """
    bucket = F.substring("order", 1, BUCKET)
    sums = cut(
        measured.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size")),
        "mixing-sums",
    )
    sizes = cyclic_weights(sums.groupBy("source").agg(F.sum("size").alias("size")), weights)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    sources = (
        water_fill(sizes, max_epochs)
        .withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("size"))
        .withColumnRenamed("size", "source_size")
    )
    sources = cut(sources, "mixing-sources")
    to_source = checked_broadcast(sources.select(F.col("source").alias("s"), "rest"))
    # The rest ends in the first bucket whose running sum passes it.
    running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
    edge = (
        sums.withColumn("upto", running)
        .join(to_source, F.col("source").eqNullSafe(F.col("s")))
        .filter(F.col("upto") > F.col("rest"))
        .groupBy("source")
        .agg(
            F.min(F.struct("bucket", (F.col("upto") - F.col("size")).alias("before"))).alias("e"),
            F.first("rest").alias("rest"),
        )
        .select(F.col("source").alias("s"), "e.bucket", "e.before", "rest")
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("bucket"))
    by_order = Window.partitionBy("source").orderBy("order")
    tied = Window.partitionBy("source", "order")
    upto = F.col("before") + F.sum("size").over(by_order)
    ends = (
        measured.join(checked_broadcast(edge), same)
        .withColumn("upto", upto)
        .withColumn("own", F.sum("size").over(tied))
        # A document is taken if that leaves the total nearer the target.
        .withColumn("taken", 2 * F.col("upto") - F.col("own") <= 2 * F.col("rest"))
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("taken"), F.col("order"))).alias("last"),
            F.first("bucket").alias("bucket"),
        )
        .select(
            F.col("source").alias("s"),
            # Without a row of the edge bucket, all earlier buckets: their orders sort below it.
            F.coalesce(F.col("last"), F.col("bucket")).alias("cutoff"),
        )
    )
    joined = sources.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return cut(joined.select("source", "source_size", "target", "whole", "cutoff"), "mixing-cutoffs")


def _taken(rows: DataFrame, sources: DataFrame, max_epochs: int) -> DataFrame:
    """Add ``copies`` to rows with ``source`` and ``order``."""
    listed = checked_broadcast(sources.withColumnRenamed("source", "s"))
    joined = rows.join(listed, F.col("source").eqNullSafe(F.col("s")), "left")
    more = F.coalesce(F.col("order") <= F.col("cutoff"), F.lit(False)).cast("bigint")
    return joined.withColumn("copies", F.least(F.col("whole") + more, F.lit(max_epochs)))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: the id, ``size``, ``source_size``, ``target``, ``taken``, ``copies``."""
    measured = cut(
        docs.select(
            F.col(id_col).alias(id_col),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            seeded_order(F.col(id_col), F.col(text_col), seed).alias("order"),
        ),
        "mixing-measured",
    )
    rows = _taken(measured, cutoffs(measured, max_epochs, weights), max_epochs)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return rows.select(F.col(id_col), "size", "source_size", "target", taken, "copies")


def repeat(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them."""
    measured = cut(
        docs.select(
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            seeded_order(F.col(id_col), F.col(text_col), seed).alias("order"),
        ),
        "mixing-measured",
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(source_col).alias("source"),
        seeded_order(F.col(id_col), F.col(text_col), seed).alias("order"),
    )
    taken = _taken(rows, cutoffs(measured, max_epochs, weights), max_epochs)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return taken.select("row", copies.alias("copy")).select("row.*")
