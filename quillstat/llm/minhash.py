"""Near-duplicates by minima of universal hashes, banding, verification and components.

1. Every text becomes the set of hashes of its shingles, of ``SHINGLE`` words or of as
   many as the caller asks for, and ``BANDS * ROWS`` minima of universal hash functions
   over it. Equal texts are one node from here on.
2. Nodes that agree on all minima of a band meet in a bucket. Instead of all pairs, the
   node of a bucket that shares most buckets with others is paired with the rest, so a
   bucket of copies costs as many pairs as it has members.
3. A pair is dropped if the sizes of its sets, or the low bits of their minima, rule the
   similarity out, and is confirmed on the full sets otherwise. A pivot with many
   partners is copied to several lots, so a lot is bounded.
4. Confirmed links give components by alternating large-star and small-star.
5. Where a bucket still holds several components, its rows outside the largest are
   compared with all its rows on the full sets, in blocks of bounded size, and the links
   found join components once more. So no link within a bucket is lost, and no pairs are
   emitted.

At the threshold itself two texts share no bucket with a chance of 3 in a million; the
bits miss it by about as little.

Defined results: a text without words, or null, has an empty set and is its own
component; a text shorter than a shingle has itself as its set; equal texts are linked. The
component is named by its smallest id; null ids are ignored there, and a component of
null ids has a null name. Rows with one id and different texts are different nodes;
``link`` marks all of a component that bear its name as kept, ``keep_first`` keeps one text.
No rows give no rows. Extra columns are ignored by ``link`` and kept by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.arrays import batches, blend, chain, distinct, hash_words, split_words
from quillstat.llm.stars import components
from quillstat.llm.tables import (
    KEY_ROWS,
    LINK_ROWS,
    cut,
    parts_for,
    small_batches,
    text_of,
    with_library,
)

SHINGLE = 2
PERCENT = 80
BANDS = 32
ROWS = 5
BITS = 128
# Bits that may differ: at 80 % similarity 12.8 do, with a deviation of 3.4.
MOST_BITS = 31
# Partners of one copy of a pivot, and rows of a lot.
PARTNERS = 512
LOT_ROWS = 2048
# Rows on one side of a block, and columns of the tables that intersect them.
BLOCK = 1024
COLUMNS = 4096
# Texts are handled in lots of about so many bytes.
LOT = 2_000_000
# Bytes of texts in a file.
FILE_BYTES = 8_000_000

_RNG = np.random.default_rng(20)
_FACTOR = _RNG.integers(0, 2**32, BANDS * ROWS, np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 2**32, BANDS * ROWS, np.uint32)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of the word shingles of each text."""
    laid = split_words(texts, lower=True)
    words = hash_words(laid)
    grams = words
    for place in range(1, size):
        grams = chain(grams[:-1], words[place:])
    sets = []
    for begin, end in zip(laid.first[:-1], laid.first[1:], strict=True):
        if end - begin >= size:
            sets.append(distinct(grams[begin : end - size + 1]))
        elif end > begin:
            whole = words[begin : begin + 1]
            for i in range(begin + 1, end):
                whole = chain(whole, words[i : i + 1])
            sets.append(blend(whole ^ np.uint64(end - begin)))
        else:
            sets.append(words[:0])
    return sets


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of every hash function over each non-empty set."""
    found = np.empty((len(sets), len(_FACTOR)), np.uint32)
    for i, items in enumerate(sets):
        folded = (items >> np.uint64(32)).astype(np.uint32)
        best = None
        for at in range(0, len(folded), 2048):
            part = folded[None, at : at + 2048] * _FACTOR[:, None] + _SHIFT[:, None]
            least = part.min(axis=1)
            best = least if best is None else np.minimum(best, least)
        found[i] = best
    return found


def band_keys(found: np.ndarray) -> np.ndarray:
    bands = found.reshape(len(found), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2]).copy()
    for row in range(ROWS):
        keys = chain(keys, bands[:, :, row])
    return keys.view(np.int64)


def low_bits(found: np.ndarray) -> np.ndarray:
    bits = (found[:, :BITS] >> np.uint32(8)) & np.uint32(1)
    packed = np.packbits(bits.astype(np.uint8), axis=1)
    return np.ascontiguousarray(packed).view(np.int64)


def _sketch(shingle: int):
    def sketch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for lot in batches([len(t) for t in pdf["text"]], LOT):
                own = pdf.iloc[lot]
                sets = shingle_sets(own["text"].tolist(), shingle)
                sizes = np.array([len(s) for s in sets])
                some = np.flatnonzero(sizes)
                found = minima([sets[i] for i in some])
                keys, bits = band_keys(found), low_bits(found)
                bands: list = [None] * len(sets)
                one, two = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                for i, k in zip(some, keys, strict=True):
                    bands[i] = k
                one[some], two[some] = bits[:, 0], bits[:, 1]
                yield pd.DataFrame(
                    {"id": own["id"], "text_key": own["text_key"], "n": sizes, "bands": bands,
                     "one": one, "two": two, "bytes": [len(t) for t in own["text"]]}
                )

    return sketch


def _verify(percent: int, shingle: int):
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        sets: dict[int, np.ndarray] = {}
        firsts = pdf.drop_duplicates("node")
        texts = firsts["text"].tolist()
        for lot in batches([len(t) for t in texts], LOT):
            sets |= zip(firsts["node"].iloc[lot], shingle_sets(texts[lot], shingle), strict=True)
        links = []
        for u, v in pdf[["pivot", "node"]].drop_duplicates().itertuples(index=False):
            if u != v:
                both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
                if 100 * both >= percent * (len(sets[u]) + len(sets[v]) - both):
                    links.append((u, v))
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return verify


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Drop pairs that the sizes of the sets or the bits of their minima rule out."""
    for side in ("pivot", "node"):
        pairs = pairs.join(
            nodes.select(
                F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", "one", "two")]
            ),
            side,
        )
    low = F.least("pivot_n", "node_n")
    high = F.greatest("pivot_n", "node_n")
    differ = F.lit(0)
    for c in ("one", "two"):
        differ += F.bit_count(F.col(f"pivot_{c}").bitwiseXOR(F.col(f"node_{c}")))
    return pairs.filter((100 * low >= percent * high) & (differ <= MOST_BITS)).select("pivot", "node")


def _confirm(
    pairs: DataFrame, most: int, texts: DataFrame, percent: int, shingle: int
) -> tuple[DataFrame, int]:
    """The pairs, ``most`` or fewer, whose full sets are similar enough, and the number of lots."""
    pairs = cut(pairs, "minhash-pairs", parts_for(most, LINK_ROWS))
    counts = pairs.groupBy("pivot").agg(
        F.ceil(F.count(F.lit(1)) / PARTNERS).cast("long").alias("copies")
    )
    partners = pairs.join(counts, "pivot").select(
        "pivot", F.pmod(F.xxhash64("node"), F.col("copies")).alias("copy"), "node"
    )
    pivots = counts.select(
        "pivot",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"),
        F.col("pivot").alias("node"),
    )
    lots = parts_for(pairs.count(), LOT_ROWS)
    routes = partners.union(pivots).withColumn(
        "lot", F.pmod(F.xxhash64("pivot", "copy"), F.lit(lots))
    )
    met = routes.join(texts, "node").select("lot", "pivot", "node", "text")
    return met.groupBy("lot").applyInPandas(_verify(percent, shingle), "u long, v long"), lots


def _shared(o: list[np.ndarray], a: list[np.ndarray]) -> np.ndarray:
    """The size of every intersection of two lists of sets."""

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        return rows, np.concatenate(sets)

    (row_o, item_o), (row_a, item_a) = flat(o), flat(a)
    both = np.intersect1d(item_o, item_a)
    counts = np.zeros((len(o), len(a)), np.float32)
    for at in range(0, len(both), COLUMNS):
        some = both[at : at + COLUMNS]

        def dense(rows: np.ndarray, items: np.ndarray, height: int, some=some) -> np.ndarray:
            place = np.minimum(np.searchsorted(some, items), len(some) - 1)
            known = some[place] == items
            table = np.zeros((height, len(some)), np.float32)
            table[rows[known], place[known]] = 1
            return table

        counts += dense(row_o, item_o, len(o)) @ dense(row_a, item_a, len(a)).T
    return counts.astype(np.int64)


def _verify_blocks(percent: int, shingle: int):
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        sets: dict[int, np.ndarray] = {}
        firsts = pdf.drop_duplicates("node")
        texts = firsts["text"].tolist()
        for lot in batches([len(t) for t in texts], LOT):
            sets |= zip(firsts["node"].iloc[lot], shingle_sets(texts[lot], shingle), strict=True)
        links = []
        for _, own in pdf.groupby(["key", "i", "j"]):
            sides = [own[own["apart"] == x].drop_duplicates("node") for x in (True, False)]
            if not (len(sides[0]) and len(sides[1])):
                continue
            (o, a), (label_o, label_a) = ([s[c].to_numpy() for s in sides] for c in ("node", "label"))
            both = _shared([sets[n] for n in o], [sets[n] for n in a])
            sizes = [np.array([len(sets[n]) for n in side]) for side in (o, a)]
            union = sizes[0][:, None] + sizes[1][None, :] - both
            near = (100 * both >= percent * union) & (label_o[:, None] != label_a[None, :])
            links += [(o[u], a[v]) for u, v in zip(*np.nonzero(near), strict=True)]
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64").drop_duplicates()

    return verify


def _rest(
    members: DataFrame, most: int, labels: DataFrame, texts: DataFrame, percent: int, shingle: int
) -> tuple[DataFrame, int]:
    """Links across the components that still share a bucket, and the number of lots.

    In every such bucket the rows outside its largest component are compared with all
    rows, block by block. Rows are sent to blocks; pairs are only formed inside tasks.
    """
    rows = members.join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label")
    )
    sizes = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    open_ = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("c", "label")).alias("most"), F.sum("c").alias("c"))
        .filter((F.col("c") > F.col("most.c")) & (F.col("c") > 2))
        .select(
            "key",
            F.col("most.label").alias("most"),
            F.ceil(F.col("c") / BLOCK).alias("blocks"),
            F.ceil((F.col("c") - F.col("most.c")) / BLOCK).alias("blocks_apart"),
        )
    )
    rows = cut(rows.join(open_, "key"), "minhash-open", parts_for(most, LINK_ROWS))

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(of))

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    kept = ("key", "node", "label")
    apart = rows.filter(F.col("label") != F.col("most")).select(
        *kept, F.lit(True).alias("apart"), block("blocks_apart").alias("i"), every("blocks").alias("j")
    )
    everyone = rows.select(
        *kept, F.lit(False).alias("apart"), every("blocks_apart").alias("i"), block("blocks").alias("j")
    )
    routes = cut(apart.unionByName(everyone), "minhash-routes")
    lots = parts_for(routes.count(), LOT_ROWS)
    met = routes.withColumn("lot", F.pmod(F.xxhash64("key", "i", "j"), F.lit(lots))).join(texts, "node")
    return met.groupBy("lot").applyInPandas(_verify_blocks(percent, shingle), "u long, v long"), lots


def _links(
    members: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, shingle: int
) -> DataFrame:
    """Label every node that is linked with another: ``node``, ``label``.

    Links are written in as many files as the lots that they came from, at most.
    """
    most = members.count()
    # The node that shares most buckets with most others is likely to be near them all.
    weights = members.groupBy("node").agg(F.sum("c").alias("weight"))
    pivots = (
        members.join(weights, "node")
        .groupBy("key")
        .agg(F.max(F.struct("weight", "node")).alias("p"))
        .select("key", F.col("p.node").alias("pivot"))
    )
    pairs = members.join(pivots, "key").filter(F.col("node") != F.col("pivot"))
    pairs = pairs.select("pivot", "node").distinct()
    first, lots = _confirm(_possible(pairs, nodes, percent), most, texts, percent, shingle)
    labels = components(first, lots)
    rest, more = _rest(members, most, labels, texts, percent, shingle)
    return components(labels.toDF("u", "v").union(rest), lots + more)


def _resolved(
    docs: DataFrame, id_col: str, text_col: str, percent: int, shingle: int
) -> tuple[DataFrame, int]:
    """Every row as ``id``, ``text_key``, ``n``, ``component`` and ``first``, and files for them.

    ``first`` is true for one text of each component: of those with the smallest id, nulls
    last, the one with the least key.
    """
    spark = docs.sparkSession
    with_library(spark)
    small_batches(spark)
    source = docs.select(
        F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), text_of(text_col).alias("text")
    )
    id_type = source.schema["id"].dataType.simpleString()
    sketched = source.mapInPandas(
        _sketch(shingle),
        f"id {id_type}, text_key string, n long, bands array<long>, one long, two long, bytes long",
    )
    rows = cut(sketched.withColumn("row", F.monotonically_increasing_id()), "minhash-rows")
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")).first()
    files = parts_for(total["rows"], KEY_ROWS)
    classes = cut(
        rows.groupBy("text_key").agg(
            F.min("row").alias("node"),
            F.min("id").alias("least"),
            F.min_by("id", "row").alias("named"),
            F.first("n").alias("n"),
        ),
        "minhash-classes",
        files,
    )
    # One row of each class carries its bands on.
    own = classes.filter(F.col("n") > 0).select(F.col("node").alias("row"))
    first = rows.join(own, "row")
    nodes = first.select(F.col("row").alias("node"), "n", "one", "two")
    bands = first.select(F.explode("bands").alias("key"), F.col("row").alias("node"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    members = cut(
        bands.join(shared, "key"), "minhash-members", parts_for(BANDS * total["rows"], LINK_ROWS)
    )
    wanted = (
        members.select("node").distinct().join(classes, "node")
        .select("node", F.col("text_key").alias("k"), F.col("named").alias("i"))
    )
    same = (F.col("text_key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i"))
    texts = cut(
        source.join(wanted, same).select("node", "text"),
        "minhash-texts",
        parts_for(total["bytes"], FILE_BYTES),
    )
    labels = cut(_links(members, nodes, texts, percent, shingle), "minhash-labels")
    labelled = classes.join(labels, "node", "left").select(
        "text_key", "least", F.coalesce("label", "node").alias("label")
    )
    order = F.struct(F.col("least").isNull(), "least", "text_key")
    names = labelled.groupBy("label").agg(
        F.min("least").alias("component"), F.min(order)["text_key"].alias("first_key")
    )
    named = labelled.join(names, "label").select(
        "text_key", "component", (F.col("text_key") == F.col("first_key")).alias("first")
    )
    resolved = rows.select("id", "text_key", "n").join(named, "text_key").select(
        "id",
        "text_key",
        "n",
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"),
        "first",
    )
    return resolved, files


def text_key(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def link(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``."""
    rows, files = _resolved(docs, id_col, text_col, percent, shingle)
    return rows.coalesce(files).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
) -> DataFrame:
    """The rows of ``docs``, with all columns, that are the first of their component.

    Of rows that repeat both id and text one stays, whatever else they hold. One text of
    each component stays, also where several share the smallest id or all ids are null.
    """
    rows, files = _resolved(docs, id_col, text_col, percent, shingle)
    kept = (
        rows.filter(F.col("id").eqNullSafe(F.col("component")) & F.col("first"))
        .groupBy("id", "text_key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    kept = cut(kept.toDF("kept_id", "kept_key", "rows"), "minhash-kept", files)
    tagged = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), text_key(text_col).alias("key")
    )
    same = (F.col("key") == F.col("kept_key")) & F.col("id").eqNullSafe(F.col("kept_id"))
    joined = tagged.join(kept, same)
    alone = joined.filter(F.col("rows") == 1).select("row.*")
    again = kept.filter(F.col("rows") > 1)
    if again.isEmpty():
        return alone
    # Rows that repeat both id and text are few; only they are brought together.
    repeated = tagged.join(again, same).dropDuplicates(["id", "key"]).select("row.*")
    return alone.union(repeated)
