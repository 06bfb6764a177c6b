"""The trie of all conversation prefixes, from vertical bitmaps per shard.

1. Every conversation is a sequence of turns; a turn's role and text become one key, so
   texts do not move.
2. Conversations, in order of id, are cut into shards of bounded size. A shard indexes
   (position, turn) to a bitset of its conversations, and another bitset for those that
   end at a position. From the root down, the bitset of a node is intersected with the
   postings of the next position: each non-empty result is a child, its popcount the
   child's members, its lowest bit the smallest of them, and the intersection with the end
   bitset the list of those that end there.
3. The same prefix gets the same name in every shard, a hash of the turns' keys along the
   path. Nodes of all shards are summed up by name; end lists, which shards hold in order of
   id, are hashed one after another by a task that keeps none of them.
4. Sums over subtrees grow by doubling: a node that knows the sum of all below it nearer
   than 2^k adds those of its descendants at just that distance. Each shard gives a
   node its ancestors at distances 1, 2, 4, ..., so no pointer has to be looked up.

Turns are ordered by turn, nulls first, and those that tie by their keys. A null role or text is
empty. Rows without a conversation id belong to no conversation. Rows that agree in all of
it are turns of their own. No rows give no nodes; other columns are ignored. The turns of
one conversation are handled by one task; they are keys of 16 bytes. Keys are halves of
SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.tables import WORD, cut, parts_for, with_library

# Turns and conversations of a shard, and turns read by one task.
SHARD_TURNS = 16_384
SHARD_CONVERSATIONS = 4096
TASK_TURNS = 65_536
ENDS_ROWS = 65_536
# A conversation takes turns of the first one of its block of so many ids.
BLOCK = 20
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = hashlib.sha256(b"").digest()[:16]

_STEP = ("conv", "part", "place", "turn", "words")
_LOCAL = (
    "path binary, depth long, conv long, n long, words long, anc array<binary>, "
    "first_end long, ends string"
)


def child_name(path: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(path + turn).digest()[:16]


def numbered(
    conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """All turns as ``conv``, ``place`` from 0, ``turn`` (the key) and ``words``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("at"),
        F.unhex(F.substring(F.sha2(spelled, 256), 1, 32)).alias("turn"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("at").asc_nulls_first(), "turn")
    place = (F.row_number().over(order) - 1).cast("long")
    return rows.withColumn("place", place).select("conv", "place", "turn", "words")


def whole(turns: DataFrame) -> DataFrame:
    """Conversations as they are, as steps."""
    return turns.select("conv", F.lit(1).alias("part"), "place", "turn", "words")


def grafted(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Conversations rebuilt: h turns of their block's first one, then their own after h.

    h is the CRC of the id modulo 4. A conversation may end up without turns, so each has
    one row without a turn too.
    """
    turns = cut(turns, "trie-turns")

    def h(conv: str) -> Column:
        return F.pmod(F.crc32(F.col(conv).cast("string").cast("binary")), F.lit(4))

    every = turns.filter(F.col("place") == 0).select("conv")
    wanted = every.select("conv", (F.col("conv") - F.col("conv") % block).alias("base"), h("conv").alias("h"))
    lent = turns.filter(F.col("place") < 3).withColumnRenamed("conv", "base")
    heads = (
        wanted.filter("h > 0").join(lent, "base").filter(F.col("place") < F.col("h"))
        .select("conv", F.lit(0).alias("part"), "place", "turn", "words")
    )
    own = turns.filter(F.col("place") >= h("conv")).select(
        "conv", F.lit(1).alias("part"), "place", "turn", "words"
    )
    marks = every.select(
        "conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("place"),
        F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("words"),
    )
    return heads.union(own).union(marks)


def shard_nodes(convs: list[int], sequences: list[list[tuple[bytes, int]]]) -> Iterator[tuple]:
    """The trie of some conversations, in ascending order of id: a row for each node."""
    postings: list[dict[bytes, int]] = []
    ends: list[int] = []
    for c, sequence in enumerate(sequences):
        bit = 1 << c
        while len(postings) <= len(sequence):
            postings.append({})
            ends.append(0)
        for at, (turn, _) in enumerate(sequence):
            index = postings[at]
            index[turn] = index.get(turn, 0) | bit
        ends[len(sequence)] |= bit
    trail: list[bytes] = []
    stack = [(ROOT, 0, (1 << len(convs)) - 1, 0)]
    while stack:
        path, depth, members, words = stack.pop()
        del trail[depth:]
        trail.append(path)
        anc = [trail[depth - (1 << k)] for k in range(depth.bit_length())]
        ended = members & ends[depth]
        rest = members ^ ended
        done = []
        while ended:
            low = ended & -ended
            done.append(convs[low.bit_length() - 1])
            ended ^= low
        least = convs[(members & -members).bit_length() - 1]
        yield (
            path, depth, least, members.bit_count(), words, anc,
            done[0] if done else None, ",".join(map(str, done)),
        )
        while rest:
            turn, size = sequences[(rest & -rest).bit_length() - 1][depth]
            child = members & postings[depth][turn]
            stack.append((child_name(path, turn), depth + 1, child, size))
            rest &= ~child


def _shards(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nodes of one shard after another; steps come sorted by conversation."""
    convs: list[int] = []
    sequences: list[list[tuple[bytes, int]]] = []
    turns = 0

    def rows() -> pd.DataFrame:
        found = pd.DataFrame(
            shard_nodes(convs, sequences),
            columns=["path", "depth", "conv", "n", "words", "anc", "first_end", "ends"],
        )
        found["first_end"] = found["first_end"].astype("Int64")
        return found

    for pdf in parts:
        for conv, turn, words in zip(pdf["conv"], pdf["turn"], pdf["words"], strict=True):
            if not convs or convs[-1] != conv:
                if turns >= SHARD_TURNS or len(convs) >= SHARD_CONVERSATIONS:
                    yield rows()
                    convs, sequences, turns = [], [], 0
                convs.append(int(conv))
                sequences.append([])
            if turn is not None:
                sequences[-1].append((bytes(turn), int(words)))
                turns += 1
    if convs:
        yield rows()


def _hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each node's end lists, which come one after another."""
    path, state = None, None
    for pdf in parts:
        out = []
        for own, ends in zip(pdf["path"], pdf["ends"], strict=True):
            if own != path:
                if state is not None:
                    out.append((path, state.hexdigest()))
                path, state = own, hashlib.sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
        yield pd.DataFrame(out, columns=["path", "ends_sha256"])
    if state is not None:
        yield pd.DataFrame([(path, state.hexdigest())], columns=["path", "ends_sha256"])


def _subtrees(nodes: DataFrame) -> DataFrame:
    """``leaves`` and ``saved`` summed over every node's subtree."""
    deepest = nodes.agg(F.max("depth").alias("d")).first()["d"] or 0
    sums = nodes.select("path", "anc", "leaves", "saved")
    for k in range(deepest.bit_length()):
        below = (
            sums.filter(F.size("anc") > k)
            .groupBy(F.col("anc")[k].alias("path"))
            .agg(F.sum("leaves").alias("leaves_below"), F.sum("saved").alias("saved_below"))
        )
        sums = cut(
            sums.join(below, "path", "left").select(
                "path",
                "anc",
                *[
                    (F.col(c) + F.coalesce(f"{c}_below", F.lit(0))).alias(c)
                    for c in ("leaves", "saved")
                ],
            ),
            "trie-sums",
        )
    return sums.select("path", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def trie(steps: DataFrame) -> DataFrame:
    """One row per node of the trie of the sequences in ``steps``.

    A step is a turn of a conversation: ``conv``, ``part`` and ``place`` (its order), ``turn``
    (16 bytes, null for none) and ``words``. Nodes have ``conv_id``, the smallest member, and
    ``depth``, which name them together, and what their members and subtrees add up to.
    """
    with_library(steps.sparkSession)
    order = ("conv", "part", "place")
    steps = steps.select(*_STEP)
    parts = parts_for(steps.count(), TASK_TURNS)
    local = cut(
        steps.repartitionByRange(parts, "conv").sortWithinPartitions(*order).mapInPandas(_shards, _LOCAL),
        "trie-shards",
    )
    merged = cut(
        local.groupBy("path").agg(
            F.min("conv").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.sum("n").alias("n_convs"),
            F.first("words").alias("words"),
            F.first("anc").alias("anc"),
        ),
        "trie-nodes",
    )
    kids = merged.filter("depth > 0").groupBy(F.col("anc")[0].alias("path")).agg(
        F.count(F.lit(1)).alias("kids")
    )
    nodes = cut(
        merged.join(kids, "path", "left")
        .withColumn("n_children", F.coalesce("kids", F.lit(0)))
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
        .drop("kids"),
        "trie-counted",
    )
    listed = local.filter("first_end IS NOT NULL").select("path", "first_end", "ends")
    ended = (
        listed.repartition(parts_for(listed.count(), ENDS_ROWS), "path")
        .sortWithinPartitions("path", "first_end")
        .mapInPandas(_hashed, "path binary, ends_sha256 string")
    )
    known = (
        nodes.join(_subtrees(nodes), "path")
        .join(ended, "path", "left")
        .withColumn("above", F.try_element_at("anc", F.lit(1)))
    )
    parents = nodes.filter("n_children > 0").select(
        F.col("path").alias("above"), F.col("conv_id").alias("parent_conv_id")
    )
    return known.join(parents, "above", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefixes(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    graft: bool = False,
) -> DataFrame:
    """The nodes of all prefixes of the conversations, or of the rebuilt ones (``grafted``)."""
    turns = numbered(conversations, id_col, turn_col, role_col, text_col)
    return trie(grafted(turns) if graft else whole(turns))
