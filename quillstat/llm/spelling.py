"""Spelling variants: words one letter apart, by pairs of forward and reversed trie nodes.

1. The distinct words, with their counts, are sorted by ranges and written. In each range a
   pass over the sorted words numbers the nodes of their trie: a word shares the nodes of
   its common prefix with the word before it and opens a new node for each further letter.
   Prefixes that a range shares with the one before keep the number they have there; which
   these are follows from the ranges' first and last words. The reversed words are numbered
   in the same way, so a prefix and a suffix of a word are two integers.
2. A word has a pair (prefix node, suffix node) for every letter skipped, and one for every
   place a letter could be inserted at. Words with the same skipped pair differ in that
   letter; a word whose skipped pair is another's place of insertion has one letter more.
   Numbers stand for strings exactly, so there is nothing to verify. Of a run of equal
   letters only the first one counts as left out, so every pair of words meets once.
3. Words that meet at a pair are at most the letters of the alphabet and one. They are sorted
   by count, in a window; each sends on how many it met and the commonest.
4. A word's form is its commonest near word, if it is ``RATIO`` times as common. Forms grow
   in count, so chains are short; they are followed to their ends by doubling.

Words are maximal runs of ``LETTERS`` with A-Z lower-cased. A null or empty text has none.
Nothing is deleted from words of documents without an id. Other columns are ignored; no rows,
or no words often enough, give no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.llm.tables import cut, parts_for, with_library

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2
# One run in so many has a letter deleted where the caller asks for it.
SLIP = 97
RANGE_WORDS = 50_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs(docs: DataFrame, id_col: str, text_col: str, least: int = LEAST_LETTERS) -> DataFrame:
    """Every run of at least ``least`` letters as ``id`` and ``word``."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run")).select(
        "id", F.translate("run", _UPPER, _UPPER.lower()).alias("word")
    )


def slipped(words: DataFrame, one_in: int = SLIP) -> DataFrame:
    """Runs with a letter deleted from one in so many, by a CRC of the id and the run."""
    spelled = F.concat(F.col("id").cast("string"), F.lit(":"), F.col("word")).cast("binary")
    crc = F.crc32(spelled)
    place = F.pmod(crc, F.length("word")).cast("int")
    short = F.concat(
        F.substr("word", F.lit(1), place), F.substr("word", place + 2, F.length("word"))
    )
    word = F.when(F.pmod(crc, F.lit(one_in)) == 0, short).otherwise(F.col("word"))
    return words.select("id", word.alias("word"))


def counted(
    words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """Distinct words that are long and common enough, as ``word`` and ``n``."""
    return (
        words.filter(F.length("word") >= least_letters)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_count)
    )


def common(a: str, b: str) -> int:
    """The number of letters that both begin with."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def opened(part: int, depth: int) -> int:
    """The number of a node that goes on in the next range: by its range and depth."""
    return -((part << 32) | depth) - 1


def carried(edges: list[tuple[int, str, str]]) -> dict[int, tuple[str, list[int], int]]:
    """For each range its last word, the nodes shared with the range before, by depth, and the
    depth down to which the last word's nodes go on in the next range (-1: none do)."""
    out, taken = {}, []
    for at, (part, first, last) in enumerate(edges):
        after = edges[at + 1][1] if at + 1 < len(edges) else None
        on = -1 if after is None else common(last, after)
        out[part] = (last, taken, on)
        through = min(common(first, last), len(taken) - 1)
        taken = [taken[d] if d <= through else opened(part, d) for d in range(on + 1)]
    return out


def number(words: list[str], part: int, last: str, taken: list[int], on: int) -> list[list[int]]:
    """The nodes on the path of each of the sorted words, from the root on."""
    path, before, fresh, paths = list(taken), "", part << 40, []
    for i, word in enumerate(words):
        keep = len(taken) if i == 0 else common(before, word) + 1
        path = path[:keep]
        ends = min(on, common(word, last))
        for depth in range(keep, len(word) + 1):
            if depth <= ends:
                path.append(opened(part, depth))
            else:
                path.append(fresh)
                fresh += 1
        paths.append(list(path))
        before = word
    return paths


def trie_nodes(words: DataFrame, ranges: int) -> DataFrame:
    """``word``, its ``rank`` in code-point order, and ``nodes``, the numbers on its path."""
    sorted_ = cut(
        words.select("word")
        .repartitionByRange(ranges, "word")
        .withColumn("part", F.spark_partition_id()),
        "spelling-ranges",
    )
    edges = sorted_.groupBy("part").agg(F.min("word"), F.max("word")).orderBy("part").collect()
    known = carried([tuple(e) for e in edges])

    def nodes(pdf: pd.DataFrame) -> pd.DataFrame:
        part, own = int(pdf["part"].iloc[0]), sorted(pdf["word"])
        ranks = [(part << 40) | i for i in range(len(own))]
        return pd.DataFrame({"word": own, "rank": ranks, "nodes": number(own, part, *known[part])})

    return sorted_.groupBy("part").applyInPandas(nodes, "word string, rank long, nodes array<long>")


def pairs(words: DataFrame, ranges: int) -> tuple[DataFrame, DataFrame]:
    """All pairs of nodes of the words (``prefix``, ``suffix`` and ``met``, who and how), and the
    words with their ``rank``."""
    back = words.select(F.reverse("word").alias("word"))
    ahead = trie_nodes(words, ranges)
    behind = trie_nodes(back, ranges).select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    both = cut(words.join(ahead, "word").join(behind, "word"), "spelling-words")
    letters, length = F.split("word", ""), F.length("word")

    def at(nodes: str, place: Column) -> Column:
        return F.element_at(nodes, (place + 1).cast("int"))

    def pair(prefix: Column, suffix: Column, skips: bool, first: Column) -> Column:
        met = F.struct(
            F.col("rank").alias("rank"), F.col("n").alias("n"),
            F.lit(skips).alias("skips"), first.alias("first"),
        )
        return F.struct(prefix.alias("prefix"), suffix.alias("suffix"), met.alias("met"))

    def skipped(i: Column) -> Column:
        first = (i == 0) | (
            F.get(F.col("letters"), i) != F.get(F.col("letters"), F.greatest(i - 1, F.lit(0)))
        )
        return pair(at("nodes", i), at("back", F.col("length") - 1 - i), True, first)

    def inserted(i: Column) -> Column:
        return pair(at("nodes", i), at("back", F.col("length") - i), False, F.lit(True))

    rows = both.withColumn("letters", letters).withColumn("length", length)
    made = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("length") - 1), skipped),
        F.transform(F.sequence(F.lit(0), F.col("length")), inserted),
    )
    return rows.select(F.inline(made)), both.select("word", "rank", "n")


def neighbours(met: DataFrame) -> DataFrame:
    """For each word with near ones: ``rank``, their number ``n_near`` and the ``best``.

    At a pair each word occurs once, and one word at most has it as a place of insertion, so
    a word's best is the commonest that skips there, or the next if that is itself.
    """
    here = Window.partitionBy("prefix", "suffix")
    commonest = here.orderBy(F.desc("met.n"), "met.rank").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rank, skips, first = F.col("met.rank"), F.col("met.skips"), F.col("met.first")
    me = F.struct(F.col("met.n").alias("n"), (-rank).alias("order"))
    seen = met.select(
        rank.alias("rank"), skips.alias("skips"), first.alias("first"),
        F.count(F.lit(1)).over(commonest).alias("words"),
        F.count_if(skips & first).over(commonest).alias("firsts"),
        F.count_if(skips).over(commonest).alias("skipping"),
        F.nth_value(F.when(skips, me), 1, ignoreNulls=True).over(commonest).alias("one"),
        F.nth_value(F.when(skips, me), 2, ignoreNulls=True).over(commonest).alias("two"),
        F.nth_value(F.when(skips & first, me), 1, ignoreNulls=True).over(commonest).alias("one_first"),
        F.nth_value(F.when(~skips, me), 1, ignoreNulls=True).over(commonest).alias("whole"),
    ).filter(F.col("words") > 1)
    other = F.when(F.col("one.order") == -F.col("rank"), F.col("two")).otherwise(F.col("one"))
    longer = F.when(F.col("first"), F.col("whole"))
    found = seen.select(
        "rank",
        F.when(F.col("skips"), F.col("skipping") - 1 + longer.isNotNull().cast("long"))
        .otherwise(F.col("firsts"))
        .alias("n_near"),
        F.when(F.col("skips"), F.greatest(other, longer)).otherwise(F.col("one_first")).alias("best"),
    )
    return (
        found.filter(F.col("n_near") > 0)
        .groupBy("rank")
        .agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    )


def ends(forms: DataFrame) -> DataFrame:
    """The end of each chain: ``rank`` and ``to``, doubled until nothing moves."""
    now = cut(forms, "spelling-forms")
    while True:
        ahead = now.select(F.col("rank").alias("to"), F.col("to").alias("further"))
        now = cut(
            now.join(ahead, "to", "left").select(
                "rank", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")
            ),
            "spelling-ends",
        )
        if not now.filter("moved").limit(1).count():
            return now.select("rank", "to")
        now = now.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for distinct ``word`` and ``n``."""
    with_library(words.sparkSession)
    words = cut(words.select("word", "n"), "spelling-counted")
    met, ranked = pairs(words, parts_for(words.count(), RANGE_WORDS))
    near = cut(
        ranked.join(neighbours(met), "rank", "left").select(
            "rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.order")).alias("to"),
        ),
        "spelling-near",
    )
    last = ends(near.filter(F.col("to").isNotNull()).select("rank", "to"))
    spelled = near.select(F.col("rank").alias("to"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    last = last.join(spelled.select("to", F.col("form").alias("root")), "to").select("rank", "root")
    return (
        near.join(spelled, "to", "left")
        .join(last, "rank", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int | None = None
) -> DataFrame:
    """The variants of the words of ``docs``; ``slip`` deletes a letter of one run in so many."""
    words = runs(docs, id_col, text_col)
    return variants(counted(slipped(words, slip) if slip else words))
