"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram of
letters is bound into one vector by multiplying the letters' vectors, each rotated by
its place. A text is the sum of its n-gram vectors, a language the sum of its training
texts; a text gets the language whose vector has the largest cosine with its own.
Letters are lower-cased, and any run of other characters counts as one blank.

Training takes at most ``train_rows`` labelled texts per language, chosen by a hash of
the id. Their sums are formed by Spark per partition and language. All rows are scored.

Defined results: null texts and texts without a letter get ``und`` and score 0; a
language column may hold nulls, which are not learned; without any labelled text
every text gets ``und``; equal cosines go to the language first in order; no rows give
no rows. Repeated and null ids are scored like any other. Extra columns are ignored by
``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.arrays import batches, dense
from quillstat.llm.tables import small_batches, with_library

DIMENSIONS = 1024
NGRAM = 3
TRAIN_ROWS = 4000
UNKNOWN = "und"
MIN_SCORE = 0.001
# Texts are handled in lots of about so many characters.
LOT = 1_000_000
LOT_TEXTS = 2000
# N-grams whose vectors are made at once, and cells of the table of their counts.
BLOCK = 4096
BLOCK_CELLS = 8_000_000
# The table is used if more than one cell in so many is filled; else pairs are added up, so
# many at once.
DENSE = 64
PAIRS = 4096
BLANK = 32


@cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    points = (chr(i).isalpha() for i in range(0x110000))
    return np.fromiter(points, bool, 0x110000)


@lru_cache(maxsize=1 << 15)
def _letter_vector(point: int, dimensions: int) -> np.ndarray:
    drawn = np.random.default_rng([point, dimensions]).integers(0, 2, dimensions, np.int8)
    return drawn * np.int8(2) - np.int8(1)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and blanks of all texts, the text of each, and the letters per text."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(texts))
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le"), "<u4")
    letter = _letters()[points]
    of = np.repeat(np.arange(len(texts)), lengths)
    known = np.bincount(of[letter], minlength=len(texts))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first blank after a letter stays
    return np.where(letter, points, BLANK)[keep].astype(np.int64), of[keep], known


def profiles(texts: list[str], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """The bundled n-gram vector of each text, and its number of letters."""
    codes, of, known = _codes(texts)
    sums = np.zeros((len(texts), dimensions), np.float32)
    # Every text starts with a blank, which the one before it ends with.
    codes = np.concatenate([[BLANK], codes])
    of = np.concatenate([of[:1], of])
    if len(codes) < NGRAM:
        return sums, known
    alphabet, letters = dense(codes, 0x110000)
    grams, spaces = letters, len(alphabet)
    parts = [np.arange(len(alphabet))[:, None]]
    for place in range(1, NGRAM):
        tail = letters[place:]
        distinct, grams = dense(grams[:-1].astype(np.int64) * len(alphabet) + tail, spaces * len(alphabet))
        head = parts[-1][distinct // len(alphabet)]
        parts.append(np.concatenate([head, (distinct % len(alphabet))[:, None]], axis=1))
        spaces = len(distinct)
    owner = of[NGRAM - 1 :]
    whole = of[1 : len(owner) + 1] == owner  # the n-gram lies in one text, after its blank
    if len(texts) * spaces <= BLOCK_CELLS:
        counts = np.bincount(owner[whole] * spaces + grams[whole], minlength=len(texts) * spaces)
        counts = counts.reshape(len(texts), spaces).astype(np.float32)
        for low in range(0, spaces, BLOCK):
            bound = _bound(alphabet, parts[-1][low : low + BLOCK], dimensions)
            sums += counts[:, low : low + BLOCK] @ bound.astype(np.float32)
        return sums, known
    # How often each text has each n-gram, by n-gram; most pairs do not occur.
    pairs = np.sort(grams[whole].astype(np.int64) * len(texts) + owner[whole])
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    times = np.diff(first, append=len(pairs)).astype(np.float32)
    gram, text = np.divmod(pairs[first], len(texts))
    block = min(BLOCK, max(256, BLOCK_CELLS // len(texts)))
    for low in range(0, spaces, block):
        begin, end = np.searchsorted(gram, [low, low + block])
        if begin < end:
            bound = _bound(alphabet, parts[-1][low : low + block], dimensions)
            _add(sums, bound, gram[begin:end] - low, text[begin:end], times[begin:end])
    return sums, known


def _bound(alphabet: np.ndarray, grams: np.ndarray, dimensions: int) -> np.ndarray:
    """The vectors of n-grams, given by the numbers of their letters."""
    used, place = np.unique(grams, return_inverse=True)
    vectors = np.stack([_letter_vector(int(p), dimensions) for p in alphabet[used]])
    place = place.reshape(grams.shape)
    bound = np.ones((len(grams), dimensions), np.int8)
    for at in range(NGRAM):
        bound *= np.roll(vectors, NGRAM - 1 - at, axis=1)[place[:, at]]
    return bound


def _add(
    sums: np.ndarray, bound: np.ndarray, gram: np.ndarray, text: np.ndarray, times: np.ndarray
) -> None:
    """Add the n-grams' vectors, as often as they occur, to those of their texts."""
    if len(gram) * DENSE > len(sums) * len(bound):
        counts = np.zeros((len(sums), len(bound)), np.float32)
        counts[text, gram] = times
        sums += counts @ bound.astype(np.float32)
        return
    order = np.argsort(text, kind="stable")
    for at in range(0, len(order), PAIRS):
        own = order[at : at + PAIRS]
        first = np.flatnonzero(np.diff(text[own], prepend=-1))
        rows = bound[gram[own]] * times[own, None]
        sums[text[own][first]] += np.add.reduceat(rows, first, axis=0)


def _lots(texts: Iterable[str | None]) -> Iterator[list[str]]:
    known = [t or "" for t in texts]
    # Every text has a vector, however short it is.
    for part in batches([len(t) + LOT // LOT_TEXTS for t in known], LOT):
        yield known[part]


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def learn(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_rows: int = TRAIN_ROWS,
) -> dict[str, np.ndarray]:
    """The unit vector of each language, from at most about ``train_rows`` texts of each."""
    with_library(labelled.sparkSession)
    small_batches(labelled.sparkSession)
    known = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = dict(known.groupBy(F.col(lang_col)).count().collect())
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("train")), F.lit(1 << 30))
    limit = F.lit(0)
    for lang, rows in counts.items():
        share = int(min(1, train_rows / rows) * (1 << 30))
        limit = F.when(F.col(lang_col) == lang, share).otherwise(limit)
    chosen = known.filter(draw < limit).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )

    def add_up(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in parts:
            for lang, own in pdf.groupby("lang"):
                for lot in _lots(own["text"]):
                    vectors, _ = profiles(lot)
                    total = _unit(vectors).sum(axis=0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + total
        if sums:
            yield pd.DataFrame({"lang": list(sums), "sum": [v.tolist() for v in sums.values()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.stack(pdf["sum"]).sum(axis=0)
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "sum": [total.tolist()]})

    kind = "lang string, sum array<double>"
    merged = chosen.mapInPandas(add_up, kind).groupBy("lang").applyInPandas(merge, kind)
    rows = sorted(merged.collect())
    return {lang: _unit(np.array([total]))[0].astype(np.float32) for lang, total in rows}


def _scored(texts: Iterable[str | None], languages: dict[str, np.ndarray]) -> pd.DataFrame:
    names = [*languages, UNKNOWN]
    best, scores = [], []
    for lot in _lots(texts):
        vectors, known = profiles(lot)
        if languages:
            cosine = _unit(vectors) @ np.stack(list(languages.values())).T
            top = np.where(known > 0, cosine.argmax(axis=1), len(languages))
            score = np.where(known > 0, cosine.max(axis=1).clip(0, 1), 0)
        else:
            top, score = np.zeros(len(lot), int), np.zeros(len(lot))
        best += [names[i] for i in top]
        scores += [float(s) for s in score]
    return pd.DataFrame({"lang": best, "score": scores})


def score_column(text: Column, languages: dict[str, np.ndarray]) -> Column:
    """A struct of the predicted ``lang`` and its ``score``."""

    @F.pandas_udf("lang string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        return _scored(texts, languages)

    return scored(text)


def held_out_rows(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def predict(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``."""
    languages = learn(docs.filter(~held_out_rows(id_col)), id_col, text_col, lang_col)
    scored = docs.select(
        F.col(id_col).alias(id_col),
        held_out_rows(id_col).alias("held_out"),
        score_column(F.col(text_col), languages).alias("scored"),
    )
    return scored.select(
        id_col, "held_out", F.col("scored.lang").alias("lang_pred"), F.col("scored.score")
    )


def keep_known(
    docs: DataFrame,
    min_score: float = MIN_SCORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The documents in a learned language: those without a letter or below ``min_score`` go.

    A short text is far from every language whatever it says, so the default rejects texts
    without a letter, and of others only the few whose cosine with every language happens
    to be at or below zero. Texts in a language that was not learned mostly stay; a
    higher ``min_score`` rejects them together with short texts.
    """
    languages = learn(docs.filter(~held_out_rows(id_col)), id_col, text_col, lang_col)
    scored = docs.select(
        F.struct("*").alias("row"), score_column(F.col(text_col), languages).alias("scored")
    )
    known = (F.col("scored.lang") != UNKNOWN) & (F.col("scored.score") >= min_score)
    return scored.filter(known).select("row.*")
