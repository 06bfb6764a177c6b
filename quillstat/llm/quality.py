"""A quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words. Every passage is measured (kinds
of bytes, hashed words, repetition) and encoded by a learned layer. A gated attention
gives each passage a weight within its document; the score is a logistic function of
the weighted sum of the passages' codes. Only documents have labels.

Measuring and scoring run on all rows inside Spark tasks. The model is fitted with
numpy on at most about ``train_rows`` labelled documents, chosen by a hash of the id.

Defined results: a null or wordless text is one passage without words and gets a score
like any other; labels that are null or match no document are not learned, and of
several labels each counts; without labels every score is 0.5; no rows give no rows.
Neither id nor other columns reach the score, so equal texts have equal scores. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.llm.arrays import batches, hash_words, split_words
from quillstat.llm.langid import held_out_rows
from quillstat.llm.tables import text_of, with_library

PASSAGE = 64
TRAIN_ROWS = 6000
THRESHOLD = 0.3
WORD_SLOTS = 64
CODE = 24
GATE = 12
EPOCHS = 30
BATCH = 64
RATE = 0.005
DECAY = 1e-4
# Texts are handled in lots of about so many bytes.
LOT = 2_000_000


def _kinds() -> np.ndarray:
    """The kind of each byte: letters, digits and blanks by class, other ASCII one by one."""
    kind = np.zeros(256, np.int64)
    kind[ord("a") : ord("z") + 1] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[0x80:] = 4
    kind[0x0A] = 5
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 6
    signs = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
    kind[signs] = np.arange(7, 7 + len(signs))
    return kind


KIND = _kinds()
KINDS = int(KIND.max()) + 1
FEATURES = KINDS + WORD_SLOTS + 6


def measure(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the number of passages of every text (at least 1)."""
    laid = split_words(texts)
    words = np.diff(laid.first)
    per_text = np.maximum(1, -(-words // PASSAGE))
    first_passage = np.concatenate([[0], np.cumsum(per_text)])
    total = int(first_passage[-1])
    of = laid.of
    inside = np.arange(len(of)) - laid.first[:-1][of]
    passage = first_passage[of] + inside // PASSAGE
    # Bytes belong to the passage of the last word begun before them.
    owner = np.zeros(laid.offset[-1], np.int64)
    owner[laid.offset[:-1]] = first_passage[:-1]
    owner[laid.start] = passage
    owner = np.maximum.accumulate(owner)
    signs = np.bincount(owner * KINDS + KIND[laid.buf[: laid.offset[-1]]], minlength=total * KINDS)
    signs = signs.reshape(total, KINDS).astype(np.float32)
    count = np.bincount(passage, minlength=total).astype(np.float32)
    safe = np.maximum(count, 1)
    hashed = hash_words(laid)
    slots = np.bincount(
        passage * WORD_SLOTS + (hashed >> np.uint64(58)).astype(np.int64),
        minlength=total * WORD_SLOTS,
    ).reshape(total, WORD_SLOTS)
    again = np.zeros(len(of), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((hashed, passage))
    new = np.ones(len(of), bool)
    new[1:] = (hashed[order][1:] != hashed[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order][new], minlength=total)
    length = np.bincount(passage, weights=laid.length, minlength=total)
    longest = np.zeros(total)
    np.maximum.at(longest, passage, laid.length)
    rest = [
        np.log1p(count),
        distinct / safe,
        np.bincount(passage[again], minlength=total) / safe,
        length / safe / 10,
        np.log1p(longest),
        signs[:, 5] / safe,
    ]
    share = np.sqrt(signs / np.maximum(signs.sum(axis=1, keepdims=True), 1))
    features = np.concatenate([share, slots / safe[:, None], np.stack(rest, axis=1)], axis=1)
    return features.astype(np.float32), per_text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Bags:
    """Passages of several documents, and where each document begins."""

    x: np.ndarray
    per_text: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.per_text)[:-1]])

    @property
    def of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.per_text)), self.per_text)


class Attention:
    """Encoder, gated attention and output, as one set of numpy arrays."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale

        def drawn(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.weights = {
            "encode": drawn(len(mean), CODE),
            "shift": np.zeros(CODE, np.float32),
            "tanh": drawn(CODE, GATE),
            "gate": drawn(CODE, GATE),
            "attend": drawn(GATE),
            "out": drawn(CODE),
            "bias": np.zeros(1, np.float32),
        }

    def forward(self, bags: Bags) -> dict[str, np.ndarray]:
        w, first, of = self.weights, bags.first, bags.of
        x = np.clip((bags.x - self.mean) / self.scale, -8, 8)
        code = np.tanh(x @ w["encode"] + w["shift"])
        bent, gate = np.tanh(code @ w["tanh"]), _sigmoid(code @ w["gate"])
        energy = (bent * gate) @ w["attend"]
        energy = np.exp(energy - np.maximum.reduceat(energy, first)[of])
        share = energy / np.add.reduceat(energy, first)[of]
        whole = np.add.reduceat(code * share[:, None], first)
        score = _sigmoid(whole @ w["out"] + w["bias"])
        return {
            "x": x, "code": code, "bent": bent, "gate": gate,
            "share": share, "whole": whole, "score": score,
        }

    def gradients(self, bags: Bags, label: np.ndarray) -> dict[str, np.ndarray]:
        w, f, of = self.weights, self.forward(bags), bags.of
        error = (f["score"] - label) / len(label)
        to_code = error[of][:, None] * w["out"]
        pull = (f["code"] * to_code).sum(axis=1)
        mean_pull = np.add.reduceat(pull * f["share"], bags.first)[of]
        energy = f["share"] * (pull - mean_pull)
        mixed = energy[:, None] * w["attend"]
        bent = mixed * f["gate"] * (1 - f["bent"] ** 2)
        gate = mixed * f["bent"] * f["gate"] * (1 - f["gate"])
        code = to_code * f["share"][:, None] + bent @ w["tanh"].T + gate @ w["gate"].T
        code *= 1 - f["code"] ** 2
        return {
            "encode": f["x"].T @ code,
            "shift": code.sum(axis=0),
            "tanh": f["code"].T @ bent,
            "gate": f["code"].T @ gate,
            "attend": (f["bent"] * f["gate"]).T @ energy,
            "out": f["whole"].T @ error,
            "bias": error.sum(keepdims=True),
        }


def fit(bags: Bags, label: np.ndarray, seed: int = 0) -> Attention:
    """Adam on batches of documents in a seeded order."""
    model = Attention(bags.x.mean(axis=0), bags.x.std(axis=0) + 0.02, seed)
    rng, first = np.random.default_rng(seed), bags.first
    one = {k: np.zeros_like(v) for k, v in model.weights.items()}
    two = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            rows = [np.arange(first[i], first[i] + bags.per_text[i]) for i in chosen]
            part = Bags(bags.x[np.concatenate(rows)], bags.per_text[chosen])
            step += 1
            for name, slope in model.gradients(part, label[chosen]).items():
                slope = slope + DECAY * model.weights[name]
                one[name] = 0.9 * one[name] + 0.1 * slope
                two[name] = 0.999 * two[name] + 0.001 * slope**2
                size = np.sqrt(two[name] / (1 - 0.999**step)) + 1e-8
                model.weights[name] -= RATE * one[name] / (1 - 0.9**step) / size
    return model


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Attention | None:
    """Fit the model on at most about ``train_rows`` labelled documents."""
    with_library(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    rows = known.count()
    share = int(min(1, train_rows / max(rows, 1)) * (1 << 30))
    chosen = known.filter(draw_of(id_col) < share).select(
        F.col(id_col).alias("label_id"), F.col(label_col).cast("float").alias("label")
    )
    # Bounded by train_rows, so this side may always be broadcast.
    sample = (
        docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        .filter(draw_of("id") < share)
        .join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
        .select("label", "text", F.xxhash64("id", "text").alias("place"))
    )

    def features(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for lot in batches([len(t) for t in pdf["text"]], LOT):
                own = pdf.iloc[lot]
                x, per_text = measure(own["text"].tolist())
                pieces = np.split(x, np.cumsum(per_text)[:-1])
                yield pd.DataFrame(
                    {"place": own["place"].to_numpy(), "label": own["label"].to_numpy(),
                     "x": [p.tobytes() for p in pieces]}
                )

    found = sample.mapInPandas(features, "place long, label float, x binary").toPandas()
    if found.empty:
        return None
    # A fixed order, so that the fit does not depend on which task came first.
    found = found.sort_values(["place", "label"])
    pieces = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found["x"]]
    bags = Bags(np.concatenate(pieces), np.array([len(p) for p in pieces]))
    return fit(bags, found["label"].to_numpy())


def draw_of(id_col: str) -> Column:
    """The same draw for a document as for its label."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("train")), F.lit(1 << 30))


def scores(texts: Iterable[bytes], model: Attention | None) -> np.ndarray:
    texts = list(texts)
    if model is None:
        return np.full(len(texts), 0.5)
    found = [np.zeros(0)]
    for lot in batches([len(t) for t in texts], LOT):
        x, per_text = measure(texts[lot])
        found.append(model.forward(Bags(x, per_text))["score"])
    return np.concatenate(found).astype(np.float64)


def score_column(text: Column, model: Attention | None) -> Column:
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(texts, model))

    return scored(text)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted``."""
    with_library(docs.sparkSession)
    model = learn(docs, labels.filter(~held_out_rows(id_col)), id_col, text_col, label_col)
    scored = docs.select(
        F.col(id_col).alias(id_col),
        held_out_rows(id_col).alias("held_out"),
        score_column(text_of(text_col), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
