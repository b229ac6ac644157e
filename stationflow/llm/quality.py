"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage is encoded by form features and
a tanh layer, a gated attention layer gives each passage its share of the
document, and the shares' weighted sum of the encodings is scored.  Only
document labels are known; they train all three layers together.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.labelled import fold, training_rows
from stationflow.llm.scratch import Scratch, small_batches

ship(__name__)

FOLDS, HELD_OUT = 3, 1
#: Labelled documents that the model is fitted on at most.
SAMPLE = 5_000
#: Passages that it is fitted on at most, and those of one document.
PASSAGES, OF_ONE = 400_000, 4_000
#: Words of a passage; a document's last passage may be shorter.
PASSAGE = 80
HIDDEN, GATES = 16, 8
EPOCHS, RATE, DECAY = 250, 0.03, 1e-4

#: Kinds of bytes of a UTF-8 text; bytes above ASCII count as letters.
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_NO_SIGNS = bytes([*range(0, 33), *_DIGITS, *_CAPITALS, *range(97, 123), *range(127, 256)])
_SIGN_FIRST = re.compile(rb" [!-/:-@\[-`{-~]")
_ENDING = re.compile(rb"[.!?] ")


def passage_features(words: list[bytes]) -> list[float]:
    """Form of one passage: shares of kinds of characters and words, repetition, lengths."""
    n = max(len(words), 1)
    spaced = b" " + b" ".join(words) + b" "
    chars = max(len(spaced) - len(words) - 1, 1)
    signs = spaced.translate(None, _NO_SIGNS)
    kinds = Counter(signs)
    capitals = len(spaced) - len(spaced.translate(None, _CAPITALS))
    digits = len(spaced) - len(spaced.translate(None, _DIGITS))
    counts = Counter(words)
    lengths = [*map(len, words)] or [0]
    mean = sum(lengths) / n
    return [
        (chars - digits - len(signs)) / chars,
        capitals / chars,
        digits / chars,
        len(signs) / chars,
        max(kinds.values(), default=0) / n,
        len(kinds) / 10,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        mean / 10,
        max(sum(x * x for x in lengths) / n - mean * mean, 0) ** 0.5 / 5,
        len(_ENDING.findall(spaced)) / n,
        len(_SIGN_FIRST.findall(spaced)) / n,
        log1p(n) / 5,
    ]


WIDTH = 14


def bag(text: str | None) -> np.ndarray:
    """Features of all passages of a text; an empty text is one empty passage."""
    words = (text or "").encode().split()
    return np.array([passage_features(words[i : i + PASSAGE]) for i in range(0, max(len(words), 1), PASSAGE)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class QualityModel:
    """``parts``: W, b (encoder), V, U, w (gated attention), c, d (score); with the features' mean and scale."""

    parts: tuple[np.ndarray, ...]
    mean: np.ndarray
    scale: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        bags = [bag(t) for t in texts]
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return forward(self.parts, (np.concatenate(bags) - self.mean) / self.scale, starts)[0]


def forward(parts, x: np.ndarray, starts: np.ndarray):
    """Scores of the bags that begin at ``starts`` in the passages ``x``, and what the gradients need."""
    W, b, V, U, w, c, d = parts
    owner = np.zeros(len(x), dtype=int)
    owner[starts[1:]] = 1
    owner = np.cumsum(owner)
    z = np.tanh(x @ W + b)
    t, g = np.tanh(z @ V), _sigmoid(z @ U)
    e = (t * g) @ w
    e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
    a = e / np.add.reduceat(e, starts)[owner]
    pooled = np.add.reduceat(a[:, None] * z, starts, axis=0)
    return _sigmoid(pooled @ c + d), (owner, z, t, g, a, pooled)


def train(bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> QualityModel:
    """Full-batch Adam on the mean cross-entropy of the documents."""
    x = np.concatenate(bags)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    parts = [small(WIDTH, HIDDEN), np.zeros(HIDDEN), small(HIDDEN, GATES), small(HIDDEN, GATES), small(GATES), small(HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, epochs + 1):
        W, b, V, U, w, c, d = parts
        p, (owner, z, t, g, a, pooled) = forward(parts, x, starts)
        out = (p - y) / len(y)
        dz = a[:, None] * out[owner, None] * c
        da = (z @ c) * out[owner]
        de = a * (da - np.add.reduceat(a * da, starts)[owner])
        dt, dg = de[:, None] * w * g * (1 - t**2), de[:, None] * w * t * g * (1 - g)
        dz += dt @ V.T + dg @ U.T
        dh = dz * (1 - z**2)
        grads = [x.T @ dh, dh.sum(axis=0), z.T @ dt, z.T @ dg, (t * g).T @ de, pooled.T @ out, np.array([out.sum()])]
        for i, grad in enumerate(grads):
            grad = grad + DECAY * parts[i]
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad**2
            parts[i] = parts[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return QualityModel(tuple(parts), mean, scale)


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield pd.DataFrame({"y": rows["y"], "x": [bag(t).ravel() for t in rows["text"]]})


def training_bags(rows: DataFrame, scratch: Scratch, passages: int = PASSAGES, of_one: int = OF_ONE) -> DataFrame:
    """(y, x) of ``rows`` (text, y): features of ``passages`` passages at most, by the hash of the features.

    Documents of more than ``of_one`` passages aren't learned from: the driver
    holds ``passages`` rows of ``WIDTH`` doubles, however long the texts are.
    """
    bags = scratch.table(rows.mapInPandas(_bags, "y int, x array<double>"), "bags")
    sized = bags.select("y", "x", F.xxhash64("x", "y").alias("place"), (F.size("x") / WIDTH).alias("n")).where(F.col("n") <= of_one)
    # one task sums the sizes of the bounded sample's documents, without their features; equal places are equal bags
    places = sized.groupBy("place").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.orderBy("place"))
    fit = places.select("place", upto.alias("upto")).where(F.col("upto") <= passages).select("place")
    return sized.join(fit, "place", "left_semi").select("y", "x")


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fit on labelled rows whose fold isn't 1, ``sample`` documents at most; see ``training_bags``.

    Without any labelled row the model scores every text 0.5.
    """
    small_batches(docs.sparkSession)
    learn = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    rows = training_rows(docs, labels, "quality", learn, sample)
    found = training_bags(rows, Scratch(docs.sparkSession, "quality")).toPandas()
    if not len(found):
        flat = [np.zeros(s) for s in ((WIDTH, HIDDEN), HIDDEN, (HIDDEN, GATES), (HIDDEN, GATES), GATES, HIDDEN, 1)]
        return QualityModel(tuple(flat), np.zeros(WIDTH), np.ones(WIDTH))
    bags = [np.array(x).reshape(-1, WIDTH) for x in found["x"]]
    y = found["y"].to_numpy().astype(float)
    order = sorted(range(len(y)), key=lambda i: (y[i], bags[i].tobytes()))  # the same sums for any partitioning
    return train([bags[i] for i in order], y[order])


def quality_score(model: QualityModel):
    """Column function text -> score in 0..1; a null text scores as an empty one."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()), dtype="float64")

    return score


def quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    ``held_out``: the fold of the id is 1 (false for a null id).  Repeated rows
    score alike.  Only the text enters the score; further columns aren't read.
    """
    scored = docs.select("doc_id", quality_score(model)("text").alias("score"))
    held: Column = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
