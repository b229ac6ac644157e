"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first: look-alike letters of other scripts and digits or signs
that stand for letters become the Latin letters they imitate, everything that
is no letter becomes a space.  Lexicon entries are beginnings of folded words
with weights learned from labels (log-odds of the share of documents that hold
them).  One pass of the automaton finds the entries and the exception phrases;
hits inside an exception don't count.  The weights found, as they are and
normalised by length, give the score through a logistic function.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.labelled import fold, training_rows
from stationflow.llm.scratch import small_batches

ship(__name__)

FOLDS = 5
#: Labelled documents that the model is fitted on at most, and entries of the lexicon.
SAMPLE = 12_000
LEXICON = 3_000
#: Lengths of word beginnings that may become entries.
SHORTEST, LONGEST = 4, 8
#: Distinct beginnings that a task counts before it passes its counts on.
PART = 200_000

# Entries that need no labels, phrases that are no insult, and look-alikes of Latin letters.
SEEDS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
SEED_WEIGHT = 4.0
EXCEPTIONS = ("clown fish", "idiot proof", "trash bag", "trash bin", "trash can")
LOOK_ALIKES = {
    "a": "@4аαａ", "b": "8Ьｂ", "c": "сϲｃ", "d": "ԁｄ",
    "e": "3еεєｅ", "g": "9ɡｇ", "h": "һｈ", "i": "1іιıｉ",
    "j": "јｊ", "k": "кκｋ", "l": "ӏｌ", "m": "мｍ", "n": "ոｎ",
    "o": "0оοｏ", "p": "рρｐ", "s": "5$ѕｓ", "t": "7тτｔ",
    "u": "սυｕ", "v": "ѵνｖ", "w": "ѡｗ", "x": "хχｘ",
    "y": "уγｙ", "z": "2ｚ",
}


class _Folds(dict):
    """``str.translate`` table: look-alikes to letters, what is no letter to a space."""

    def __init__(self):
        super().__init__({ord(c): to for to, like in LOOK_ALIKES.items() for c in like})

    def __missing__(self, code: int) -> int:
        self[code] = code if chr(code).isalpha() else 32
        return self[code]


_FOLDS = _Folds()


def fold_text(text: str | None) -> str:
    """Folded words, each with one space before it, and a space at the end."""
    return " " + " ".join((text or "").lower().translate(_FOLDS).split()) + " "


@dataclass(frozen=True)
class ToxicityModel:
    """``weights``: word beginnings to weights; ``coefficients``: of the features, the constant first."""

    weights: dict[str, float]
    coefficients: tuple[float, ...]

    def matcher(self):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            automaton.add_word(" " + entry, (len(entry) + 1, weight))
        for phrase in EXCEPTIONS:
            automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
        automaton.make_automaton()
        return automaton

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: weights found, the same per 100 words, the largest, hits per 100 words."""
        find = self.matcher().iter
        rows = np.zeros((len(texts), 5))
        for row, text in zip(rows, texts, strict=True):
            folded = fold_text(text)
            best, excepted = {}, []
            for end, (length, weight) in find(folded):
                start = end - length + 1
                if weight is None:
                    excepted.append((start, end - 1))
                else:
                    best[start] = max(best.get(start, 0.0), weight)
            for a, b in excepted:
                for start in [s for s in best if a <= s < b]:
                    del best[start]
            words = folded.count(" ") - 1 or 1
            total = sum(best.values())
            row[:] = 1, np.log1p(total), np.log1p(100 * total / words), max(best.values(), default=0), np.log1p(100 * len(best) / words)
        return rows

    def score(self, texts: list[str | None]) -> np.ndarray:
        return _logistic(self.features(texts) @ np.array(self.coefficients))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _count_beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, y) -> (entry, clean, toxic): documents that hold a beginning, summed up per task."""
    counts = (Counter(), Counter())

    def passed() -> pa.RecordBatch:
        entries = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(entries, pa.string()), *(pa.array([c[e] for e in entries], pa.int64()) for c in counts)]
        return pa.RecordBatch.from_arrays(columns, names=["entry", "clean", "toxic"])

    for batch in batches:
        for text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = set(fold_text(text).split())
            counts[y].update({w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)})
            if len(counts[0]) + len(counts[1]) > PART:
                yield passed()
                counts = (Counter(), Counter())
    yield passed()


def learn_lexicon(sample: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Weights of the beginnings that tell the labels apart best; ``sample``: (text, y)."""
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    weights = dict.fromkeys(SEEDS, SEED_WEIGHT)
    if len(n) < 2:
        return weights
    counted = sample.select("text", "y").mapInArrow(_count_beginnings, "entry string, clean long, toxic long")
    total = counted.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 4")
    p, q = (F.col("toxic") + 0.5) / (n[1] + 1), (F.col("clean") + 0.5) / (n[0] + 1)
    weight = F.log(p / q)
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = (
        total.select("entry", "toxic", weight.alias("weight"), (weight / error).alias("z"))
        .where("weight >= 1 AND z >= 3")
        .orderBy(F.desc("z"), "entry")
        .limit(size)
    )
    found = {r["entry"]: r for r in best.collect()}
    # a beginning that is always followed by the same letter says less than the longer one
    shadowed = {e[:-1] for e, r in found.items() if e[:-1] in found and found[e[:-1]]["toxic"] == r["toxic"]}
    return weights | {e: r["weight"] for e, r in found.items() if e not in shadowed}


def _feature_rows(model: ToxicityModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"y": rows["y"], "x": list(model.features(rows["text"].tolist()))})

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> tuple[float, ...]:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = _logistic(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


#: Coefficients where the labels can't give any: score 0.5 is passed at about one seed in 30 words.
DEFAULT = (-4.0, 1.0, 1.0, 0.0, 0.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on labelled rows whose fold isn't 0, ``sample`` at most.

    Without rows of both labels the seed entries and fixed coefficients serve.
    """
    small_batches(docs.sparkSession)
    train = fold(F.col("doc_id"), FOLDS) != 0
    rows = training_rows(docs, labels, "toxic", train, sample)
    model = ToxicityModel(learn_lexicon(rows), DEFAULT)
    found = rows.mapInPandas(_feature_rows(model), "y int, x array<double>").toPandas()
    if found["y"].nunique() < 2:
        return model
    x = np.array(found["x"].tolist())
    order = np.lexsort((found["y"].to_numpy(), *x.T))  # the same sums for any partitioning
    return ToxicityModel(model.weights, fit_logistic(x[order], found["y"].to_numpy()[order].astype(float)))


def toxicity_score(model: ToxicityModel):
    """Column function text -> score in 0..1; a null text scores as an empty one."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()))

    return score


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    ``held_out``: the fold of the id is 0 (false for a null id).  Repeated rows
    score alike.  Only the text enters the score; further columns aren't read.
    """
    scored = docs.select("doc_id", toxicity_score(model)("text").alias("score"))
    held: Column = F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
