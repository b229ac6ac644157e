"""Approximate nearest neighbours over learned partitions.

On a bounded sample a neighbour graph is cut into balanced parts, and a small
classifier learns, for a vector, the parts its neighbours lie in.  Every vector
of the table is indexed under the classifier's most probable part; a query is
routed to its most probable parts and reranked there by exact cosines.  How many
parts a query probes is measured on held-out sample vectors: the fewest that
find ``TARGET`` of their true neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm import ship
from stationflow.llm.scratch import Scratch

ship(__name__)

#: Vectors that the partitions are learned on at most, and of these the queries that set the number of probes.
SAMPLE, HELD_OUT = 4096, 512
#: Rows of a part aimed at, and the bounds on the number of parts.
PART_ROWS, FEWEST, MOST = 1000, 4, 64
DEGREE, HIDDEN, TARGET = 10, 64, 0.97
#: Rows of a block of a part, and queries that meet it at once.
BLOCK, QUERIES = 4096, 1024


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) of the rows that take part.

    Null ids and vectors that are null, empty, zero or hold null or non-finite
    components don't, nor do those of another length than the most frequent
    (then the smallest) one.  Of rows that repeat an id the smallest vector counts.
    """
    vec = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vec", lambda x: x != 0), F.lit(False)))
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    length = rows.groupBy(F.size("vec").alias("length")).agg(F.count("*").alias("n"))
    usual = length.orderBy(F.desc("n"), "length").limit(1).select("length")
    return rows.join(F.broadcast(usual), F.size("vec") == F.col("length")).drop("length")


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Indexes of the ``degree`` nearest other rows of each unit vector."""
    degree = min(degree, len(x) - 1)
    found = []
    for low in range(0, len(x), 256):
        s = x[low : low + 256] @ x.T
        s[np.arange(len(s)), np.arange(low, low + len(s))] = -np.inf
        found.append(np.argpartition(-s, degree - 1, axis=1)[:, :degree])
    return np.concatenate(found)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part of every row: seeded by spread-out rows, then moved to where its neighbours are while there is room."""
    room = ceil(1.1 * len(x) / parts)
    near = x @ x[rng.choice(len(x), parts, replace=False)].T
    label, size = np.full(len(x), -1), np.zeros(parts, dtype=int)
    for i in np.argsort(-near.max(axis=1), kind="stable"):
        for p in np.argsort(-near[i], kind="stable"):
            if size[p] < room:
                label[i] = p
                size[p] += 1
                break
    links = [graph[i].tolist() for i in range(len(x))]
    for i, others in enumerate(graph):
        for j in others:
            links[j].append(i)
    for _ in range(8):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(label[links[i]], minlength=parts)
            votes[(size >= room) & (np.arange(parts) != label[i])] = -1
            best = votes.argmax()
            if votes[best] > votes[label[i]]:
                size[label[i]] -= 1
                size[best] += 1
                label[i] = best
                moved += 1
        if moved < len(x) / 200:
            break
    return label


@dataclass(frozen=True)
class Router:
    """Weights of the classifier (one hidden layer) and the number of parts a query probes."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def rank(self, x: np.ndarray) -> np.ndarray:
        """Parts from the most to the least probable for every row."""
        return np.argsort(-(np.maximum(_unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2), axis=1, kind="stable")


def _classifier(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, epochs: int = 30) -> list[np.ndarray]:
    parts = [
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)) * 3,
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, target.shape[1])),
        np.zeros(target.shape[1]),
    ]
    first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            step += 1
            h = np.maximum(x[rows] @ parts[0] + parts[1], 0)
            out = (_softmax(h @ parts[2] + parts[3]) - target[rows]) / len(rows)
            back = (out @ parts[2].T) * (h > 0)
            for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), h.T @ out, out.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                parts[i] = parts[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return parts


def learn_router(sample: np.ndarray, rows: int, k: int, seed: int = 5) -> Router:
    """Partitions and router from sample vectors of a table with ``rows`` vectors."""
    rng = np.random.default_rng(seed)
    x = _unit(np.unique(sample, axis=0))
    x = x[rng.permutation(len(x))]
    parts = int(np.clip(ceil(rows / PART_ROWS), FEWEST, min(MOST, max(FEWEST, len(x) // 8))))
    if len(x) < 8 * FEWEST:  # too few to learn from: one part
        one = x.shape[1]
        return Router(np.zeros((one, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(x, DEGREE)
    label = balanced_parts(x, graph, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x)), label), 2)
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1)
    held = min(HELD_OUT, len(x) // 4)
    weights = _classifier(x[held:], _normal(target)[held:], rng)
    router = Router(*weights, probes=1)
    ranks = router.rank(x)
    truth = neighbour_graph(x, k)[:held]
    place = np.empty_like(ranks[:held])
    np.put_along_axis(place, ranks[:held], np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(place, ranks[truth, 0], axis=1) + 1
    return Router(*weights, probes=int(np.quantile(needed, TARGET, method="higher")))


def _normal(target: np.ndarray) -> np.ndarray:
    return target / target.sum(axis=1, keepdims=True)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _routed(router: Router, probes: int):
    def run(batches):
        for rows in batches:
            if len(rows):
                yield rows.assign(parts=list(router.rank(_matrix(rows["vec"]))[:, :probes].astype(np.int32)))

    return run


def _nearest(k: int):
    def rerank(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            q, x, ids = _matrix(queries["vec"]), _matrix(rows["vec"]), rows["vec_id"].to_numpy()
            size = np.sqrt((x * x).sum(axis=1))
            rough = (q / np.sqrt((q * q).sum(axis=1))[:, None]) @ (x / size[:, None]).T
            for own, v, s in zip(queries["query_id"], q, rough, strict=True):
                s[ids == own] = -np.inf
                least = np.partition(s, -k)[-k] if len(s) > k else -2.0
                near = np.flatnonzero(s >= max(least - 1e-9, -2.0))
                # the same sum for the same two vectors, wherever they stand
                score = (x[near] * v).sum(axis=1) / (size[near] * np.sqrt((v * v).sum()))
                for i in np.lexsort((ids[near], -score))[:k]:
                    found.append((own, ids[near][i], score[i]))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return rerank


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` nearest found for every vector whose id is divisible by ``every``.

    Columns: query_id, rank (from 1), vec_id, score (cosine in double precision
    of the original vectors); nearest first, ties to the smaller vec_id.  All
    candidates come back where there are fewer than ``k``.  See ``valid_vectors``
    for what takes part.  A part of any size is split into blocks, which meet
    the queries routed to it in blocks too.  Further columns are not read.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows = scratch.table(valid_vectors(vectors.select("vec_id", "embedding")), "vectors")
    n = rows.count()
    if not n:
        return rows.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "CAST(0 AS DOUBLE) AS score").where("false")
    # drawn by the hash of the id, so that no more than the sample comes to the driver
    place = F.xxhash64("vec_id").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    drawn = rows.where(place < (0.95 * sample / n if n > sample else 1.0)).limit(sample).select("vec").toArrow()
    vectors = drawn.column("vec").combine_chunks()
    router = learn_router(vectors.values.to_numpy().reshape(len(vectors), -1), n, k)

    schema = "vec_id long, vec array<double>, parts array<int>"
    index = scratch.table(
        rows.mapInPandas(_routed(router, 1), schema).select("vec_id", "vec", F.col("parts")[0].alias("part")), "index"
    )
    queries = rows.where(F.col("vec_id") % every == 0).mapInPandas(_routed(router, router.probes), schema)
    queries = scratch.table(
        queries.select(F.col("vec_id").alias("query_id"), "vec", F.explode("parts").alias("part")), "queries"
    )
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    rounds = queries.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).alias("rounds"))
    shape = F.broadcast(blocks.join(rounds, "part"))  # a row per part: MOST at most
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda id, n: F.pmod(F.xxhash64(id), F.col(n))
    q = queries.join(shape, "part").select("part", each("blocks").alias("block"), own("query_id", "rounds").alias("round"), "query_id", "vec")
    x = index.join(shape, "part").select("part", own("vec_id", "blocks").alias("block"), each("rounds").alias("round"), "vec_id", "vec")
    key = ["part", "block", "round"]
    met = q.groupBy(*key).cogroup(x.groupBy(*key)).applyInPandas(_nearest(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
