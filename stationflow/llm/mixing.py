"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power ``t``, normalised:
``t = 1`` keeps the natural shares, ``t = 0`` gives every source the same.
Bisection finds ``t`` for a target entropy or for a limit on repetition.  The
weights are realised in blocks: every source is dealt to ``BLOCKS`` blocks by a
hash, passes over them in a fresh permutation per epoch, and stops at the block
where its share of the token budget is used up.

Only built-in DataFrame functions run here.  What grows with the corpus is
summed up by (source, block) before anything moves, so a source of any size
costs ``BLOCKS`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.scratch import Scratch, bounded_broadcast

BLOCKS = 1024
#: Times that any source is passed over at most.
MAX_REPEATS = 1.5
SEED = 17
#: Levels of bisection that one pass over the source table decides, and passes.
LEVELS, PASSES = 4, 10

WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """``exponent`` t, the token ``budget`` it is realised with, and the sum of the shares to the power t."""

    exponent: float
    budget: float
    norm: float


def _measures(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float]]:
    """Per exponent: entropy, norm, and the largest ratio of weight to share; ``sources``: (share)."""
    at = F.explode(F.array(*(F.lit(float(t)) for t in exponents))).alias("t")
    powers = sources.select("share", at).withColumn("p", F.pow("share", F.col("t")))
    rows = powers.groupBy("t").agg(
        F.sum("p").alias("norm"),
        F.sum(F.col("p") * F.col("t") * F.log("share")).alias("inner"),
        F.max(F.col("p") / F.col("share")).alias("ratio"),
    )
    return {r["t"]: (log(r["norm"]) - r["inner"] / r["norm"], r["norm"], r["ratio"] / r["norm"]) for r in rows.collect()}


def _smallest(sources: DataFrame, holds) -> float:
    """The smallest exponent in 0..1 for which ``holds(t, entropy, norm, ratio)``; it holds from some exponent on, or only at 1."""
    low, high = 0.0, 1.0
    if holds(0.0, *_measures(sources, [0.0])[0.0]):
        return 0.0
    for _ in range(PASSES):
        parts = 1 << LEVELS
        grid = [low + (high - low) * i / parts for i in range(1, parts)]
        found = _measures(sources, grid)
        ok = [holds(t, *found[t]) for t in grid]
        first = ok.index(True) if True in ok else len(grid)  # LEVELS bisection steps at once
        low, high = ([low, *grid][first], [*grid, high][first])
    return high


def solve(
    sources: DataFrame, entropy: float | None = None, max_repeats: float | None = None, budget: float | None = None
) -> Mixture:
    """Exponent and budget for ``sources`` (source, tokens), tokens above 0.

    ``entropy``: target in nats, met as closely as exponents in 0..1 allow.
    ``max_repeats``: no source is passed over more often.  With both, the flatter
    mixture that satisfies both.  ``budget`` in tokens; by default the least that
    uses every document at least once.  Without any token the exponent is 1 and
    the budget 0.
    """
    total = sources.agg(F.sum("tokens").alias("n"), F.max("tokens").alias("m")).first()
    if not total["n"]:
        return Mixture(1.0, 0.0, 1.0)
    n, top = float(total["n"]), float(total["m"]) / float(total["n"])
    shares = sources.select((F.col("tokens") / F.lit(n)).alias("share"))

    def tokens(t: float, norm: float) -> float:
        return budget if budget is not None else n * norm * top ** (1 - t)

    exponent = 0.0
    if entropy is not None:
        exponent = _smallest(shares, lambda t, h, norm, ratio: h <= entropy + 1e-12)
    if max_repeats is not None:
        # a source is passed over budget * weight / tokens times, which is largest where weight / share is
        exponent = max(
            exponent, _smallest(shares, lambda t, h, norm, ratio: tokens(t, norm) * ratio / n <= max_repeats + 1e-9)
        )
    norm = _measures(shares, [exponent])[exponent][1]
    return Mixture(exponent, tokens(exponent, norm), norm)


def schedule(blocks: DataFrame, mixture: Mixture, total: float, seed: int = SEED) -> DataFrame:
    """(source, block, epoch, at) for every pass over a block; ``blocks``: (source, block, tokens).

    ``at`` in 0..1 is the place in the mixture: sources advance at their own
    rates, so any stretch of it holds them in their target weights.
    """
    per_source = Window.partitionBy("source")
    share = F.col("n") / F.lit(total or 1.0)
    passes = F.when(
        F.col("n") > 0, F.lit(mixture.budget) * F.pow(share, F.lit(mixture.exponent)) / F.lit(mixture.norm) / F.col("n")
    ).otherwise(1.0)
    rated = blocks.withColumn("n", F.sum("tokens").over(per_source)).withColumn("passes", passes)
    epochs = rated.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil("passes").cast("int"))))
    permuted = Window.partitionBy("source", "epoch").orderBy(F.xxhash64(F.lit(seed), "source", "epoch", "block"), "block")
    before = F.coalesce(F.sum("tokens").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = epochs.withColumn("before", before)
    left = (F.col("passes") - F.col("epoch")) * F.col("n")
    whole = F.col("epoch") + 1 <= F.col("passes") + 1e-9
    cut = (left > 0) & (F.col("before") + F.col("tokens") / 2 < left)
    at = F.when(F.col("n") > 0, (F.col("epoch") + F.col("before") / F.col("n")) / F.col("passes")).otherwise(0.0)
    return placed.where(whole | cut).select("source", "block", "epoch", F.least(at, F.lit(1.0)).alias("at"))


def _block(seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(BLOCKS)).alias("block")


def plan(
    docs: DataFrame,
    scratch: Scratch,
    entropy: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    budget: float | None = None,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, Mixture]:
    """(rows, passes, mixture): rows (doc_id, source, n_tokens, block) and their schedule by (source, block)."""
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("n_tokens")
    rows = scratch.table(docs.select("doc_id", "source", tokens, _block(seed)), "rows")
    blocks = scratch.table(rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks")
    sources = scratch.table(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "sources")
    mixture = solve(sources, entropy, max_repeats, budget)
    total = sources.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    return rows, scratch.table(schedule(blocks, mixture, float(total), seed), "schedule"), mixture


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture's schedule: one row per document and pass of ``docs`` (doc_id, text, source).

    Columns: doc_id, source, n_tokens (words between white space), epoch (from
    0), block, at (place in the mixture, see ``schedule``).  Options as in
    ``plan``.  Null sources are one source; a null or empty text has no tokens
    and goes with its block; documents of a source without tokens come once.
    Repeated rows are repeated.  An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, passes, _ = plan(docs.select("doc_id", "text", "source"), scratch, **options)
    passes = passes.withColumnsRenamed({"source": "s", "block": "b"})
    p = bounded_broadcast(passes, F.coalesce(F.octet_length("s"), F.lit(0)) + 64)
    return rows.join(p, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mixture passes over it; all columns stay, whatever their names."""
    scratch = Scratch(docs.sparkSession, "mixing")
    _, passes, _ = plan(docs.select("doc_id", "text", "source"), scratch, **options)
    times = passes.groupBy("source", "block").agg(F.count("*").cast("int").alias("times"))
    times = scratch.table(times.withColumnsRenamed({"source": "s", "block": "b"}), "times")
    # the user's columns are packed into one, so that none can clash with ours
    placed = docs.select("source", _block(options.get("seed", SEED)), F.struct("*").alias("row"))
    joined = placed.join(
        bounded_broadcast(times, F.coalesce(F.octet_length("s"), F.lit(0)) + 64),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")),
    )
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
