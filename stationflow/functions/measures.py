"""Aggregate expressions whose results do not depend on row order.

A plain ``avg`` of doubles depends on the order in which partial sums meet, so
the same query can round to a different second decimal on another run, another
partitioning or another micro-batch split.  Most readings carry at most
``MEASURE_SCALE`` decimals: such a value is an exact integer number of
``10**-MEASURE_SCALE`` units, and integer sums are exact and order-free.  What a
value has beyond its units (further decimals, a magnitude beyond 64 bits, NaN,
an infinity) is its residual; residuals are summed as doubles and added, so
every mean and sum covers all of every value.

Summing the integers as DECIMAL keeps 128-bit buffers, which Spark cannot
hold in its fast fixed-width aggregation rows (measured ~6x slower than
``avg``).  Instead each unit count ``v`` is split as ``v = hi * 2**20 + lo``
with ``0 <= lo < 2**20``; ``sum(hi)`` and ``sum(lo)`` are plain LONG sums
(codegen'd, map-side combinable) that cannot overflow below ~8e12 rows per
group, and are joined into one exact DECIMAL(38,0) only once per group.

Expressions are built as SQL text and turned into one Column with a single
``F.expr`` call: the same plan as nested ``F.*`` calls, without hundreds of
driver-to-JVM round trips per query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.schema import MEASURE_SCALE

_UNIT = f"{10**MEASURE_SCALE}D"
_SPLIT_BITS = 20
_LOW_MASK = (1 << _SPLIT_BITS) - 1


def units_sql(expr: str) -> str:
    """Whole 10**-MEASURE_SCALE units of a value (null where 64 bits can't hold them)."""
    return f"try_cast(rint(({expr}) * {_UNIT}) AS BIGINT)"


def parts_sql(expr: str) -> dict[str, str]:
    """The four sums that make up an exact sum or mean; each adds up over parts of a group."""
    units = units_sql(expr)
    return {
        "hi": f"sum(shiftright({units}, {_SPLIT_BITS}))",
        "lo": f"sum({units} & {_LOW_MASK})",
        "rest": f"sum(({expr}) - coalesce({units}, 0L) / {_UNIT})",
        "n": f"count({expr})",
    }


def total_sql(hi: str, lo: str, rest: str) -> str:
    """The sum from its parts (null when there was no value)."""
    whole = f"CAST({hi} AS DECIMAL(38,0)) * {1 << _SPLIT_BITS} + CAST({lo} AS DECIMAL(38,0))"
    return f"(coalesce(CAST({whole} AS DOUBLE) / {_UNIT}, 0D) + {rest})"


def exact_sum_sql(expr: str) -> str:
    p = parts_sql(expr)
    return total_sql(p["hi"], p["lo"], p["rest"])


def exact_mean_sql(expr: str) -> str:
    return f"({exact_sum_sql(expr)} / {parts_sql(expr)['n']})"


def r2_sql(expr: str, digits: int = 2) -> str:
    """``round(x, digits)``: HALF_UP on the shortest decimal text of the double."""
    return f"round({expr}, {digits})"


def r2(c: Column, digits: int = 2) -> Column:
    return F.round(c, digits)


def agg_exprs(spec: dict[str, str]) -> list[Column]:
    """``{alias: sql}`` -> aliased Columns, one ``F.expr`` each."""
    return [F.expr(f"{sql} AS `{alias}`") for alias, sql in spec.items()]


def rounded_mean(expr: str, digits: int = 2) -> str:
    return r2_sql(exact_mean_sql(expr), digits)


def rounded_sum(expr: str, digits: int = 2) -> str:
    return r2_sql(exact_sum_sql(expr), digits)


def rounded(expr: str, digits: int = 2) -> str:
    return r2_sql(expr, digits)


# --- exact second moments ----------------------------------------------------


def square_parts_sql(expr: str) -> dict[str, str]:
    """Sums that hold the exact sum of squares of a value's whole units; each adds up over parts of a group.

    With ``v = hi * 2**20 + lo`` the square is ``hi*hi * 2**40 + hi*lo * 2**21 + lo*lo``.  Values of
    magnitudes below 2**50 units have products below 2**60, which are split once more at
    20 bits, so that no sum overflows below ~8e12 rows.  ``wide`` counts the values that
    don't fit, or that aren't whole units.
    """
    units = units_sql(expr)
    fits = f"coalesce(abs({units}) < {1 << 50}L, false)"
    own = f"CASE WHEN {fits} THEN {units} END"
    hi, lo = f"shiftright({own}, {_SPLIT_BITS})", f"({own} & {_LOW_MASK}L)"
    parts = {}
    for name, product in (("hh", f"{hi} * {hi}"), ("hl", f"{hi} * {lo}"), ("ll", f"{lo} * {lo}")):
        parts[f"{name}_hi"] = f"sum(shiftright({product}, {_SPLIT_BITS}))"
        parts[f"{name}_lo"] = f"sum(({product}) & {_LOW_MASK}L)"
    # a double of at most 4 decimals and 2**50 units is the nearest one to its units / 10**4
    parts["wide"] = f"count_if(({expr}) IS NOT NULL AND NOT ({fits} AND ({expr}) = {units} / {_UNIT}))"
    return parts


def _variance_sql(p: dict[str, str], q: dict[str, str]) -> str:
    """Sample variance in squared units from the parts of the sum and of the sum of squares; null for fewer than two values.

    ``(n * sum(v*v) - sum(v)**2) / (n * (n - 1))`` with an integer numerator: the same bits for any
    order and any partitioning.  A DECIMAL holds 38 digits; where ``n`` times the sum of squares
    takes more, the two terms are divided as doubles of exact integers, which is as free of order.
    """
    two20, d = 1 << _SPLIT_BITS, "DECIMAL(38,0)"
    whole = f"(CAST({p['hi']} AS {d}) * {two20} + CAST({p['lo']} AS {d}))"
    piece = {n: f"(CAST({q[f'{n}_hi']} AS {d}) * {two20} + CAST({q[f'{n}_lo']} AS {d}))" for n in ("hh", "hl", "ll")}
    squares = f"({piece['hh']} * {two20 * two20} + {piece['hl']} * {2 * two20} + {piece['ll']})"
    n = f"CAST({p['n']} AS {d})"
    exact = f"CAST(try_subtract(try_multiply({n}, {squares}), try_multiply({whole}, {whole})) AS DOUBLE)"
    count = f"CAST({p['n']} AS DOUBLE)"
    rough = f"({count} * CAST({squares} AS DOUBLE) - CAST({whole} AS DOUBLE) * CAST({whole} AS DOUBLE))"
    return f"CASE WHEN {p['n']} > 1 THEN coalesce({exact}, {rough}) / {count} / ({count} - 1D) END"


def exact_stddev_sql(expr: str) -> str:
    """Sample standard deviation that doesn't depend on row order; Spark's own where values aren't whole units."""
    squares = square_parts_sql(expr)
    own = f"sqrt({_variance_sql(parts_sql(expr), squares)}) / {_UNIT}"
    return f"CASE WHEN {squares['wide']} = 0 THEN {own} ELSE stddev_samp({expr}) END"


def merged_stddev_sql(name: str) -> str:
    """The same from rows that hold ``name``'s parts as columns, with ``avg`` and ``m2`` for values that aren't whole units."""
    p = {part: f"sum({name}_{part})" for part in ("hi", "lo", "n")}
    q = {f"{x}_{y}": f"sum({name}_{x}_{y})" for x in ("hh", "hl", "ll") for y in ("hi", "lo")}
    own = f"sqrt({_variance_sql(p, q)}) / {_UNIT}"
    # the squared distances within the rows, and of the rows' means from one another
    between = f"(var_pop({name}_avg) * count({name}_avg))"
    weighted = f"(sum({name}_n * {name}_avg * {name}_avg) - power(sum({name}_n * {name}_avg), 2) / {p['n']})"
    rough = f"sqrt((sum({name}_m2) + CASE WHEN min({name}_n) = max({name}_n) THEN {between} * max({name}_n) ELSE {weighted} END) / ({p['n']} - 1))"
    return f"CASE WHEN sum({name}_wide) = 0 THEN {own} WHEN {p['n']} > 1 THEN {rough} END"
