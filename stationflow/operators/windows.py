"""Sliding-window statistics per station (5-minute windows every minute).

``sliding_window_stats`` serves batch and streaming: in a stream the watermark
bounds the state (windows older than max event time minus the delay are final
and evicted); in a batch the watermark is a no-op.  Each reading falls into
size/slide = 5 windows; the expansion happens before the partial aggregate,
and the shuffle is keyed on (window, station), so a hot station spreads over
many windows.  ``sliding_window_stats_batch`` computes the same rows for a
bounded input from one-minute panes, without shuffling readings;
``sliding_window_stats_chained`` does so in a stream, with panes in the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.measures import agg_exprs, parts_sql, rounded, rounded_mean, total_sql
from stationflow.schema import WATERMARK_DELAY, WINDOW_SIZE, WINDOW_SLIDE


_MEASURES = {
    "avg_temp": rounded_mean("temperature_c"),
    "max_temp": rounded("max(temperature_c)"),
    "min_temp": rounded("min(temperature_c)"),
    "avg_humidity": rounded_mean("humidity_pct"),
    "avg_wind": rounded_mean("wind_speed_kmh"),
    "reading_count": "count(1)",
}


def sliding_window_stats(
    df: DataFrame,
    time_col: str = "event_time",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str | None = WATERMARK_DELAY,
) -> DataFrame:
    """``window`` struct, station id/name and six rounded measures per window."""
    src = df.withWatermark(time_col, watermark) if watermark else df
    return src.groupBy(F.window(time_col, size, slide), "station_id", "station_name").agg(*agg_exprs(_MEASURES))


#: Columns whose mean a window reports.
_MEANS = {"avg_temp": "temperature_c", "avg_humidity": "humidity_pct", "avg_wind": "wind_speed_kmh"}


def _pane_sums() -> dict[str, str]:
    """What all windows over a pane share: sums of its readings that add up further."""
    sums = {"_max": "max(temperature_c)", "_min": "min(temperature_c)", "_rows": "count(1)"}
    for alias, column in _MEANS.items():
        sums |= {f"{alias}_{part}": sql for part, sql in parts_sql(column).items()}
    return sums


def _of_panes() -> dict[str, str]:
    """The measures of a window from its panes' sums."""
    measures = {}
    for alias in _MEANS:
        sums = (f"sum({alias}_{part})" for part in ("hi", "lo", "rest"))
        measures[alias] = rounded(f"{total_sql(*sums)} / sum({alias}_n)")
    return measures | {"max_temp": rounded("max(_max)"), "min_temp": rounded("min(_min)"), "reading_count": "sum(_rows)"}


def sliding_window_stats_chained(
    df: DataFrame,
    time_col: str = "event_time",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK_DELAY,
) -> DataFrame:
    """Stream form over panes, for append mode: two stateful aggregates in a row.

    The first sums readings up per station and pane of one ``slide``, so a reading
    touches one row of state instead of size/slide; panes the watermark has closed go
    on to the second, which gathers them into windows by their ``window_time``.  A
    window is written once the watermark passes its end, with the same rows as
    :func:`sliding_window_stats`, but a reading is late as a whole: it is dropped when its
    pane is closed, while there it would still count in the windows that end later.
    """
    panes = (
        df.withWatermark(time_col, watermark)
        .groupBy(F.window(time_col, slide).alias("pane"), "station_id", "station_name")
        .agg(*agg_exprs(_pane_sums()))
    )
    out = panes.groupBy(F.window(F.window_time("pane"), size, slide), "station_id", "station_name").agg(
        *agg_exprs(_of_panes())
    )
    return out.select("window", "station_id", "station_name", *_MEASURES)


def pane_stats(df: DataFrame, time_col: str = "event_time", slide_minutes: int = 1) -> DataFrame:
    """Sums of every (station, pane of ``slide_minutes``): what all windows over the pane share.

    A partial aggregate: readings combine within their tasks, so a station-hour
    of any number of readings leaves a task as at most 60 rows per name.
    """
    slide = slide_minutes * 60_000_000
    t = f"unix_micros(`{time_col}`)"
    rows = df.where(F.col(time_col).isNotNull()).withColumn("_pane", F.expr(f"{t} - pmod({t}, {slide})"))
    return rows.groupBy("station_id", "station_name", "_pane").agg(*agg_exprs(_pane_sums()))


def sliding_window_stats_batch(
    df: DataFrame,
    time_col: str = "event_time",
    size_minutes: int = 5,
    slide_minutes: int = 1,
) -> DataFrame:
    """Batch form of :func:`sliding_window_stats` over panes.

    ``window()`` turns every reading into size/slide rows before the shuffle.
    Here readings are first summed up per pane of one slide; only panes are
    expanded to the windows that hold them and summed again.  No raw reading is
    shuffled, and a hot station or hour costs its panes, not its readings.
    Same rows, same ``window`` struct.
    """
    assert size_minutes % slide_minutes == 0
    size, slide = size_minutes * 60_000_000, slide_minutes * 60_000_000
    starts = F.explode(F.expr(f"sequence(_pane - {size - slide}, _pane, {slide})"))
    expanded = pane_stats(df, time_col, slide_minutes).withColumn("_start", starts)
    out = expanded.groupBy("station_id", "station_name", "_start").agg(*agg_exprs(_of_panes()))
    return out.select(
        F.struct(
            F.expr("timestamp_micros(_start)").alias("start"),
            F.expr(f"timestamp_micros(_start + {size})").alias("end"),
        ).alias("window"),
        "station_id",
        "station_name",
        *_MEASURES,
    )


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by wall-clock ``window_start``/``window_end`` columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )
