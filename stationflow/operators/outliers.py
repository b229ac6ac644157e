"""Three-sigma outliers against each station's own baseline.

The baseline is one row per station, so it is aggregated once (partial +
final aggregate), checkpointed under ``spark.checkpoint.dir`` and measured; only
when its bytes are within the broadcast bound is it broadcast to the readings,
so the readings themselves are never shuffled.  Beyond the bound Catalyst
plans a shuffle join.  A per-station window (``avg() over (partition by
station)``) would instead shuffle every reading and put a hot station into a
single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.measures import agg_exprs, exact_mean_sql, exact_stddev_sql
from stationflow.plans.broadcast import MAX_BROADCAST_BYTES, broadcast_if_bounded
from stationflow.plans.storage import materialize
from stationflow.schema import OUTLIER_COLUMNS, OUTLIER_SIGMAS

def station_baseline(df: DataFrame) -> DataFrame:
    """Unrounded mean and sample standard deviation of temperature and wind per station.

    The whole history, outliers included, forms the baseline.  A station with
    one reading has a null deviation and so never yields an outlier.  Means and
    deviations of readings with up to four decimals are exact: the same bits for any
    order and partitioning, so a reading at 3 sigma doesn't flip between runs.
    """
    return df.groupBy("station_id").agg(
        *agg_exprs(
            {
                "mean_temp": exact_mean_sql("temperature_c"),
                "std_temp": exact_stddev_sql("temperature_c"),
                "mean_wind": exact_mean_sql("wind_speed_kmh"),
                "std_wind": exact_stddev_sql("wind_speed_kmh"),
            }
        )
    )


def outlier_condition(sigmas: float = OUTLIER_SIGMAS):
    return (F.abs(F.col("temperature_c") - F.col("mean_temp")) > F.lit(sigmas) * F.col("std_temp")) | (
        F.abs(F.col("wind_speed_kmh") - F.col("mean_wind")) > F.lit(sigmas) * F.col("std_wind")
    )


def sigma_outliers(
    df: DataFrame,
    sigmas: float = OUTLIER_SIGMAS,
    baseline: DataFrame | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Readings more than ``sigmas`` standard deviations from their station's mean
    temperature or wind.  Eager: computes and checkpoints the baseline."""
    stats = baseline if baseline is not None else materialize(station_baseline(df))
    joined = df.join(broadcast_if_bounded(stats, max_broadcast_bytes), "station_id")
    return joined.where(outlier_condition(sigmas)).select(*OUTLIER_COLUMNS)
