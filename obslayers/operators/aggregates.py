"""Per-station aggregates over clean observations.

All are one partial aggregate, one shuffle on the grouping keys and one final
aggregate. The partial step leaves a task with at most one row per group, so a
station holding a large share of the rows adds no more to the shuffle than any
other. On a stream the same operators keep their groups in the state store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslayers.functions.times import calendar_day, hour_bucket
from obslayers.operators.clean import with_station_and_time
from obslayers.schemas import EVENT_TIME, STATION

# Fixed values of the live view.
SPEED_WINDOW = "6 minutes"
SPEED_WATERMARK = "7 minutes"
TRIAL_WINDOW = "10 minutes"

# Averaged measures of the daily and the live view, and their names there.
DAILY_MEASURES = {"temperature_c": "avg_temp", "wind_speed": "avg_wind", "humidity": "avg_humidity"}


def _averages() -> list[Column]:
    return [F.avg(name).alias(shown) for name, shown in DAILY_MEASURES.items()]


def _bounded_state(df: DataFrame, unbounded_state: bool) -> None:
    if df.isStreaming and not unbounded_state:
        raise ValueError("state of this aggregate never expires; pass unbounded_state=True to accept that")


def daily_averages(df: DataFrame) -> DataFrame:
    """Average temperature, wind and humidity per station and calendar day."""
    return df.groupBy(F.col(STATION), calendar_day(F.col(EVENT_TIME)).alias("date")).agg(*_averages())


def _sums_and_counts() -> list[Column]:
    sums = []
    for name in DAILY_MEASURES:
        sums += [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_count")]
    return sums


def _averages_of_parts() -> list[Column]:
    return [
        F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count")).alias(shown) for name, shown in DAILY_MEASURES.items()
    ]


def daily_parts(df: DataFrame) -> DataFrame:
    """Sums and counts behind the daily averages, which add up over disjoint inputs."""
    return df.groupBy(F.col(STATION), calendar_day(F.col(EVENT_TIME)).alias("date")).agg(*_sums_and_counts())


def daily_from_parts(parts: DataFrame) -> DataFrame:
    """The daily averages of all the inputs that ``parts`` were taken from."""
    return parts.groupBy(STATION, "date").agg(*_averages_of_parts())


def window_parts(df: DataFrame, width: str) -> DataFrame:
    """Sums and counts per station and window, with the day that the window begins on."""
    parts = df.groupBy(F.col(STATION), F.window(F.col(EVENT_TIME), width)).agg(*_sums_and_counts())
    start = F.col("window.start")
    return parts.withColumn("window_start", start).withColumn("date", calendar_day(start)).drop("window")


def windows_from_parts(parts: DataFrame) -> DataFrame:
    """The window averages of all the inputs that ``parts`` were taken from."""
    return parts.groupBy(STATION, "window_start").agg(*_averages_of_parts())


def hourly_rollup(df: DataFrame) -> DataFrame:
    """Eight measures per station and hour, over rows with station and time."""
    hourly = with_station_and_time(df).withColumn("hour_bucket", hour_bucket(F.col(EVENT_TIME)))
    return hourly.groupBy(STATION, "hour_bucket").agg(
        F.avg("temperature_c").alias("avg_temperature_c"),
        F.min("temperature_c").alias("min_temperature_c"),
        F.max("temperature_c").alias("max_temperature_c"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.sum("rain").alias("total_rain"),
        F.avg("pressure").alias("avg_pressure"),
        F.count("*").alias("nb_observations"),
    )


def station_summary(df: DataFrame) -> DataFrame:
    """Count and averages per station; rows without a time count as well."""
    return df.groupBy(STATION).agg(
        F.count("*").alias("nb_observations"),
        F.avg("temperature_c").alias("avg_temperature_c"),
        F.avg("humidity").alias("avg_humidity"),
    )


def running_summary(df: DataFrame, unbounded_state: bool = False) -> DataFrame:
    """Averages and message count per station since the start.

    On a stream there is one state row per station and it never expires.
    """
    _bounded_state(df, unbounded_state)
    return df.groupBy(STATION).agg(
        F.avg("temperature_c").alias("avg_temperature_c"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.count("*").alias("nb_messages"),
    )


def windowed_averages(
    df: DataFrame,
    width: str = SPEED_WINDOW,
    watermark: str | None = None,
    unbounded_state: bool = False,
) -> DataFrame:
    """Averages per station and tumbling window of event time, windows by their start.

    A stream needs a ``watermark``, after which a window's state is dropped, or the
    explicit choice of state that grows for ever. ``window`` itself leaves out rows
    without a time, so ``window_start`` is never null; a filter on it would only
    compute the window of every row a second time.
    """
    if watermark is not None:
        df = df.withWatermark(EVENT_TIME, watermark)
    else:
        _bounded_state(df, unbounded_state)
    return (
        df.groupBy(F.col(STATION), F.window(F.col(EVENT_TIME), width))
        .agg(*_averages())
        .select(
            F.col(STATION),
            F.col("window.start").alias("window_start"),
            "avg_temp",
            "avg_wind",
            "avg_humidity",
        )
    )


def speed_view(df: DataFrame) -> DataFrame:
    """The live view: six-minute windows, seven minutes of patience for late rows."""
    return windowed_averages(df, SPEED_WINDOW, SPEED_WATERMARK)


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(name))
