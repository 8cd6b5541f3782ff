"""Clean table to hourly rollup and to station summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers.operators.aggregates import hourly_rollup, station_summary
from obslayers.operators.inspect import schema_text, show_preview
from obslayers.sources.tables import read_table, replace_days, replace_table


def run_hourly(spark: SparkSession, clean: str, table: str) -> None:
    """Rebuild the hourly table from the whole clean table."""
    replace_table(hourly_rollup(read_table(spark, clean)), table)


def clean_days(spark: SparkSession, clean: str, since: str, until: str) -> DataFrame:
    """The days ``since`` to ``until`` (inclusive) of a clean table archived by day."""
    first, last = F.lit(since).cast("date"), F.lit(until).cast("date")
    return read_table(spark, clean).filter(F.col("reference_date").between(first, last))


def run_hourly_days(spark: SparkSession, clean: str, table: str, since: str, until: str) -> None:
    """Rebuild the days ``since`` to ``until`` (inclusive) of an hourly table filed by day.

    Only those days of a clean table archived by day are read, and only their
    partitions of ``table`` are replaced, or dropped where the clean table has no such
    day any more. An hour lies within one day, so the rows are those of a whole rebuild.
    """
    hourly = hourly_rollup(clean_days(spark, clean, since, until))
    replace_days(hourly.withColumn("day", F.to_date("hour_bucket")), table, "day", since, until)


def run_summary(spark: SparkSession, clean: str, show: bool = False) -> DataFrame:
    """Count and averages per station of the clean table."""
    observations = read_table(spark, clean)
    summary = station_summary(observations)
    if show:
        print(schema_text(observations))
        show_preview(observations)
        show_preview(summary)
    return summary
