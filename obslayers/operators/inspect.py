"""Ordered and unordered previews, and schema text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslayers.schemas import STATION

ORDERED_ROWS = 50


def first_by(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``; each task keeps its own ``n``, so nothing is sorted whole."""
    return df.orderBy(*[F.col(name) for name in order]).limit(n)


def first_days(df: DataFrame, n: int = ORDERED_ROWS) -> DataFrame:
    """The first rows of a daily view by date, ties by station."""
    return first_by(df, ("date", STATION), n)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def show_preview(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def schema_text(df: DataFrame) -> str:
    """What ``printSchema`` prints."""
    return df.schema.treeString()
