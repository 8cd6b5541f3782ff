"""Small topics and messages for the tests."""

from __future__ import annotations

import json
import os
from pathlib import Path

from obslayers.sources.topic import Topic, publish

# A normal message; the fixtures change one thing in it.
NORMAL = {
    "geo_id_insee": "29075001",
    "reference_time": "2024-01-01T00:00:00Z",
    "t": 285.4,
    "u": 78,
    "ff": 2.5,
    "dd": 240,
    "rr_per": 0.2,
    "pres": 101325,
}

# Carries none of the expected fields.
OFF_SCHEMA = {
    "station_id": "x-1",
    "timestamp": "2024-01-01T00:00:00+00:00",
    "temperature_c": 9.5,
    "humidity_pct": 60,
    "wind_kph": 11.0,
}

UNUSABLE = ['{"geo_id_insee":"a",', "hello", "", '[{"geo_id_insee":"a"},{"geo_id_insee":"b"}]', None]


def message(drop=(), **changes) -> str:
    fields = {**NORMAL, **changes}
    return json.dumps({name: value for name, value in fields.items() if name not in drop})


def at(clock: str, t: float = 285.4, station: str = "s") -> str:
    """A message at a time of 1 January 2024."""
    return message(geo_id_insee=station, reference_time=f"2024-01-01T{clock}Z", t=t)


def texts(spark, messages):
    return spark.createDataFrame([(text,) for text in messages], "json string")


class TopicFolder:
    """A topic folder whose files are read in the order they were added."""

    def __init__(self, spark, path: Path):
        self.spark, self.path = spark, Path(path)
        self.topic = Topic(folder=str(path))
        self.added = 0

    def add(self, *messages: str) -> None:
        """One more file holding ``messages``."""
        before = set(self.path.glob("part-*.parquet"))
        publish(texts(self.spark, messages).coalesce(1), self.topic)
        for file in set(self.path.glob("part-*.parquet")) - before:
            stamp = 1_700_000_000 + 10 * self.added
            os.utime(file, (stamp, stamp))
        self.added += 1


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]
