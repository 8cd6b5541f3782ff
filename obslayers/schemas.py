"""Message, table and view schemas.

The field names and patterns below are fixed values: messages on the topic and
consumers of the views use exactly these.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STATION = "geo_id_insee"
EVENT_TIME = "reference_time"

# Offset pattern of `reference_time` in the final jobs: Z, +01 or +0100.
TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"

# Column layout of a Kafka source, also used by topic directories.
TOPIC_RECORD = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# The canonical message: every measure is a double.
OBSERVATION = StructType(
    [
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
        StructField(STATION, StringType()),
        StructField(EVENT_TIME, StringType()),
        StructField("t", DoubleType()),
        StructField("u", DoubleType()),
        StructField("ff", DoubleType()),
        StructField("dd", DoubleType()),
        StructField("rr_per", DoubleType()),
        StructField("pres", DoubleType()),
    ]
)

# The earlier variant, with whole-number humidity and wind direction. A message
# that writes 78.0 there loses the field, so it is only used when asked for.
OBSERVATION_WHOLE = StructType(
    [
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
        StructField(STATION, StringType()),
        StructField(EVENT_TIME, StringType()),
        StructField("insert_time", StringType()),
        StructField("validity_time", StringType()),
        StructField("t", DoubleType()),
        StructField("td", DoubleType()),
        StructField("u", IntegerType()),
        StructField("dd", IntegerType()),
        StructField("ff", DoubleType()),
        StructField("rr_per", DoubleType()),
        StructField("pres", DoubleType()),
    ]
)

# Fields the daily view reads, each as text first.
DAILY_FIELDS = (STATION, EVENT_TIME, "t_10", "t", "u", "ff")

# Message fields the live averages need; the rest need not be decoded.
SPEED_FIELDS = (STATION, EVENT_TIME, "t", "u", "ff")

SPEED_KEYS = (STATION, "window_start")
DAILY_KEYS = (STATION, "date")


def only(schema: StructType, names) -> StructType:
    """The fields of ``schema`` listed in ``names``, in schema order."""
    wanted = set(names)
    missing = wanted - set(schema.fieldNames())
    if missing:
        raise ValueError(f"fields not in the schema: {sorted(missing)}")
    return StructType([field for field in schema.fields if field.name in wanted])
