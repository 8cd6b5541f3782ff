"""The ``events`` table read as station messages.

A user is a station, the event value is the reading, and the remaining fields
follow from the ids, so every result can be stated over ``events`` itself. Some
messages are bad, by remainders of the event id: see ``observation_text``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers import storage
from obslayers.schemas import EVENT_TIME, STATION, TIME_PATTERN
from obslayers.sources.topic import MAX_FILE_AGE, Topic, topic_records

EVENTS = "events.parquet"
STAND_IN_TOPIC = Topic(name="events", folder="events")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{EVENTS}")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of them."""
    schema = events(spark, sf_dir).schema
    reader = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
    path = f"{sf_dir}/{EVENTS}"
    if storage.is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", EVENTS).parquet(sf_dir)


def observation_fields(df: DataFrame, *others: str) -> DataFrame:
    """The fields of an observation message, beside the event they come from and the ``others``."""
    number = F.col("event_id")
    return df.select(
        number.alias("offset"),
        *others,
        (F.col("user_id") % 20 + 40).cast("double").alias("lat"),
        (F.col("user_id") % 10).cast("double").alias("lon"),
        F.col("user_id").cast("string").alias(STATION),
        F.date_format("ts", TIME_PATTERN).alias(EVENT_TIME),
        (F.col("value") + 273.15).alias("t"),
        F.when(number % 2 == 0, F.col("value") + 283.15).alias("t_10"),
        (number % 101).alias("u"),
        F.col("value").alias("ff"),
        (number % 360).alias("dd"),
        ((number % 7) / 10).alias("rr_per"),
        (number % 500 + 101000).cast("double").alias("pres"),
    )


def raw_values(df: DataFrame) -> DataFrame:
    """The events' own JSON as messages, some of them null."""
    number = F.col("event_id")
    return df.select(F.when(number % 37 != 17, F.col("props")).alias("json"), number.alias("offset"), F.lit(0).alias("partition"))


def observation_text(df: DataFrame) -> DataFrame:
    """One message per event in ``json``, beside its ``offset`` and ``ts``.

    Event ids with these remainders have no message (17 of 37), one that breaks off (13 of
    31), one of another schema (19 of 41), no station (3 of 17), no time (5 of 19), a
    quoted temperature (7 of 23), text for a temperature (11 of 29), the same time with
    an offset that the pattern takes (23 of 43) or refuses (29 of 47).
    """
    fields = observation_fields(df.withColumn("kept_ts", F.col("ts")), "kept_ts")
    number = F.col("offset")
    later = F.col("kept_ts") + F.expr("INTERVAL 1 HOUR")
    local = F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss")
    time = (
        F.when(number % 19 == 5, None)
        .when(number % 43 == 23, F.concat(local, F.lit("+0100")))
        .when(number % 47 == 29, F.concat(local, F.lit("+01:00")))
        .otherwise(F.col(EVENT_TIME))
    )
    fields = fields.withColumn(EVENT_TIME, time).withColumn(STATION, F.when(number % 17 != 3, F.col(STATION)))
    names = [name for name in fields.columns if name not in ("offset", "kept_ts")]
    plain = F.to_json(F.struct(*names))
    text = F.when(number % 29 == 11, F.lit("abc")).otherwise(F.col("t").cast("string"))
    quoted = F.to_json(F.struct(*[text.alias("t") if name == "t" else F.col(name) for name in names]))
    other = F.to_json(
        F.struct(F.lit("x-1").alias("station_id"), F.col(EVENT_TIME).alias("timestamp"), F.col("ff").alias("temperature_c"))
    )
    json = (
        F.when(number % 37 == 17, None)
        .when(number % 31 == 13, F.substring(plain, F.lit(1), F.length(plain) - 12))
        .when(number % 41 == 19, other)
        .when((number % 29 == 11) | (number % 23 == 7), quoted)
        .otherwise(plain)
    )
    return fields.select("offset", F.lit(0).alias("partition"), F.col("kept_ts").alias("ts"), json.alias("json"))


def observation_messages(df: DataFrame) -> DataFrame:
    """The messages alone."""
    return observation_text(df).select("json")


def observation_records(df: DataFrame) -> DataFrame:
    """The same messages as records of a topic with one partition, offset by event."""
    return topic_records(observation_text(df).drop("ts"), STAND_IN_TOPIC)
