"""The daily view: raw table to averages per station and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from obslayers import storage
from obslayers.operators.aggregates import daily_averages, daily_from_parts
from obslayers.operators.clean import daily_observations
from obslayers.operators.counts import PassCounts
from obslayers.operators.inspect import first_days, schema_text, show_preview
from obslayers.schemas import DAILY_KEYS, EVENT_TIME
from obslayers.sources.tables import RAW_SCHEMA, append_table, either_column, read_raw, require_messages
from obslayers.sources.topic import MAX_FILE_AGE
from obslayers.streaming.keyed import KeyedTable
from obslayers.streaming.parts import DailyParts
from obslayers.streaming.runs import UNTIL_CAUGHT_UP, start


def daily_table(path: str) -> KeyedTable:
    return KeyedTable(path, DAILY_KEYS, "date")


def daily_view(raw: DataFrame, by_path: bool = False, strict: bool = False) -> DataFrame:
    return daily_averages(daily_observations(raw, by_path=by_path, strict=strict))


# Names of the counts that a daily run takes.
READ, USABLE, WRITTEN = "read", "usable", "written"


def show_raw(raw: DataFrame, by_path: bool = False, strict: bool = False) -> None:
    """Schema and five rows of the raw table, and twenty times of clean rows."""
    print(schema_text(raw))
    show_preview(raw, 5)
    show_preview(daily_observations(raw, by_path=by_path, strict=strict).select(EVENT_TIME), 20)


def counted_daily(raw: DataFrame, counts: PassCounts, by_path: bool = False, strict: bool = False) -> DataFrame:
    """The daily view, counting on the way the messages read, the usable ones and the rows of the view."""
    clean = daily_observations(counts.of(raw, READ), by_path=by_path, strict=strict)
    return counts.of(daily_averages(counts.of(clean, USABLE)), WRITTEN)


def run_daily(
    spark: SparkSession,
    raw: str,
    table: str | None = None,
    target=None,
    show: bool = False,
    by_path: bool = False,
    strict: bool = False,
    counts: PassCounts | None = None,
) -> DataFrame:
    """Compute the daily view of the whole raw table and store it.

    Appends to the parquet ``table`` (a second run appends again) and upserts into
    the keyed ``target``. If the result is wanted more than once it is written to the
    shared folder first, so that the raw table is scanned and parsed once; ``counts``
    are taken in that same pass. ``show`` prints what the raw table looks like, the
    counts and the view's first days.
    """
    rows = read_raw(spark, raw)
    counts = counts or PassCounts()
    daily = counted_daily(rows, counts, by_path, strict)
    uses = (2 if show else 0) + (table is not None) + (target is not None)
    if uses > 1:
        daily = storage.materialize(daily, "daily")
    if show:
        show_raw(rows, by_path, strict)
        passed = counts.rows()
        print(f"messages: {passed[READ]}\nclean rows: {passed[USABLE]}\nrows: {passed[WRITTEN]}")
        show_preview(first_days(daily), 50)
    if table is not None:
        append_table(daily, table)
    if target is not None:
        target.upsert(daily, target.open_generation(spark))
    return daily


def add_new_parts(
    spark: SparkSession,
    raw: str,
    parts: str,
    checkpoint: str,
    target=None,
    per_trigger: int | None = None,
    by_path: bool = False,
    strict: bool = False,
) -> StreamingQuery:
    """Fold what the raw table gained into the daily view, reading each message once.

    With a new checkpoint the raw table is read from its start into new parts. Every
    micro-batch adds its sums and counts per station and day to ``parts``, in a
    folder of its own so that a repeat replaces it, and upserts the days it touched
    into ``target``, reading the parts of those days only. The result is that of
    ``run_daily`` over the whole raw table, for the cost of the new part of it.
    ``per_trigger`` bounds the raw files of one micro-batch.
    """
    require_messages(spark, raw)
    reader = spark.readStream.schema(RAW_SCHEMA).option("maxFileAge", MAX_FILE_AGE)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    observations = daily_observations(either_column(reader.parquet(raw)), by_path=by_path, strict=strict)
    table = DailyParts(parts)
    home = table.open_generation(spark, checkpoint)
    generation = None if target is None else target.open_generation(spark, checkpoint)

    def add(batch: DataFrame, epoch: int) -> None:
        days = table.add(batch, home, epoch)
        if target is not None and days:
            target.upsert(daily_from_parts(table.read(batch.sparkSession, home, days)), generation, epoch)

    return start(spark, observations.writeStream.foreachBatch(add), every=UNTIL_CAUGHT_UP, checkpoint=checkpoint)


def daily_of_parts(spark: SparkSession, parts: str) -> DataFrame:
    """The daily view as of the last ``add_new_parts``, from the newest generation of parts."""
    table = DailyParts(parts)
    return daily_from_parts(table.read(spark, table.newest_generation(spark)))
