"""Queries over the driver's tables, and the SQL each must agree with.

``events`` stands in for a topic of station messages (``standin``), good and bad ones:
every query encodes it to JSON messages and goes through the operators from there.
Doubles are rounded to nine decimals on both sides, since an average depends on the
order of its additions, and timestamps are compared without a zone. Fewer decimals
would meet exact ties: event values have two, and their mean over 64 has up to eight.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslayers import storage
from obslayers.functions.messages import decode, encode, extract, extract_paths, json_column, message_text, to_double
from obslayers.operators.aggregates import (
    SPEED_WATERMARK,
    SPEED_WINDOW,
    TRIAL_WINDOW,
    hourly_rollup,
    row_count,
    running_summary,
    station_summary,
    windowed_averages,
)
from obslayers.operators.clean import (
    HOURLY_FIELDS,
    SUMMARY_FIELDS,
    WINDOW_FIELDS,
    archive_observations,
    averaged_observations,
    clean_messages,
    daily_observations,
    speed_observations,
)
from obslayers.operators.inspect import first_days
from obslayers.operators.report import report_lines
from obslayers.operators.counts import PassCounts, StreamCounts
from obslayers.plans.daily import add_new_parts, daily_table, daily_view, run_daily
from obslayers.plans.hourly import run_hourly
from obslayers.plans.judged import judge_new, rejected_messages, rejection_counts, usable_observations
from obslayers.plans.live import archive, archive_with_windows
from obslayers.plans.raw import ingest_all, ingest_new, raw_messages
from obslayers.plans.speed import run_speed, speed_table
from obslayers.plans.replay import write_replay
from obslayers.schemas import EVENT_TIME, OBSERVATION, STATION, only
from obslayers.sources.tables import append_table, read_table
from obslayers.sources.topic import Topic, publish, read_topic, topic_records
from obslayers.streaming.fanout import WindowFanOut
from obslayers.streaming.keyed import KeyedTable, serve
from obslayers.streaming.parts import DailyParts
from obslayers.streaming.runs import UNTIL_CAUGHT_UP, drop_checkpoint, start, wait, wait_all
from obslayers.streaming.sinks import EpochTable, Snapshots, to_keyed, to_parquet, to_snapshots
from obslayers.streaming.state import held_windows
from standin import (
    STAND_IN_TOPIC,
    events,
    observation_fields,
    observation_messages,
    observation_records,
    observation_text,
    raw_values,
    stream_events,
)

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
DECIMALS = 9
# Where the multi-epoch queries cut the events, by time: nothing comes late.
CUTS = ("2024-01-09", "2024-01-16", "2024-01-24")
# Files of an epoch in these small runs.
FILES = 4


def _comparable(df: DataFrame) -> DataFrame:
    """Doubles to a few decimals, timestamps without a zone."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "double":
            column = F.round(column, DECIMALS)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(name))
    return df.select(*columns)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observation_messages(events(spark, sf_dir))


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_text(observation_records(stream_events(spark, sf_dir)))


def _in_pieces(df: DataFrame, cuts: tuple[str, ...] = CUTS) -> list[DataFrame]:
    """The rows by their ``ts``: before the first cut, between two, and from the last."""
    bounds = list(zip((None, *cuts), (*cuts, None)))
    pieces = []
    for since, until in bounds:
        piece = df
        if since:
            piece = piece.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
        if until:
            piece = piece.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
        pieces.append(piece)
    return pieces


def _new_topic(spark: SparkSession) -> Topic:
    return Topic(folder=storage.new_folder(spark, "topic"))


# -- raw layer ---------------------------------------------------------------------


def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages(topic_records(raw_values(events(spark, sf_dir)), STAND_IN_TOPIC))


def raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, table = _new_topic(spark), storage.new_folder(spark, "raw")
    publish(raw_values(events(spark, sf_dir)), topic)
    ingest_all(spark, topic, table)
    return read_table(spark, table)


def _ingested(spark: SparkSession, topic: Topic, pieces: list[DataFrame], table: str, checkpoint: str) -> None:
    """Each piece is published, taken in by a run that ends, and the next run resumes."""
    for piece in pieces:
        publish(raw_values(piece), topic)
        wait(ingest_new(spark, topic, table, checkpoint))


def raw_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = storage.new_folder(spark, "raw")
    _ingested(spark, _new_topic(spark), _in_pieces(events(spark, sf_dir)), table, storage.new_folder(spark, "checkpoint"))
    return read_table(spark, table).select("json")


def raw_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reset stream is refused the old table; into a new one it takes the whole topic again."""
    topic, old, new = _new_topic(spark), storage.new_folder(spark, "raw"), storage.new_folder(spark, "raw")
    checkpoint, pieces = storage.new_folder(spark, "checkpoint"), _in_pieces(events(spark, sf_dir))
    _ingested(spark, topic, pieces[:2], old, checkpoint)
    drop_checkpoint(spark, checkpoint)
    try:
        wait(ingest_new(spark, topic, old, checkpoint))
        refused = False
    except ValueError:
        refused = True
    _ingested(spark, topic, pieces[2:], new, checkpoint)
    found = [("old", old), ("new", new)] if refused else []
    parts = [read_table(spark, path).select(F.lit(name).alias("part"), "json") for name, path in found]
    return parts[0].unionByName(parts[1])


# -- messages ----------------------------------------------------------------------


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(events(spark, sf_dir), ["event_id", "user_id", "event_type", "value"])


def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_paths(events(spark, sf_dir), ["k"], "props").select(to_double(F.col("k")).alias("k"))


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(events(spark, sf_dir), ["k"], "props").select(to_double(F.col("k")).alias("k"))


def json_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = only(OBSERVATION, [STATION, "t", "u", "pres"])
    return _comparable(decode(_messages(spark, sf_dir), schema))


def json_column_resolver(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_ingest(spark, sf_dir).withColumnRenamed("json", "value")
    return raw.select(F.col(json_column(raw)).alias("json"))


# -- clean observations ------------------------------------------------------------


def clean_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(speed_observations(_messages(spark, sf_dir)))


def archived_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(archive_observations(_messages(spark, sf_dir)))


def best_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily_observations(_messages(spark, sf_dir))
    return _comparable(rows.select(STATION, EVENT_TIME, "temperature_c"))


def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = only(OBSERVATION, [STATION, EVENT_TIME, "t"])
    return _comparable(clean_messages(_messages(spark, sf_dir), schema=schema, zone="Asia/Tokyo"))


# -- batch views -------------------------------------------------------------------


def daily_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(daily_view(_messages(spark, sf_dir)))


def daily_station_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(daily_view(_messages(spark, sf_dir), by_path=True))


def daily_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = storage.new_folder(spark, "daily")
    append_table(daily_view(_messages(spark, sf_dir)), table)
    return _comparable(read_table(spark, table))


def daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table grows piece by piece, and each run reads the new piece only."""
    raw, parts = storage.new_folder(spark, "raw"), storage.new_folder(spark, "parts")
    checkpoint, target = storage.new_folder(spark, "checkpoint"), daily_table(storage.new_folder(spark, "daily"))
    for piece in _in_pieces(observation_text(events(spark, sf_dir))):
        append_table(piece.select("json"), raw)
        wait(add_new_parts(spark, raw, parts, checkpoint, target))
        DailyParts(parts).fold(spark)
    return _comparable(target.latest(spark))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(hourly_rollup(archive_observations(_messages(spark, sf_dir), fields=HOURLY_FIELDS)))


def hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, table = storage.new_folder(spark, "clean"), storage.new_folder(spark, "hourly")
    append_table(archive_observations(_messages(spark, sf_dir)), clean)
    run_hourly(spark, clean, table)
    return _comparable(read_table(spark, table))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(station_summary(archive_observations(_messages(spark, sf_dir), fields=SUMMARY_FIELDS)))


def clean_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(daily_observations(_messages(spark, sf_dir)))


def ordered_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(first_days(daily_view(_messages(spark, sf_dir))))


# -- windows and streams -----------------------------------------------------------


def window_6m_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(windowed_averages(averaged_observations(_messages(spark, sf_dir))))


def _stream_windows(spark: SparkSession, sf_dir: str, mode: str, width: str, watermark: str | None) -> DataFrame:
    rows = averaged_observations(_message_stream(spark, sf_dir))
    windows = windowed_averages(rows, width, watermark, unbounded_state=watermark is None)
    table = speed_table(storage.new_folder(spark, "windows"))
    checkpoint = storage.new_folder(spark, "checkpoint")
    writer = to_keyed(windows, table, table.open_generation(spark, checkpoint), FILES)
    wait(start(spark, writer, mode, UNTIL_CAUGHT_UP, checkpoint))
    return _comparable(table.latest(spark))


def window_6m_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_windows(spark, sf_dir, "update", SPEED_WINDOW, SPEED_WATERMARK)


def window_6m_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_windows(spark, sf_dir, "append", SPEED_WINDOW, SPEED_WATERMARK)


def window_10m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_windows(spark, sf_dir, "update", TRIAL_WINDOW, None)


def running_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive_observations(_message_stream(spark, sf_dir), fields=SUMMARY_FIELDS)
    snapshots = Snapshots(storage.new_folder(spark, "running"))
    writer = to_snapshots(running_summary(rows, unbounded_state=True), snapshots)
    wait(start(spark, writer, "complete", UNTIL_CAUGHT_UP, storage.new_folder(spark, "checkpoint")))
    return _comparable(snapshots.last(spark))


def stream_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = storage.new_folder(spark, "clean")
    writer = to_parquet(archive_observations(_message_stream(spark, sf_dir)), table)
    wait(start(spark, writer, every=UNTIL_CAUGHT_UP, checkpoint=storage.new_folder(spark, "checkpoint")))
    return _comparable(read_table(spark, table))


def dual_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _message_stream(spark, sf_dir)
    rows, averaged = archive_observations(messages), archive_observations(messages, fields=WINDOW_FIELDS)
    table, clean = speed_table(storage.new_folder(spark, "windows")), storage.new_folder(spark, "clean")
    checkpoints = [storage.new_folder(spark, "checkpoint") for _ in range(2)]
    windows = windowed_averages(averaged, TRIAL_WINDOW, unbounded_state=True)
    keyed = to_keyed(windows, table, table.open_generation(spark, checkpoints[0]), FILES)
    streams = [
        start(spark, keyed, "update", UNTIL_CAUGHT_UP, checkpoints[0]),
        start(spark, to_parquet(rows, clean), every=UNTIL_CAUGHT_UP, checkpoint=checkpoints[1]),
    ]
    wait_all(spark, streams)
    shown = [
        ("window", table.latest(spark), "window_start", "avg_temp"),
        ("observation", read_table(spark, clean), EVENT_TIME, "temperature_c"),
    ]
    parts = [
        df.select(F.lit(part).alias("part"), STATION, F.col(time).alias("at"), F.col(value).alias("celsius"))
        for part, df, time, value in shown
    ]
    return _comparable(parts[0].unionByName(parts[1]))


def _fan_out(spark: SparkSession, width: str, delay: str | None = None) -> WindowFanOut:
    names = {name: storage.new_folder(spark, name) for name in ("rows", "windows", "parts", "late", "checkpoint")}
    return WindowFanOut(
        EpochTable(names["rows"]),
        speed_table(names["windows"]),
        DailyParts(names["parts"], width),
        names["checkpoint"],
        delay,
        EpochTable(names["late"]) if delay else None,
        FILES,
    )


def dual_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and rows by one stream that reads the topic once, in four resumed runs."""
    topic, fan_out = _new_topic(spark), _fan_out(spark, TRIAL_WINDOW)
    for piece in _in_pieces(observation_text(events(spark, sf_dir))):
        publish(piece.select("json", "offset", "partition"), topic)
        wait(archive_with_windows(spark, topic, fan_out, "earliest", every=UNTIL_CAUGHT_UP))
    shown = [
        ("window", fan_out.windows.latest(spark), "window_start", "avg_temp"),
        ("observation", fan_out.rows.rows(spark), EVENT_TIME, "temperature_c"),
    ]
    parts = [
        df.select(F.lit(part).alias("part"), STATION, F.col(time).alias("at"), F.col(value).alias("celsius"))
        for part, df, time, value in shown
    ]
    return _comparable(parts[0].unionByName(parts[1]))


def _late(spark: SparkSession, sf_dir: str) -> WindowFanOut:
    """The third quarter of the events comes after the fourth, when all its windows have closed."""
    topic, fan_out = _new_topic(spark), _fan_out(spark, SPEED_WINDOW, SPEED_WATERMARK)
    first, second, third, fourth = _in_pieces(observation_text(events(spark, sf_dir)))
    for piece in (first, second, fourth, third):
        publish(piece.select("json", "offset", "partition"), topic)
        wait(archive_with_windows(spark, topic, fan_out, "earliest", every=UNTIL_CAUGHT_UP))
    return fan_out


def late_rows_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that ``late_rows_dropped`` loses, from the side table."""
    late = _late(spark, sf_dir).late.rows(spark)
    return _comparable(late.select(STATION, EVENT_TIME, "temperature_c", "wind_speed", "humidity", "epoch"))


def late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows without the late rows, from the same stream."""
    return _comparable(_late(spark, sf_dir).windows.latest(spark))


def open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an append run still holds at its end, from the checkpoint's state."""
    rows = averaged_observations(_message_stream(spark, sf_dir))
    table, checkpoint = speed_table(storage.new_folder(spark, "windows")), storage.new_folder(spark, "checkpoint")
    windows = windowed_averages(rows, SPEED_WINDOW, SPEED_WATERMARK)
    writer = to_keyed(windows, table, table.open_generation(spark, checkpoint), FILES)
    wait(start(spark, writer, "append", UNTIL_CAUGHT_UP, checkpoint))
    return _comparable(held_windows(spark, checkpoint))


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted as they pass: by the daily job, and by an archive stream in four runs."""
    topic, raw, checkpoint = _new_topic(spark), storage.new_folder(spark, "raw"), storage.new_folder(spark, "checkpoint")
    clean, counts, passed = storage.new_folder(spark, "clean"), StreamCounts(), PassCounts()
    pieces = _in_pieces(observation_text(events(spark, sf_dir)))
    spark.streams.addListener(counts)
    try:
        for piece in pieces:
            publish(piece.select("json", "offset", "partition"), topic)
            query = archive(spark, topic, clean, checkpoint, "earliest", every=UNTIL_CAUGHT_UP)
            wait(query)
        streamed = counts.rows(query)
    finally:
        spark.streams.removeListener(counts)
    ingest_all(spark, topic, raw)
    run_daily(spark, raw, storage.new_folder(spark, "daily"), counts=passed)
    rows = [("daily", name, n) for name, n in passed.rows().items()] + [("archive", name, n) for name, n in streamed.items()]
    return spark.createDataFrame(rows, "job string, counted string, n bigint")


def _judged(spark: SparkSession, sf_dir: str) -> str:
    topic, table, checkpoint = _new_topic(spark), storage.new_folder(spark, "judged"), storage.new_folder(spark, "checkpoint")
    for piece in _in_pieces(observation_text(events(spark, sf_dir))):
        publish(piece.select("json", "offset", "partition"), topic)
        wait(judge_new(spark, topic, table, checkpoint))
    return table


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_messages(spark, _judged(spark, sf_dir)).select("offset", "reason")


def rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_counts(spark, _judged(spark, sf_dir))


def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(usable_observations(spark, _judged(spark, sf_dir)))


def mixed_raw_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily view of a raw table whose first files have ``json`` and whose last have ``value``."""
    raw, table = storage.new_folder(spark, "raw"), storage.new_folder(spark, "daily")
    first, second, third, fourth = _in_pieces(observation_text(events(spark, sf_dir)))
    for piece in (first, second):
        append_table(piece.select("json"), raw)
    for piece in (third, fourth):
        append_table(piece.select(F.col("json").alias("value")), raw)
    run_daily(spark, raw, table)
    return _comparable(read_table(spark, table))


# -- keyed tables and serving ------------------------------------------------------


def _run_live(spark: SparkSession, topic: Topic, table: KeyedTable, checkpoint: str, pieces: list[DataFrame]) -> None:
    """Each piece of messages is published and averaged by a run of its own, which resumes the last one."""
    for piece in pieces:
        publish(piece.select("json", "offset", "partition"), topic)
        wait(run_speed(spark, topic, table, checkpoint, starting="earliest", every=UNTIL_CAUGHT_UP, files=FILES))


def _live_table(spark: SparkSession, sf_dir: str) -> KeyedTable:
    table = speed_table(storage.new_folder(spark, "speed"))
    pieces = _in_pieces(observation_text(events(spark, sf_dir)))
    _run_live(spark, _new_topic(spark), table, storage.new_folder(spark, "checkpoint"), pieces)
    return table


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_live_table(spark, sf_dir).latest(spark))


def upsert_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a reset some stations' messages come again with other values, and win."""
    table, checkpoint = speed_table(storage.new_folder(spark, "speed")), storage.new_folder(spark, "checkpoint")
    rows = events(spark, sf_dir)
    _run_live(spark, _new_topic(spark), table, checkpoint, [observation_text(rows)])
    drop_checkpoint(spark, checkpoint)
    again = rows.where(F.col("user_id") % 3 == 0).withColumn("value", F.col("value") + 10)
    _run_live(spark, _new_topic(spark), table, checkpoint, [observation_text(again)])
    return _comparable(table.latest(spark))


def upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _live_table(spark, sf_dir)
    table.compact(spark)
    table.drop_replaced(spark)
    return _comparable(table.latest(spark))


def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third quarter comes after the fourth, when all its windows have closed."""
    table = speed_table(storage.new_folder(spark, "speed"))
    first, second, third, fourth = _in_pieces(observation_text(events(spark, sf_dir)))
    pieces = [first, second, fourth, third]
    _run_live(spark, _new_topic(spark), table, storage.new_folder(spark, "checkpoint"), pieces)
    return _comparable(table.latest(spark))


def interval_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live view on its interval, stopped once it has taken what is there."""
    topic, table = _new_topic(spark), speed_table(storage.new_folder(spark, "speed"))
    publish(observation_text(events(spark, sf_dir)).drop("ts"), topic)
    checkpoint = storage.new_folder(spark, "checkpoint")
    query = run_speed(spark, topic, table, checkpoint, starting="earliest", every="1 second", files=FILES)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _comparable(table.latest(spark))


def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batch runs into one keyed table: the second, by ``t`` alone, replaces every other station's days."""
    table = daily_table(storage.new_folder(spark, "daily"))
    rows = events(spark, sf_dir)
    table.upsert(daily_view(observation_messages(rows)), table.open_generation(spark))
    messages = observation_messages(rows.where(F.col("user_id") % 2 == 0))
    by_t = windowed_averages(averaged_observations(messages), "1 day")
    by_day = by_t.select(STATION, F.to_date("window_start").alias("date"), "avg_temp", "avg_wind", "avg_humidity")
    table.upsert(by_day, table.open_generation(spark))
    return _comparable(table.latest(spark))


def serving_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = daily_table(storage.new_folder(spark, "daily"))
    table.upsert(daily_view(_messages(spark, sf_dir)), table.open_generation(spark))
    serve(spark, {"batch_view": table})
    return _comparable(spark.sql(f"SELECT * FROM batch_view ORDER BY date, {STATION} LIMIT 10"))


def topic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = observation_fields(events(spark, sf_dir))
    # Every tenth message has no temperature.
    fields = fields.withColumn("t", F.when(F.col("offset") % 10 != 0, F.col("t")))
    message = F.to_json(F.struct(*[name for name in fields.columns if name != "offset"]))
    topic = Topic(folder=storage.new_folder(spark, "topic"))
    publish(fields.select("offset", F.lit(0).alias("partition"), message.alias("json")), topic)
    return report_lines(read_topic(spark, topic)).select("offset", "line")


def replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages of a topic, good and bad, as lines in a table."""
    topic, table = _new_topic(spark), storage.new_folder(spark, "lines")
    publish(observation_text(events(spark, sf_dir)).drop("ts"), topic)
    write_replay(spark, topic, table)
    return read_table(spark, table).select("offset", "line")


QUERIES: dict[str, Query] = {
    "raw_ingest": raw_ingest,
    "raw_roundtrip": raw_roundtrip,
    "raw_incremental": raw_incremental,
    "raw_after_reset": raw_after_reset,
    "json_encode": json_encode,
    "json_path": json_path,
    "json_extract": json_extract,
    "json_struct": json_struct,
    "json_column_resolver": json_column_resolver,
    "clean_observations": clean_observations,
    "archived_observations": archived_observations,
    "best_temperature": best_temperature,
    "local_time": local_time,
    "daily_station": daily_station,
    "daily_station_by_path": daily_station_by_path,
    "daily_appended": daily_appended,
    "daily_incremental": daily_incremental,
    "hourly_rollup": hourly,
    "hourly_table": hourly_table,
    "station_summary": summary,
    "row_count": clean_count,
    "ordered_preview": ordered_preview,
    "window_6m_static": window_6m_static,
    "window_6m_update": window_6m_update,
    "window_6m_append": window_6m_append,
    "window_10m_stream": window_10m_stream,
    "running_station": running_station,
    "stream_to_parquet": stream_to_parquet,
    "dual_stream": dual_stream,
    "dual_stream_once": dual_stream_once,
    "late_rows_kept": late_rows_kept,
    "late_windows": late_windows,
    "open_windows": open_windows,
    "observed_counts": observed_counts,
    "rejected_messages": rejected,
    "rejection_counts": rejections,
    "usable_observations": usable,
    "mixed_raw_columns": mixed_raw_columns,
    "upsert_latest": upsert_latest,
    "upsert_after_reset": upsert_after_reset,
    "upsert_compacted": upsert_compacted,
    "late_rows_dropped": late_rows_dropped,
    "interval_trigger": interval_trigger,
    "upsert_batch": upsert_batch,
    "serving_preview": serving_preview,
    "topic_report": topic_report,
    "replay_lines": replay_lines,
}


def _extra() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the optional subpackage, and the pipeline over it; none where it is missing."""
    try:
        import corpus_pipeline
        from obslayers.llm import queries as extra
    except ImportError:
        return {}, {}

    sql = dict(extra.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**extra.QUERIES, "pipeline": corpus_pipeline.run}, sql


def _in_utc(query: Query) -> Query:
    """Days and hours are taken in the session zone, so the queries pin it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The live view over the smallest tables: encode, decode, clean, average by window."""
    return _in_utc(window_6m_static)(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in {**QUERIES, **_extra()[0]}.items()}


def oracle_sql() -> dict[str, str]:
    station = "CAST(user_id AS VARCHAR) AS geo_id_insee"
    seconds = "date_trunc('second', ts)"

    def messages(value: str = "value", where: str = "true") -> str:
        """What can be read from the messages; a column is null where a message lacks it.

        ``t`` is the temperature as a number field, ``t_text`` as text, ``ts`` the time by the
        pattern, ``ts_iso`` by the ISO default.
        """
        return f"""(
            SELECT event_id, usable, {value} AS value,
                CASE WHEN usable AND event_id % 17 <> 3 THEN user_id END AS user_id,
                CASE WHEN usable AND event_id % 19 <> 5 AND (event_id % 43 = 23 OR event_id % 47 <> 29)
                    THEN {seconds} END AS ts,
                CASE WHEN usable AND event_id % 19 <> 5 THEN {seconds} END AS ts_iso,
                CASE WHEN usable AND event_id % 23 <> 7 AND event_id % 29 <> 11 THEN {value} END AS t,
                CASE WHEN usable AND event_id % 29 <> 11 THEN {value} END AS t_text
            FROM (SELECT *, event_id % 37 <> 17 AND event_id % 31 <> 13 AND event_id % 41 <> 19 AS usable
                FROM events WHERE {where}) AS e) AS m"""

    m = messages()
    # The temperature the daily view takes: t_10 on even events, ten degrees higher.
    best = "CASE WHEN event_id % 2 = 0 THEN value + 10 ELSE t_text END"

    raw = "SELECT props AS json FROM events WHERE props IS NOT NULL AND event_id % 37 <> 17"
    number = "SELECT CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"

    averages = """
        round(avg({temp}), 9) AS avg_temp,
        round(avg(value * 3.6), 9) AS avg_wind,
        round(avg(event_id % 101), 9) AS avg_humidity"""

    daily = f"""
        SELECT {station}, CAST(ts AS DATE) AS date, {averages.format(temp=best)}
        FROM {m} WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2"""

    def windows(minutes: int, source: str = m, time: str = "ts", wind: str = "value * 3.6") -> str:
        return f"""
        SELECT {station},
            time_bucket(INTERVAL '{minutes} minutes', {time}, TIMESTAMP '1970-01-01') AS window_start,
            {averages.format(temp="t").replace("value * 3.6", wind)}
        FROM {source} WHERE {time} IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2"""

    closed = f"""
        SELECT * FROM ({windows(6)}) AS w
        WHERE window_start + INTERVAL '6 minutes'
            <= (SELECT max(ts) FROM {m} WHERE user_id IS NOT NULL) - INTERVAL '7 minutes'"""

    archived = f"""
        SELECT {station}, CAST(user_id % 20 + 40 AS DOUBLE) AS lat, CAST(user_id % 10 AS DOUBLE) AS lon,
            ts_iso AS reference_time, round(t, 9) AS temperature_c,
            CAST(event_id % 101 AS DOUBLE) AS humidity, round(value, 9) AS wind_speed,
            CAST(event_id % 360 AS DOUBLE) AS wind_direction, round((event_id % 7) / 10.0, 9) AS rain,
            CAST(event_id % 500 + 101000 AS DOUBLE) AS pressure
        FROM {m} WHERE user_id IS NOT NULL"""

    hourly_sql = f"""
        SELECT {station}, date_trunc('hour', ts_iso) AS hour_bucket,
            round(avg(t), 9) AS avg_temperature_c,
            round(min(t), 9) AS min_temperature_c,
            round(max(t), 9) AS max_temperature_c,
            round(avg(event_id % 101), 9) AS avg_humidity,
            round(avg(value), 9) AS avg_wind_speed,
            round(sum((event_id % 7) / 10.0), 9) AS total_rain,
            round(avg(event_id % 500 + 101000), 9) AS avg_pressure,
            count(*) AS nb_observations
        FROM {m} WHERE ts_iso IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2"""

    # A line shows what the message has, the time as it is written there.
    local = "strftime(ts + INTERVAL '1 hour', '%Y-%m-%dT%H:%M:%S')"
    replayed = f"""
        SELECT event_id AS "offset",
            CASE WHEN NOT usable OR event_id % 19 = 5 THEN 'None'
                WHEN event_id % 43 = 23 THEN {local} || '+0100'
                WHEN event_id % 47 = 29 THEN {local} || '+01:00'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END
            || ' geo=' || CASE WHEN usable AND event_id % 17 <> 3 THEN CAST(user_id AS VARCHAR) ELSE 'None' END
            || ' T=' || CASE WHEN usable AND event_id % 23 <> 7 AND event_id % 29 <> 11
                THEN printf('%.2f', value) || '°C' ELSE 'N/A' END
            || ' U=' || CASE WHEN usable THEN CAST(event_id % 101 AS VARCHAR) ELSE 'None' END
            || ' FF=' || CASE WHEN usable THEN CAST(value AS VARCHAR) ELSE 'None' END
            || ' RR=' || CASE WHEN usable THEN CAST((event_id % 7) / 10.0 AS VARCHAR) ELSE 'None' END AS line
        FROM (SELECT event_id, user_id, value, {seconds} AS ts, event_id % 31 <> 13 AND event_id % 41 <> 19 AS usable
            FROM events WHERE event_id % 37 <> 17) AS e"""

    report = f"""
        SELECT event_id AS "offset",
            strftime({seconds}, '%Y-%m-%dT%H:%M:%SZ') || ' geo=' || CAST(user_id AS VARCHAR)
            || ' T=' || CASE WHEN event_id % 10 <> 0 THEN printf('%.2f', value) || '°C' ELSE 'N/A' END
            || ' U=' || CAST(event_id % 101 AS VARCHAR)
            || ' FF=' || CAST(value AS VARCHAR)
            || ' RR=' || CAST((event_id % 7) / 10.0 AS VARCHAR) AS line
        FROM events"""

    dual = f"""
        SELECT 'window' AS part, geo_id_insee, window_start AS at, avg_temp AS celsius
        FROM ({windows(10, time="ts_iso", wind="value")}) AS w
        UNION ALL
        SELECT 'observation' AS part, {station}, ts_iso AS at, round(t, 9) AS celsius FROM {m} WHERE user_id IS NOT NULL"""

    # The first thing that is wrong with a message; a broken one has neither station nor time either.
    reasons = f"""
        SELECT event_id AS "offset", CASE WHEN event_id % 37 = 17 THEN 'null' WHEN event_id % 31 = 13 THEN 'broken'
            WHEN event_id % 41 = 19 THEN 'off schema' WHEN user_id IS NULL THEN 'no station' WHEN ts IS NULL THEN 'no time'
            END AS reason
        FROM {m}"""

    return {
        "raw_ingest": raw,
        "raw_roundtrip": raw,
        "raw_incremental": raw,
        "raw_after_reset": f"""
            SELECT 'new' AS part, json FROM ({raw}) AS r
            UNION ALL SELECT 'old' AS part, json FROM ({raw} AND ts < TIMESTAMP '{CUTS[1]}') AS r""",
        "json_encode": """
            SELECT CAST(to_json(struct_pack(event_id := event_id, user_id := user_id,
                event_type := event_type, value := value)) AS VARCHAR) AS json
            FROM events""",
        "json_path": number,
        "json_extract": number,
        "json_struct": f"""
            SELECT {station}, round(t + 273.15, 9) AS t, CASE WHEN usable THEN CAST(event_id % 101 AS DOUBLE) END AS u,
                CASE WHEN usable THEN CAST(event_id % 500 + 101000 AS DOUBLE) END AS pres
            FROM {m}""",
        "json_column_resolver": raw,
        "clean_observations": f"""
            SELECT {station}, ts AS reference_time, round(t, 9) AS temperature_c,
                CAST(event_id % 101 AS DOUBLE) AS humidity, round(value * 3.6, 9) AS wind_speed,
                CAST(event_id % 360 AS DOUBLE) AS wind_direction, round((event_id % 7) / 10.0, 9) AS rain,
                CAST(event_id % 500 + 101000 AS DOUBLE) AS pressure
            FROM {m} WHERE user_id IS NOT NULL""",
        "archived_observations": archived,
        "best_temperature": f"""
            SELECT {station}, ts AS reference_time, round({best}, 9) AS temperature_c
            FROM {m} WHERE ts IS NOT NULL AND user_id IS NOT NULL""",
        # Tokyo is nine hours ahead all year.
        "local_time": f"""
            SELECT {station}, ts + INTERVAL '9 hours' AS reference_time, round(t, 9) AS temperature_c
            FROM {m} WHERE user_id IS NOT NULL""",
        "daily_station": daily,
        "daily_station_by_path": daily,
        "daily_appended": daily,
        "daily_incremental": daily,
        "hourly_rollup": hourly_sql,
        "hourly_table": hourly_sql,
        "station_summary": f"""
            SELECT {station}, count(*) AS nb_observations, round(avg(t), 9) AS avg_temperature_c,
                round(avg(event_id % 101), 9) AS avg_humidity
            FROM {m} WHERE user_id IS NOT NULL GROUP BY 1""",
        "row_count": f"SELECT count(*) AS n FROM {m} WHERE ts IS NOT NULL AND user_id IS NOT NULL",
        "ordered_preview": f"SELECT * FROM ({daily}) AS d ORDER BY date, geo_id_insee LIMIT 50",
        "window_6m_static": windows(6),
        "window_6m_update": windows(6),
        "window_6m_append": closed,
        "window_10m_stream": windows(10),
        "running_station": f"""
            SELECT {station}, round(avg(t), 9) AS avg_temperature_c,
                round(avg(event_id % 101), 9) AS avg_humidity, round(avg(value), 9) AS avg_wind_speed,
                count(*) AS nb_messages
            FROM {m} WHERE user_id IS NOT NULL GROUP BY 1""",
        "stream_to_parquet": archived,
        "dual_stream": dual,
        "dual_stream_once": dual,
        "late_rows_kept": f"""
            SELECT {station}, ts_iso AS reference_time, round(t, 9) AS temperature_c, round(value, 9) AS wind_speed,
                CAST(event_id % 101 AS DOUBLE) AS humidity, 3 AS epoch
            FROM {messages(where=f"ts >= TIMESTAMP '{CUTS[1]}' AND ts < TIMESTAMP '{CUTS[2]}'")}
            WHERE ts_iso IS NOT NULL AND user_id IS NOT NULL""",
        "late_windows": windows(
            6, messages(where=f"ts < TIMESTAMP '{CUTS[1]}' OR ts >= TIMESTAMP '{CUTS[2]}'"), time="ts_iso", wind="value"
        ),
        "open_windows": f"{windows(6)} EXCEPT ALL {closed}",
        "observed_counts": f"""
            SELECT 'daily' AS job, 'read' AS counted, count(*) AS n FROM {m} WHERE event_id % 37 <> 17
            UNION ALL SELECT 'daily', 'usable', count(*) FROM {m} WHERE ts IS NOT NULL AND user_id IS NOT NULL
            UNION ALL SELECT 'daily', 'written', count(*) FROM ({daily}) AS d
            UNION ALL SELECT 'archive', 'read', count(*) FROM {m}
            UNION ALL SELECT 'archive', 'written', count(*) FROM {m} WHERE user_id IS NOT NULL""",
        "rejected_messages": f"SELECT * FROM ({reasons}) AS r WHERE reason IS NOT NULL",
        "rejection_counts": f"SELECT reason, count(*) AS n FROM ({reasons}) AS r WHERE reason IS NOT NULL GROUP BY 1",
        "usable_observations": f"""
            SELECT {station}, CAST(user_id % 20 + 40 AS DOUBLE) AS lat, CAST(user_id % 10 AS DOUBLE) AS lon,
                ts AS reference_time, round(t, 9) AS temperature_c, CAST(event_id % 101 AS DOUBLE) AS humidity,
                round(value * 3.6, 9) AS wind_speed, CAST(event_id % 360 AS DOUBLE) AS wind_direction,
                round((event_id % 7) / 10.0, 9) AS rain, CAST(event_id % 500 + 101000 AS DOUBLE) AS pressure
            FROM {m} WHERE user_id IS NOT NULL AND ts IS NOT NULL""",
        "mixed_raw_columns": daily,
        "upsert_latest": windows(6),
        "upsert_after_reset": f"""
            {windows(6, messages(where="user_id % 3 <> 0"))}
            UNION ALL {windows(6, messages("value + 10", "user_id % 3 = 0"))}""",
        "upsert_compacted": windows(6),
        "late_rows_dropped": windows(6, messages(where=f"ts < TIMESTAMP '{CUTS[1]}' OR ts >= TIMESTAMP '{CUTS[2]}'")),
        "interval_trigger": windows(6),
        "upsert_batch": f"""
            SELECT {station}, CAST(ts AS DATE) AS date, {averages.format(temp="CASE WHEN user_id % 2 = 0 THEN t ELSE " + best + " END")}
            FROM {m} WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2""",
        "serving_preview": f"SELECT * FROM ({daily}) AS d ORDER BY date, geo_id_insee LIMIT 10",
        "topic_report": report,
        "replay_lines": replayed,
        **_extra()[1],
    }
