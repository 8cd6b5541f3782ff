"""Streams over numbered topic files, one file per micro-batch."""

import datetime
import os
from pathlib import Path

import pytest
from helpers import TopicFolder, at, message, rows, texts

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from obslayers.functions.messages import message_text
from obslayers.operators.aggregates import running_summary, speed_view, windowed_averages
from obslayers.operators.clean import archive_observations, averaged_observations
from obslayers.plans import live
from obslayers.plans.daily import daily_view
from obslayers.plans.raw import ingest_all, ingest_new, raw_messages
from obslayers.plans.speed import run_speed, speed_table
from obslayers.sources.tables import append_table, read_table
from obslayers.sources.topic import Topic, publish, read_topic, stream_topic
from obslayers.streaming.runs import (
    UNTIL_CAUGHT_UP,
    LateRows,
    drop_checkpoint,
    start,
    state_partitions,
    wait,
    wait_all,
    wait_any,
)
from obslayers.streaming.sinks import Snapshots, to_snapshots


class Live:
    """A live view over a topic folder, run until it has caught up."""

    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.folder = TopicFolder(spark, tmp_path / "topic")
        self.table = speed_table(str(tmp_path / "speed"), keep_seconds=0)
        self.checkpoint = str(tmp_path / "checkpoint")

    def run(self, mode="update", **options):
        query = run_speed(
            self.spark,
            self.folder.topic,
            self.table,
            options.pop("checkpoint", self.checkpoint),
            starting="earliest",
            every=UNTIL_CAUGHT_UP,
            mode=mode,
            per_trigger=1,
            partitions=2,
            **{"files": 2, **options},
        )
        wait(query)
        return query

    def late(self):
        """Rows dropped as late by one run."""
        late = LateRows()
        self.spark.streams.addListener(late)
        try:
            query = self.run()
            self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        finally:
            self.spark.streams.removeListener(late)
        return late.of(query)

    def epoch(self, epoch, generation=1):
        """Window start and average Kelvin temperature of each row an epoch wrote."""
        path = f"{self.table.path}/log/generation={generation}/epoch={epoch}"
        return self._windows(self.spark.read.parquet(path))

    def latest(self):
        return self._windows(self.table.latest(self.spark))

    def written(self, epochs, generation=1):
        return [row for epoch in range(epochs) for row in self.epoch(epoch, generation)]

    @staticmethod
    def _windows(df):
        kelvin = F.round(F.col("avg_temp") + 273.15, 6)
        return rows(df.select(F.date_format("window_start", "HH:mm"), kelvin), "window_start")


@pytest.fixture
def view(spark, tmp_path):
    return Live(spark, tmp_path)


def test_on_time(view):
    view.folder.add(at("00:00:00", 280), at("00:05:59", 282))
    view.folder.add(at("00:14:00", 290))
    view.run()
    assert view.epoch(0) == [("00:00", 281.0)]
    assert view.epoch(1) == [("00:12", 290.0)]


def test_late_row_in_the_next_batch_is_merged(view):
    view.folder.add(at("00:00:00", 280))
    view.folder.add(at("00:14:00", 290))
    view.folder.add(at("00:01:00", 284))
    assert view.late() == 0
    assert view.epoch(2) == [("00:00", 282.0)]


def test_late_row_after_the_watermark_is_dropped(view):
    view.folder.add(at("00:00:00", 280))
    view.folder.add(at("00:14:00", 290))
    view.folder.add(at("00:15:00", 292))
    view.folder.add(at("00:01:00", 284), at("00:06:30", 286))
    view.folder.add(at("00:40:00", 300))
    assert view.late() == 1
    assert view.epoch(3) == [("00:06", 286.0)]
    assert view.latest() == [("00:00", 280.0), ("00:06", 286.0), ("00:12", 291.0), ("00:36", 300.0)]


def test_append_writes_each_closed_window_once(view):
    view.folder.add(at("00:00:00", 280))
    view.folder.add(at("00:14:00", 290))
    view.folder.add(at("00:01:00", 284))
    view.folder.add(at("00:30:00", 300))
    query = view.run(mode="append")
    epochs = query.lastProgress["batchId"] + 1
    assert sorted(view.written(epochs)) == [("00:00", 282.0), ("00:12", 290.0)]


def test_restart_goes_on_from_the_checkpoint(view):
    view.folder.add(at("00:00:00", 280), at("00:05:59", 282))
    view.folder.add(at("00:14:00", 290))
    first = view.run().lastProgress["batchId"]
    before = view.written(first + 1)
    view.folder.add(at("00:15:00", 294), at("00:20:00", 296))
    query = view.run()
    assert view.written(first + 1) == before
    assert query.recentProgress[0]["batchId"] == first + 1
    assert view.latest() == [("00:00", 281.0), ("00:12", 292.0), ("00:18", 296.0)]
    assert view.table.open_generation(view.spark, view.checkpoint) == 1


def test_new_checkpoint_starts_a_generation_that_wins(view, tmp_path):
    view.folder.add(at("00:00:00", 280))
    view.folder.add(at("00:14:00", 290), at("00:15:00", 294))
    view.run()
    later = Live(view.spark, tmp_path / "later")
    later.folder.add(at("00:16:00", 300), at("00:26:00", 302))
    view.folder = later.folder
    view.run(checkpoint=str(tmp_path / "fresh"))
    assert view.latest() == [("00:00", 280.0), ("00:12", 300.0), ("00:24", 302.0)]


def test_dropping_the_checkpoint_resets_the_stream(view):
    view.folder.add(at("00:00:00", 280))
    view.folder.add(at("00:14:00", 290))
    view.run()
    drop_checkpoint(view.spark, view.checkpoint)
    view.folder.add(at("00:01:00", 284))
    view.run()
    assert view.epoch(0, generation=2) == [("00:00", 280.0)]
    assert view.latest() == [("00:00", 282.0), ("00:12", 290.0)]


def test_result_does_not_depend_on_the_split_into_files(view, tmp_path):
    messages = [at(f"00:{m:02d}:00", 280 + m % 7, f"s{m % 3}") for m in range(0, 60, 2)]
    for begin in range(0, 30, 7):
        view.folder.add(*messages[begin : begin + 7])
    view.run(watermark="1 day")
    whole = Live(view.spark, tmp_path / "whole")
    whole.folder.add(*messages)
    whole.run(watermark="1 day")
    static = windowed_averages(averaged_observations(message_text(read_topic(view.spark, view.folder.topic))))
    key = ["geo_id_insee", "window_start"]
    rounded = [F.round(name, 9) for name in ("avg_temp", "avg_wind", "avg_humidity")]
    results = [
        rows(df.select(*key, *rounded), *key)
        for df in (static, view.table.latest(view.spark), whole.table.latest(view.spark))
    ]
    assert len(results[0]) == 30 and results[0] == results[1] == results[2]


def test_rows_without_time_open_no_window(view):
    view.folder.add(at("00:00:00"), message(drop=["reference_time"]), "hello")
    view.run()
    assert len(view.latest()) == 1


def test_windows_have_a_start(spark):
    clean = averaged_observations(texts(spark, [at("00:00:00"), message(reference_time="garbage")]))
    windows = windowed_averages(clean)
    assert windows.count() == 1 and windows.filter("window_start IS NULL").count() == 0


def test_files_per_epoch(view):
    view.folder.add(*[at(f"{h:02d}:00:00", 280, f"s{h}") for h in range(20)])
    view.run(files=3)
    assert len(view.latest()) == 20
    assert len(list(Path(view.table.path).glob("log/generation=1/epoch=0/part-*.parquet"))) <= 3


def test_several_tasks_write_an_epoch(view):
    view.folder.add(*[at(f"{h:02d}:00:00", 280, f"s{h}") for h in range(20)])
    query = run_speed(
        view.spark, view.folder.topic, view.table, view.checkpoint, starting="earliest", every=UNTIL_CAUGHT_UP, partitions=4
    )
    wait(query)
    assert len(list(Path(view.table.path).glob("log/generation=1/epoch=0/part-*.parquet"))) > 4
    assert len(view.latest()) == 20


def test_old_files_are_read(view):
    """A copied file keeps its old time; the newest one seen must not hide it."""
    view.folder.add(at("00:00:00", 280))
    view.run()
    view.folder.add(at("00:06:00", 281))
    newest = max(view.folder.path.glob("part-*.parquet"), key=lambda p: p.stat().st_mtime)
    os.utime(newest, (1_600_000_000, 1_600_000_000))
    view.run()
    assert len(view.latest()) == 2


def test_reset_of_a_parquet_stream_is_refused(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    table, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    folder.add(message(t=1))
    wait(ingest_new(spark, folder.topic, table, checkpoint))
    folder.add(message(t=2))
    wait(ingest_new(spark, folder.topic, table, checkpoint))
    drop_checkpoint(spark, checkpoint)
    folder.add(message(t=3))
    for start_again in (
        lambda: ingest_new(spark, folder.topic, table, checkpoint),
        lambda: live.archive(spark, folder.topic, table, checkpoint, "earliest", every=UNTIL_CAUGHT_UP),
        lambda: live.print_windows_and_archive(spark, folder.topic, table, checkpoint, "earliest", every=UNTIL_CAUGHT_UP),
    ):
        with pytest.raises(ValueError, match="another checkpoint"):
            start_again()
    wait(ingest_new(spark, folder.topic, str(tmp_path / "raw2"), checkpoint))
    assert read_table(spark, table).count() == 2 and read_table(spark, str(tmp_path / "raw2")).count() == 3


def test_reading_options_reach_kafka(spark, monkeypatch):
    """No broker and no package here: what the jobs pass to the reader."""
    seen = []

    class Reader:
        def __getattr__(self, name):
            def call(*args, **_):
                seen.append((name, *args))
                return self

            return call

    class Session:
        read = readStream = Reader()

    topic = Topic(servers="a:1")
    stream_topic(Session(), topic, per_trigger=7, min_partitions=9)
    read_topic(Session(), topic, min_partitions=9)
    assert ("option", "maxOffsetsPerTrigger", 7) in seen and seen.count(("option", "minPartitions", 9)) == 2


def test_compaction_beside_the_stream(view):
    for minute in range(0, 30, 6):
        view.folder.add(at(f"00:{minute:02d}:00", 280 + minute), at("00:01:00", 280 + minute))
    query = view.run(watermark="1 day", compact_every=2)
    average = sum(280 + minute for minute in [0, *range(0, 30, 6)]) / 6
    assert view.latest() == [
        ("00:00", round(average, 6)),
        *[(f"00:{minute:02d}", 280.0 + minute) for minute in range(6, 30, 6)],
    ]
    assert list(Path(view.table.path).glob("base/run=*/_folded"))
    epochs = list(Path(view.table.path).glob("log/generation=1/epoch=*"))
    assert len(epochs) < query.lastProgress["batchId"] + 1


def test_update_and_append_need_a_bound_on_state(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00"))
    observations = archive_observations(message_text(stream_topic(spark, folder.topic, "earliest")))
    with pytest.raises(ValueError):
        windowed_averages(observations)
    with pytest.raises(ValueError):
        running_summary(observations)
    assert speed_view(observations).isStreaming
    without = windowed_averages(observations, unbounded_state=True)
    writer = without.writeStream.format("memory").queryName("refused")
    with pytest.raises(AnalysisException):
        start(spark, writer, "append", UNTIL_CAUGHT_UP)


def test_complete_mode_keeps_running_totals(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00", 280, "a"), at("00:01:00", 282, "b"))
    folder.add(at("00:02:00", 284, "a"), message(geo_id_insee="b", drop=["reference_time", "t"]))
    folder.add(at("00:03:00", 288, "a"))
    stream = stream_topic(spark, folder.topic, "earliest", per_trigger=1)
    totals = running_summary(archive_observations(message_text(stream)), unbounded_state=True)
    snapshots = Snapshots(str(tmp_path / "totals"))
    wait(start(spark, to_snapshots(totals, snapshots), "complete", UNTIL_CAUGHT_UP, str(tmp_path / "c"), 2))
    last = snapshots.last(spark).select("geo_id_insee", F.round("avg_temperature_c", 6), "nb_messages")
    assert rows(last, "geo_id_insee") == [("a", 10.85, 3), ("b", 8.85, 2)]
    assert len(list((tmp_path / "totals").glob("epoch=*"))) == 2


def test_raw_ingestion(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00"), None, "hello")
    full, new = str(tmp_path / "full"), str(tmp_path / "new")
    ingest_all(spark, folder.topic, full)
    assert read_table(spark, full).columns == ["json"]
    wait(ingest_new(spark, folder.topic, new, str(tmp_path / "c")))
    folder.add(at("00:06:00"))
    ingest_all(spark, folder.topic, full)
    wait(ingest_new(spark, folder.topic, new, str(tmp_path / "c")))
    assert read_table(spark, full).count() == 5
    assert read_table(spark, new).count() == 3
    # Old messages weigh twice in one table and once in the other.
    assert daily_view(read_table(spark, full)).count() == daily_view(read_table(spark, new)).count() == 1
    with pytest.raises(ValueError):
        append_table(raw_messages(read_topic(spark, folder.topic)), new)
    plain = str(tmp_path / "plain")
    wait(ingest_new(spark, folder.topic, plain, str(tmp_path / "c2"), by_day=False))
    assert read_table(spark, plain).columns == ["json"]


def test_archive_is_exactly_once_over_restarts(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    table, checkpoint = str(tmp_path / "clean"), str(tmp_path / "c")
    for clock in ("00:00:00", "00:06:00"):
        folder.add(at(clock), "hello")
        wait(live.archive(spark, folder.topic, table, checkpoint, "earliest", every=UNTIL_CAUGHT_UP))
    clean = read_table(spark, table)
    assert clean.count() == 2 and clean.columns[-1] == "pressure"
    by_day = str(tmp_path / "by_day")
    wait(
        live.archive(
            spark, folder.topic, by_day, str(tmp_path / "c2"), "earliest", every=UNTIL_CAUGHT_UP, by_day=True
        )
    )
    assert read_table(spark, by_day).first().reference_date == datetime.date(2024, 1, 1)


def test_console_streams(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00", 280, "station-one"), "hello")
    options = {"starting": "earliest", "every": UNTIL_CAUGHT_UP}
    table = str(tmp_path / "clean")
    shown = {
        "message": live.print_messages(spark, folder.topic, **options),
        "observation": live.print_observations(spark, folder.topic, **options),
        "summary": live.print_running_summary(spark, folder.topic, **options),
    }
    shown["window"], archived = live.print_windows_and_archive(
        spark, folder.topic, table, str(tmp_path / "c"), **options
    )
    wait_all(spark, [*shown.values(), archived])
    first = {name: query.recentProgress[0]["sink"] for name, query in shown.items()}
    assert all("Console" in sink["description"] for sink in first.values())
    # Raw text and unfiltered rows show both messages, the others only the usable one.
    written = {name: sink["numOutputRows"] for name, sink in first.items()}
    assert written == {"message": 2, "observation": 2, "summary": 1, "window": 1}
    assert read_table(spark, table).count() == 1


def test_waiting_and_interval_trigger(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00"))
    rows_ = archive_observations(message_text(stream_topic(spark, folder.topic, "earliest")))
    writer = rows_.writeStream.format("memory")
    query = start(spark, writer, every="1 second", name="interval")
    try:
        assert not wait(query, 0.1)
        query.processAllAvailable()
        assert spark.table("interval").count() == 1
    finally:
        query.stop()
    assert wait(query)
    assert wait_any(spark, 1)
    spark.streams.resetTerminated()
    assert state_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_start_from_a_moment_in_a_folder(spark, tmp_path):
    topic = Topic(folder=str(tmp_path / "topic"))
    old = spark.createDataFrame([(at("00:00:00"), datetime.datetime(2024, 1, 1))], "json string, timestamp timestamp")
    new = spark.createDataFrame([(at("00:06:00"), datetime.datetime(2024, 1, 3))], "json string, timestamp timestamp")
    publish(old.unionByName(new), topic)
    stream = stream_topic(spark, topic, since="2024-01-02")
    wait(start(spark, stream.writeStream.format("memory").queryName("since"), every=UNTIL_CAUGHT_UP))
    assert spark.table("since").count() == 1
    with pytest.raises(ValueError):
        stream_topic(spark, topic)


def test_topic_is_kafka_or_folder():
    with pytest.raises(ValueError):
        Topic()
    with pytest.raises(ValueError):
        Topic(servers="a:1", folder="b")


def test_kafka_needs_its_package(spark):
    with pytest.raises(AnalysisException):
        read_topic(spark, Topic(servers="localhost:1"), min_partitions=4)
    with pytest.raises(AnalysisException):
        stream_topic(spark, Topic(servers="localhost:1"), per_trigger=10, min_partitions=4)
