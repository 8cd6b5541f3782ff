"""One stream into several tables, and waiting for several streams."""

import time
from pathlib import Path

import pytest
from helpers import TopicFolder, at, message, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from obslayers.functions.messages import message_text
from obslayers.plans.live import archive_with_windows
from obslayers.plans.speed import speed_table
from obslayers.sources.topic import stream_topic
from obslayers.streaming.fanout import Watermarks, WindowFanOut
from obslayers.streaming.keyed import KeyedTable
from obslayers.streaming.parts import DailyParts
from obslayers.streaming.runs import UNTIL_CAUGHT_UP, start, wait, wait_all
from obslayers.streaming.sinks import EpochTable


def fan_out(path: Path, delay=None) -> WindowFanOut:
    return WindowFanOut(
        EpochTable(str(path / "rows")),
        speed_table(str(path / "windows")),
        DailyParts(str(path / "parts"), "6 minutes"),
        str(path / "checkpoint"),
        delay,
        EpochTable(str(path / "late")) if delay else None,
        2,
    )


def run(spark, folder, tables):
    wait(archive_with_windows(spark, folder.topic, tables, "earliest", every=UNTIL_CAUGHT_UP))


def windows(spark, tables):
    shown = tables.windows.latest(spark)
    return {(r.geo_id_insee, r.window_start.minute): round(r.avg_temp, 6) for r in shown.collect()}


def stamps(path: Path):
    return {str(file): file.stat().st_mtime_ns for file in path.rglob("*.parquet")}


def test_windows_go_on_over_batches(spark, tmp_path):
    folder, tables = TopicFolder(spark, tmp_path / "topic"), fan_out(tmp_path)
    folder.add(at("00:00:00", 280), at("00:07:00", 284), "hello", message(drop=("reference_time",)))
    run(spark, folder, tables)
    folder.add(at("00:01:00", 282), at("00:00:30", 290, "other"))
    run(spark, folder, tables)
    assert windows(spark, tables) == {("s", 0): 7.85, ("s", 6): 10.85, ("other", 0): 16.85}
    assert tables.rows.rows(spark).count() == 5
    # The second batch has written the windows it touched, and no others.
    last = spark.read.parquet(f"{tables.windows.path}/log/generation=1/epoch=1")
    assert rows(last.select("geo_id_insee", F.minute("window_start")), "geo_id_insee") == [("other", 0), ("s", 0)]


def test_a_retry_repeats_neither_table(spark, tmp_path, monkeypatch):
    folder, tables = TopicFolder(spark, tmp_path / "topic"), fan_out(tmp_path)
    folder.add(at("00:00:00", 280))
    run(spark, folder, tables)
    folder.add(at("00:01:00", 282))

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "upsert", broken)
        with pytest.raises(StreamingQueryException):
            run(spark, folder, tables)
    assert tables.rows.rows(spark).count() == 2 and windows(spark, tables) == {("s", 0): 6.85}
    before = stamps(tmp_path / "rows")
    run(spark, folder, tables)
    assert stamps(tmp_path / "rows") == before and windows(spark, tables) == {("s", 0): 7.85}
    # An epoch that is written in all tables stays as it is.
    before = stamps(tmp_path)
    generations = tables.generations(spark)
    tables.write(tables.rows.epoch(spark, generations["rows"], 1), 1, generations)
    after = stamps(tmp_path)
    assert after == before


def test_late_rows_are_kept_apart(spark, tmp_path):
    folder, tables = TopicFolder(spark, tmp_path / "topic"), fan_out(tmp_path, "7 minutes")
    for messages in (
        [at("00:00:00", 280)],
        [at("00:14:00", 281), at("00:01:00", 282)],
        [at("00:02:00", 290), at("00:07:30", 283), message(drop=("reference_time",))],
    ):
        folder.add(*messages)
        run(spark, folder, tables)
    late = rows(tables.late.rows(spark).select("reference_time", "epoch"))
    assert [(r[0].minute, r[1]) for r in late] == [(2, 2)]
    assert windows(spark, tables) == {("s", 0): 7.85, ("s", 6): 9.85, ("s", 12): 7.85}
    assert tables.rows.rows(spark).count() == 6


def test_watermarks_are_kept_and_replaced(spark, tmp_path):
    marks = Watermarks(str(tmp_path / "c"), keep=2)
    assert marks.before(spark, 0) is None
    for epoch, greatest in ((0, None), (1, 50), (1, 40), (2, 30), (3, None)):
        marks.note(spark, epoch, greatest)
    assert [marks.before(spark, epoch) for epoch in (3, 4)] == [40, 40]
    assert len(list((tmp_path / "c" / "_greatest_times").glob("[0-9]*"))) == 2


def test_a_delay_needs_a_place_for_late_rows(tmp_path):
    with pytest.raises(ValueError):
        WindowFanOut(EpochTable("r"), speed_table("w"), DailyParts("p", "6 minutes"), "c", delay="7 minutes")
    with pytest.raises(ValueError):
        WindowFanOut(EpochTable("r"), speed_table("w"), DailyParts("p"), "c")


def test_waiting_for_all_ends_when_one_fails(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00"))
    text = message_text(stream_topic(spark, folder.topic, "earliest"))
    endless = start(spark, text.writeStream.format("memory").queryName("endless"), every="1 second")

    def fail(batch, epoch):
        raise OSError("no such sink")

    failing = start(spark, text.writeStream.foreachBatch(fail), every="1 second")
    begin = time.monotonic()
    with pytest.raises(StreamingQueryException, match="no such sink"):
        wait_all(spark, [endless, failing])
    assert time.monotonic() - begin < 30 and not endless.isActive and not failing.isActive
    spark.streams.resetTerminated()


def test_waiting_for_all_passes_over_other_streams(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00"))
    text = message_text(stream_topic(spark, folder.topic, "earliest"))

    def fail(batch, epoch):
        raise OSError("another's")

    start(spark, text.writeStream.foreachBatch(fail), every=UNTIL_CAUGHT_UP)
    mine = [start(spark, text.writeStream.format("memory").queryName(f"mine{i}"), every=UNTIL_CAUGHT_UP) for i in range(2)]
    wait_all(spark, mine)
    wait_all(spark, [])
    assert not any(query.isActive for query in mine)
    spark.streams.resetTerminated()
