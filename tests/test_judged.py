"""Messages told apart, counts in passing, raw tables whose files differ, and state read back."""

import json
import sys

import pytest
from helpers import OFF_SCHEMA, TopicFolder, at, message, rows, texts
from test_plans import count, plan


from obslayers.functions.messages import message_text
from obslayers.operators.aggregates import windowed_averages
from obslayers.operators.clean import averaged_observations
from obslayers.operators.counts import PassCounts, StreamCounts
from obslayers.operators.verdicts import judged_messages
from obslayers.plans.daily import counted_daily, run_daily
from obslayers.plans.judged import judge_new, rejected_messages, usable_observations
from obslayers.plans.live import archive
from obslayers.plans.speed import speed_table
from obslayers.sources.tables import append_table, read_raw
from obslayers.sources.topic import stream_topic
from obslayers.streaming.runs import UNTIL_CAUGHT_UP, start, wait
from obslayers.streaming.sinks import to_keyed
from obslayers.streaming.state import held_windows, state_operators

CASES = [
    (message(), None),
    (message(t="abc"), None),
    (message(drop=("t", "u")), None),
    (None, "null"),
    ("", "broken"),
    ("  ", "broken"),
    ("hello", "broken"),
    ("null", "broken"),
    ('{"geo_id_insee":"a",', "broken"),
    (f"[{message()}]", "broken"),
    ("{}", "off schema"),
    ('{"t":"abc"}', "off schema"),
    (json.dumps(OFF_SCHEMA), "off schema"),
    (message(drop=("geo_id_insee",)), "no station"),
    (message(drop=("geo_id_insee", "reference_time")), "no station"),
    (message(drop=("reference_time",)), "no time"),
    (message(reference_time="garbage"), "no time"),
    (message(reference_time="2024-01-01T00:00:00+01:00"), "no time"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, json string")
    judged = judged_messages(df, ["i"])
    found = {r.i: r for r in judged.collect()}
    for i, (text, reason) in enumerate(CASES):
        row = found[i]
        assert (row.reason, row.verdict) == (reason, "rejected" if reason else "usable"), text
        assert row.message == (text if reason else None)
        assert (row.geo_id_insee is None) == (reason is not None)
    assert found[0].reference_time is not None and found[1].temperature_c is None
    assert count("from_json", plan(judged)) == 1


def test_judged_table_over_restarts(spark, tmp_path):
    folder, table, checkpoint = TopicFolder(spark, tmp_path / "topic"), str(tmp_path / "t"), str(tmp_path / "c")
    for clock in ("00:00:00", "00:06:00"):
        folder.add(at(clock), "hello", None)
        wait(judge_new(spark, folder.topic, table, checkpoint))
    assert sorted(r.reason for r in rejected_messages(spark, table).collect()) == ["broken", "broken", "null", "null"]
    good = usable_observations(spark, table)
    assert good.count() == 2 and good.columns[0] == "geo_id_insee"
    text = plan(good)
    assert "PartitionFilters: [isnotnull(verdict" in text and count("FileScan", text) == 1


def test_counts_are_taken_in_the_writing_pass(spark, tmp_path, capsys):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "daily")
    append_table(texts(spark, [message(), message(t=287.4), "hello", message(geo_id_insee="b"), None]), raw)
    counts = PassCounts()
    counted = counted_daily(read_raw(spark, raw), counts)
    text = plan(counted)
    assert count("FileScan", text) == 1 and count("CollectMetrics", text) == 3 and count("Exchange", text) == 1
    counted.collect()
    assert counts.rows() == {"read": 5, "usable": 3, "written": 2}
    given = PassCounts()
    run_daily(spark, raw, out, counts=given)
    assert given.rows() == counts.rows()
    run_daily(spark, raw, out, show=True)
    assert "messages: 5\nclean rows: 3\nrows: 2\n" in capsys.readouterr().out


def test_counts_of_a_stream_add_up_over_restarts(spark, tmp_path):
    folder, counts = TopicFolder(spark, tmp_path / "topic"), StreamCounts()
    spark.streams.addListener(counts)
    try:
        for clock in ("00:00:00", "00:06:00"):
            folder.add(at(clock), "hello")
            query = archive(spark, folder.topic, str(tmp_path / "t"), str(tmp_path / "c"), "earliest", every=UNTIL_CAUGHT_UP)
            wait(query)
        assert counts.rows(query) == {"read": 4, "written": 2}
    finally:
        spark.streams.removeListener(counts)


def test_raw_files_with_either_column(spark, tmp_path):
    raw = str(tmp_path / "raw")
    append_table(texts(spark, ["a", None]), raw)
    append_table(texts(spark, ["b", None]).withColumnRenamed("json", "value"), raw)
    both = read_raw(spark, raw)
    assert both.columns == ["json"]
    assert sorted(r.json or "" for r in both.collect()) == ["", "", "a", "b"]
    other = str(tmp_path / "other")
    append_table(texts(spark, ["a"]).withColumnRenamed("json", "body"), other)
    with pytest.raises(ValueError):
        read_raw(spark, other)


def test_held_windows_by_batch(spark, tmp_path):
    folder, checkpoint = TopicFolder(spark, tmp_path / "topic"), str(tmp_path / "c")
    table, held = speed_table(str(tmp_path / "t")), []
    for messages in ([at("00:00:00", 280), at("00:01:00", 282)], [at("00:30:00", 290)]):
        folder.add(*messages)
        rows_ = averaged_observations(message_text(stream_topic(spark, folder.topic, "earliest")))
        windows = windowed_averages(rows_, "6 minutes", "7 minutes")
        writer = to_keyed(windows, table, table.open_generation(spark, checkpoint), 1)
        wait(start(spark, writer, "append", UNTIL_CAUGHT_UP, checkpoint, 2))
        held.append([(r.window_start.minute, round(r.avg_temp, 6)) for r in held_windows(spark, checkpoint).collect()])
    assert held == [[(0, 7.85)], [(30, 16.85)]]
    assert [r.window_start.minute for r in held_windows(spark, checkpoint, 0).collect()] == [0]
    # What it no longer holds has been shown.
    assert [r.window_start.minute for r in table.latest(spark).collect()] == [0]
    assert state_operators(spark, checkpoint).first().numPartitions == 2


def test_held_windows_need_an_aggregate(spark, tmp_path):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00"))
    wait(archive(spark, folder.topic, str(tmp_path / "t"), str(tmp_path / "c"), "earliest", every=UNTIL_CAUGHT_UP))
    with pytest.raises(ValueError):
        held_windows(spark, str(tmp_path / "c"))


def test_queries_without_an_optional_module(monkeypatch):
    """What the optional subpackage needs may be missing: the other queries stay."""
    import __spark_entry__ as entry

    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("obslayers.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tiktoken", None)
    assert set(entry.queries()) == set(entry.QUERIES) and set(entry.oracle_sql()) == set(entry.QUERIES)
