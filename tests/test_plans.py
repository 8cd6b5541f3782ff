"""The physical plans: what is read, how often messages are parsed, what is shuffled."""

import re

import pytest
from helpers import message, texts

from pyspark.sql import functions as F

from obslayers.operators.aggregates import daily_averages, hourly_rollup, station_summary, windowed_averages
from obslayers.operators.clean import (
    HOURLY_FIELDS,
    SUMMARY_FIELDS,
    WINDOW_FIELDS,
    archive_observations,
    averaged_observations,
    daily_observations,
)
from obslayers.operators.inspect import first_days
from obslayers.operators.report import report_lines
from obslayers.plans.hourly import clean_days
from obslayers.sources.tables import append_table, read_table
from obslayers.sources.topic import Topic, publish, read_topic
from obslayers.functions.messages import message_text
from obslayers.streaming.keyed import KeyedTable


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    append_table(texts(spark, [message(), message(t_10=280)]), path)
    return path


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    topic = Topic(folder=str(tmp_path_factory.mktemp("plans") / "topic"))
    publish(texts(spark, [message()]), topic)
    return topic


@pytest.fixture(scope="module")
def clean(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "clean")
    append_table(archive_observations(read_table(spark, raw)), path)
    return path


def test_live_view_parses_once_and_shuffles_once(spark, topic):
    text = plan(windowed_averages(averaged_observations(message_text(read_topic(spark, topic)))))
    assert count(r"from_json", text) == 1
    assert count(r"gettimestamp|try_to_timestamp\(", text) <= 2 and count(r"Generate explode", text) == 1
    assert count(r"Exchange hashpartitioning", text) == count(r"Exchange", text) == 1
    assert count(r"HashAggregate", text) == 2 and "partial_avg" in text
    assert "ReadSchema: struct<value:binary>" in text
    assert "SortAggregate" not in text and "Python" not in text
    # The wind direction, rain and pressure fields are not even decoded.
    assert "rr_per" not in text


def test_daily_view_parses_once_and_shuffles_once(spark, raw):
    text = plan(daily_averages(daily_observations(read_table(spark, raw))))
    assert count(r"json_tuple", text) == 1 and "get_json_object" not in text
    assert count(r"Exchange", text) == 1 and count(r"HashAggregate", text) == 2
    assert "ReadSchema: struct<json:string>" in text


def test_hourly_reads_needed_columns_and_pushes_filters(spark, clean):
    text = plan(hourly_rollup(read_table(spark, clean)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "lat" not in schema and "wind_direction" not in schema
    assert "IsNotNull(geo_id_insee)" in text and "IsNotNull(reference_time)" in text
    assert count(r"Exchange", text) == 1 and "SortAggregate" not in text


def test_days_of_the_hourly_table_prune_the_clean_table(spark, clean, tmp_path):
    table = str(tmp_path / "by_day")
    rows = read_table(spark, clean).withColumn("reference_date", F.to_date("reference_time"))
    append_table(rows, table, ["reference_date"])
    text = plan(hourly_rollup(clean_days(spark, table, "2024-01-01", "2024-01-02")))
    assert re.search(r"PartitionFilters: \[[^\]]*reference_date#\d+ >= 2024-01-01", text)
    assert re.search(r"PartitionFilters: \[[^\]]*reference_date#\d+ <= 2024-01-02", text)


def test_summary_reads_three_columns(spark, clean):
    text = plan(station_summary(read_table(spark, clean)))
    assert "ReadSchema: struct<geo_id_insee:string,temperature_c:double,humidity:double>" in text
    assert count(r"Exchange", text) == 1


def test_ordered_preview_keeps_the_first_rows_per_task(spark, raw):
    text = plan(first_days(daily_averages(daily_observations(read_table(spark, raw)))))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_report_has_no_shuffle(spark, topic):
    text = plan(report_lines(read_topic(spark, topic)))
    assert "Exchange" not in text and count(r"from_json", text) == 1


def test_keyed_table_reads_with_hash_aggregates(spark, clean, tmp_path):
    table = KeyedTable(str(tmp_path / "keyed"), ("geo_id_insee", "hour_bucket"), "hour_bucket")
    for epoch in range(2):
        table.upsert(hourly_rollup(read_table(spark, clean)), 1, epoch)
    text = plan(table.latest(spark))
    assert count(r"Exchange", text) == 1 and "SortAggregate" not in text and count(r"HashAggregate", text) == 2
    table.compact(spark)
    pruned = table.latest(spark, since="2024-01-01", until="2024-01-01")
    # Of the base only the folder of that day is listed.
    days = {part for file in pruned.inputFiles() for part in file.split("/") if part.startswith("day=")}
    assert days == {"day=2024-01-01"}
    bounded = plan(pruned)
    # The base is not aggregated, and a small log reaches it without a shuffle of the base.
    assert "BroadcastHashJoin" in bounded and "LeftAnti" in bounded and count(r"max_by", bounded) == 16
    assert re.search(r"PushedFilters: \[[^\]]*hour_bucket", bounded)


@pytest.mark.parametrize(
    "fields, view, unused",
    [
        (SUMMARY_FIELDS, station_summary, ("rr_per", "timestamp(", "lat")),
        (HOURLY_FIELDS, hourly_rollup, ("lat", "dd#")),
        (WINDOW_FIELDS, windowed_averages, ("rr_per", "pres", "lat")),
    ],
)
def test_clean_aggregates_decode_only_what_they_read(spark, topic, fields, view, unused):
    text = plan(view(archive_observations(message_text(read_topic(spark, topic)), fields=fields)))
    assert count(r"from_json", text) == 1
    for name in unused:
        assert name not in text
