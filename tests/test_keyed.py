"""The keyed table against a plain dictionary, and its compaction."""

import datetime
import os
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import message, rows, texts

from pyspark.sql import functions as F

from obslayers import storage
from obslayers.plans.daily import add_new_parts, daily_of_parts, daily_table, daily_view, run_daily
from obslayers.plans.hourly import run_hourly, run_hourly_days, run_summary
from obslayers.operators.clean import archive_observations
from obslayers.sources.tables import append_table, read_table, replace_table
from obslayers.streaming.keyed import CassandraTable, KeyedTable, serve
from obslayers.streaming.parts import DailyParts
from obslayers.streaming.runs import drop_checkpoint

SCHEMA = "station string, date date, reading double, note string"


def table_at(path) -> KeyedTable:
    return KeyedTable(str(path), ("station", "date"), "date")


def frame(spark, entries):
    return spark.createDataFrame([(s, d, v, n) for (s, d), (v, n) in entries.items()], SCHEMA)


def day(number: int) -> datetime.date:
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=number)


def content(table, spark, **bounds):
    return {(r.station, r.date): (r.reading, r.note) for r in table.latest(spark, **bounds).collect()}


def random_entries(rng, size=12):
    return {(f"s{rng.randrange(4)}", day(rng.randrange(5))): (rng.random(), None) for _ in range(size)}


def test_newest_position_wins(spark, tmp_path):
    rng, table, expected = random.Random(7), table_at(tmp_path / "t"), {}
    for _ in range(3):
        generation = table.open_generation(spark)
        for epoch in range(3):
            entries = random_entries(rng)
            table.upsert(frame(spark, entries), generation, epoch)
            expected |= entries
    assert content(table, spark) == expected


def test_epoch_ten_is_newer_than_epoch_nine(spark, tmp_path):
    table = table_at(tmp_path / "t")
    for epoch in (9, 10):
        table.upsert(frame(spark, {("s", day(0)): (float(epoch), "n")}), 1, epoch)
    assert content(table, spark) == {("s", day(0)): (10.0, "n")}


def test_a_newer_null_replaces_a_value(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.upsert(frame(spark, {("s", day(0)): (1.0, "x")}), 1, 0)
    table.upsert(frame(spark, {("s", day(0)): (None, None)}), 1, 1)
    assert content(table, spark) == {("s", day(0)): (None, None)}


def test_repeating_an_epoch_changes_nothing(spark, tmp_path):
    table, entries = table_at(tmp_path / "t"), {("s", day(0)): (1.0, "x"), ("r", day(1)): (2.0, None)}
    for _ in range(2):
        table.upsert(frame(spark, entries), 1, 0)
    assert content(table, spark) == entries


def test_empty_epoch(spark, tmp_path):
    table = table_at(tmp_path / "t")
    with pytest.raises(ValueError):
        table.latest(spark)
    table.upsert(frame(spark, {("s", day(0)): (1.0, "x")}).limit(0), 1, 0)
    assert content(table, spark) == {}


def test_epoch_being_written_is_left_out(spark, tmp_path):
    table = table_at(tmp_path / "t")
    unfinished = Path(table.path) / "log/generation=1/epoch=1/_temporary"
    unfinished.mkdir(parents=True)
    with pytest.raises(ValueError):
        table.latest(spark)
    table.upsert(frame(spark, {("s", day(0)): (1.0, "x")}), 1, 0)
    assert content(table, spark) == {("s", day(0)): (1.0, "x")}


def test_half_written_epoch_is_left_out(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.upsert(frame(spark, {("s", day(0)): (1.0, "x")}), 1, 0)
    table.upsert(frame(spark, {("s", day(0)): (2.0, "y"), ("r", day(1)): (3.0, "z")}), 1, 1)
    os.remove(f"{table.path}/log/generation=1/epoch=1/_SUCCESS")
    assert content(table, spark) == {("s", day(0)): (1.0, "x")}


def test_parts_without_a_usable_message(spark, tmp_path):
    raw, parts, checkpoint = (str(tmp_path / name) for name in ("raw", "parts", "checkpoint"))
    for texts_ in (["hello"], ["nothing", message(drop=["reference_time"])]):
        append_table(texts(spark, texts_).coalesce(1), raw)
        add_new_parts(spark, raw, parts, checkpoint).awaitTermination()
    assert daily_of_parts(spark, parts).count() == 0
    assert DailyParts(parts).fold(spark) == 1
    append_table(texts(spark, [message()]).coalesce(1), raw)
    add_new_parts(spark, raw, parts, checkpoint).awaitTermination()
    assert daily_of_parts(spark, parts).count() == 1
    os.remove(f"{parts}/generation=1/epoch=2/_SUCCESS")
    assert daily_of_parts(spark, parts).count() == 0


def test_hourly_rebuild_drops_days_that_are_gone(spark, tmp_path):
    clean, table = str(tmp_path / "clean"), str(tmp_path / "hourly")
    messages = [message(reference_time=f"2024-01-0{d}T01:30:00Z") for d in (1, 2, 3)]
    archived = archive_observations(texts(spark, messages)).withColumn("reference_date", F.to_date("reference_time"))
    append_table(archived, clean, ["reference_date"])
    run_hourly_days(spark, clean, table, "2024-01-01", "2024-01-03")
    storage.delete(spark, f"{clean}/reference_date=2024-01-02")
    storage.delete(spark, f"{clean}/reference_date=2024-01-03")
    run_hourly_days(spark, clean, table, "2024-01-01", "2024-01-02")
    assert [str(r.day) for r in read_table(spark, table).orderBy("day").collect()] == ["2024-01-01", "2024-01-03"]


def test_compaction_keeps_the_content(spark, tmp_path):
    rng, table, expected = random.Random(11), table_at(tmp_path / "t"), {}
    assert table.compact(spark) == 0
    for round_ in range(3):
        generation = table.open_generation(spark)
        for epoch in range(3):
            entries = random_entries(rng, 5)
            table.upsert(frame(spark, entries), generation, epoch)
            expected |= entries
        assert table.compact(spark) == (2 if round_ == 0 else 3)
        assert content(table, spark) == expected
    table.drop_replaced(spark)
    assert content(table, spark) == expected
    assert len(list(Path(table.path).glob("log/*/epoch=*"))) == 1
    # One folder per day is left, and no two runs hold the same day.
    days = [path.name for path in Path(table.path).glob("base/run=*/day=*")]
    assert len(days) == len(set(days))


def test_compaction_rewrites_only_the_days_it_touches(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.upsert(frame(spark, {("s", day(d)): (float(d), None) for d in range(3)}), 1, 0)
    table.upsert(frame(spark, {("s", day(1)): (10.0, None)}), 1, 1)
    table.compact(spark)
    table.upsert(frame(spark, {("s", day(2)): (20.0, None)}), 1, 2)
    table.compact(spark)
    second = {path.name for path in Path(table.path).glob("base/run=2/day=*")}
    assert second == {"day=2024-01-02"}
    assert content(table, spark) == {("s", day(d)): (10.0 * d, None) for d in range(3)}


def test_broken_off_compaction_is_harmless(spark, tmp_path):
    table = table_at(tmp_path / "t")
    for epoch in range(3):
        table.upsert(frame(spark, {("s", day(0)): (float(epoch), None)}), 1, epoch)
    table.compact(spark)
    # As if the run had ended before it noted what it folded.
    storage.delete(spark, f"{table.path}/base/run=1/_folded")
    assert content(table, spark) == {("s", day(0)): (2.0, None)}
    assert table.compact(spark) == 2
    table.upsert(frame(spark, {("s", day(0)): (3.0, None)}), 1, 3)
    assert content(table, spark) == {("s", day(0)): (3.0, None)}
    table.upsert(frame(spark, {("s", day(0)): (2.0, None)}), 1, 3)
    table.drop_replaced(spark)
    assert content(table, spark) == {("s", day(0)): (2.0, None)}


def test_day_bounds(spark, tmp_path):
    table, entries = table_at(tmp_path / "t"), {("s", day(d)): (float(d), None) for d in range(6)}
    table.upsert(frame(spark, entries), 1, 0)
    table.upsert(frame(spark, {("s", day(3)): (30.0, None)}), 1, 1)
    entries[("s", day(3))] = (30.0, None)
    expected = {key: value for key, value in entries.items() if day(1) <= key[1] <= day(3)}
    bounds = {"since": "2024-01-02", "until": "2024-01-04"}
    assert content(table, spark, **bounds) == expected
    table.compact(spark)
    assert content(table, spark, **bounds) == expected


def test_one_hot_key_per_epoch(spark, tmp_path):
    table = table_at(tmp_path / "t")
    for epoch in range(12):
        entries = {("hot", day(0)): (float(epoch), None), (f"s{epoch}", day(0)): (1.0, None)}
        table.upsert(frame(spark, entries), 1, epoch)
    assert content(table, spark)[("hot", day(0))] == (11.0, None)
    assert table.latest(spark).count() == 13


def test_generation_follows_the_checkpoint(spark, tmp_path):
    table = table_at(tmp_path / "t")
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    assert [table.open_generation(spark, c) for c in (first, first, second, first, None)] == [1, 1, 2, 1, 3]
    storage.delete(spark, first)
    assert table.open_generation(spark, first) == 4


def test_serving_views(spark, tmp_path):
    table = table_at(tmp_path / "t")
    table.upsert(frame(spark, {("s", day(0)): (1.0, "x")}), 1, 0)
    serve(spark, {"readings": table})
    assert rows(spark.sql("SELECT * FROM readings LIMIT 10")) == [("s", day(0), 1.0, "x")]


def test_serving_follows_writes_and_compactions(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), ("station", "date"), "date", keep_seconds=0)
    table.upsert(frame(spark, {("s", day(0)): (1.0, "x")}), 1, 0)
    serving = serve(spark, {"readings": table})
    query = "SELECT reading FROM readings"
    for epoch in range(1, 4):
        table.upsert(frame(spark, {("s", day(0)): (1.0 + epoch, "x")}), 1, epoch)
        assert rows(serving.sql(query)) == [(1.0 + epoch,)]
    table.compact(spark)
    table.drop_replaced(spark)
    # The files of the view are gone by now, those of a new one are not.
    assert rows(serving.sql(query)) == [(4.0,)]
    table.upsert(frame(spark, {("s", day(0)): (9.0, "x")}), 1, 4)
    assert rows(spark.sql(query)) == [(4.0,)]
    serving.refresh()
    assert rows(spark.sql(query)) == [(9.0,)]


def test_cassandra_needs_its_connector(spark, tmp_path):
    target = CassandraTable("observations", "speed", ("station",))
    assert target.open_generation(spark) == 0
    with pytest.raises(Exception, match="cassandra"):
        target.upsert(frame(spark, {("s", day(0)): (1.0, "x")}))
    with pytest.raises(Exception, match="cassandra"):
        target.latest(spark)


def test_daily_job(spark, tmp_path, capsys):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "daily")
    target = daily_table(str(tmp_path / "keyed"))
    append_table(texts(spark, [message(), message(t=287.4), "hello", message(t_10=300.0, geo_id_insee="b")]), raw)
    daily = run_daily(spark, raw, out, target, show=True)
    assert "rows: 2" in capsys.readouterr().out
    assert [round(v, 6) for _, v in rows(daily.select("geo_id_insee", "avg_temp"), "geo_id_insee")] == [13.25, 26.85]
    run_daily(spark, raw, out, target, by_path=True)
    assert read_table(spark, out).count() == 4
    assert target.latest(spark).count() == 2


def test_incremental_daily_equals_the_whole(spark, tmp_path):
    raw, parts, checkpoint = (str(tmp_path / name) for name in ("raw", "parts", "checkpoint"))
    target, rng, folded = daily_table(str(tmp_path / "keyed")), random.Random(3), []
    with pytest.raises(ValueError):
        daily_of_parts(spark, parts)
    for _ in range(3):
        messages = [
            message(
                # One station sends most of the messages, and some carry nothing to average.
                geo_id_insee=rng.choice(["hot", "hot", "hot", "a", "b"]),
                reference_time=f"2024-01-0{rng.randint(1, 3)}T{rng.randint(0, 23):02d}:00:00Z",
                t=rng.choice([None, 280 + rng.random()]),
                t_10=rng.choice([None, 290 + rng.random()]),
                u=None,
                ff=rng.choice([None, "3.5", 1.25]),
            )
            for _ in range(40)
        ]
        append_table(texts(spark, [*messages, "hello", message(drop=["reference_time"])]).coalesce(2), raw)
        add_new_parts(spark, raw, parts, checkpoint, target, per_trigger=1).awaitTermination()
        results = [
            rows(
                df.select("geo_id_insee", "date", F.round("avg_temp", 9), F.round("avg_wind", 9), "avg_humidity"),
                "geo_id_insee",
                "date",
            )
            for df in (daily_view(read_table(spark, raw)), target.latest(spark), daily_of_parts(spark, parts))
        ]
        assert results[0] == results[1] == results[2]
        folded.append(DailyParts(parts).fold(spark))
    # Two files, so two epochs, each time; the newest epoch stays.
    assert folded == [1, 2, 2] and DailyParts(parts).fold(spark) == 0
    epochs = [path.name for path in Path(parts).glob("generation=1/*=*")]
    assert sorted(epochs) == ["epoch=5", "folded=4"]
    # Nothing new, and then everything again under a new checkpoint.
    add_new_parts(spark, raw, parts, checkpoint, target).awaitTermination()
    drop_checkpoint(spark, checkpoint)
    add_new_parts(spark, raw, parts, checkpoint, target).awaitTermination()
    for df in (daily_of_parts(spark, parts), target.latest(spark)):
        columns = ("geo_id_insee", "date", F.round("avg_temp", 9), F.round("avg_wind", 9), "avg_humidity")
        assert rows(df.select(*columns), "geo_id_insee", "date") == results[0]


def test_broken_off_fold_does_not_count(spark, tmp_path):
    raw, parts, checkpoint = (str(tmp_path / name) for name in ("raw", "parts", "checkpoint"))
    for t in (280, 282, 287):
        # The other name a message column may have.
        append_table(texts(spark, [message(t=t)]).coalesce(1).withColumnRenamed("json", "value"), raw)
        add_new_parts(spark, raw, parts, checkpoint).awaitTermination()
    before = rows(daily_of_parts(spark, parts))
    assert DailyParts(parts).fold(spark) == 2
    assert rows(daily_of_parts(spark, parts)) == before
    storage.delete(spark, f"{parts}/generation=1/folded=1/_done")
    assert rows(daily_of_parts(spark, parts)) == before
    assert DailyParts(parts).fold(spark) == 2
    assert DailyParts(parts).fold(spark) == 0
    assert rows(daily_of_parts(spark, parts)) == before


def test_hourly_rebuild_of_some_days(spark, tmp_path):
    clean, whole, table = (str(tmp_path / name) for name in ("clean", "whole", "hourly"))
    hours = [(d, h) for d in (1, 2, 3) for h in (0, 23)]
    messages = [message(reference_time=f"2024-01-0{d}T{h:02d}:30:00Z", t=270 + d + h) for d, h in hours]
    archived = archive_observations(texts(spark, messages)).withColumn("reference_date", F.to_date("reference_time"))
    append_table(archived, clean, ["reference_date"])
    run_hourly(spark, clean, whole)
    run_hourly_days(spark, clean, table, "2024-01-01", "2024-01-03")
    run_hourly_days(spark, clean, table, "2024-01-02", "2024-01-02")
    rebuilt = read_table(spark, table).drop("day")
    assert rows(rebuilt, "hour_bucket") == rows(read_table(spark, whole).select(*rebuilt.columns), "hour_bucket")


def test_hourly_and_summary_jobs(spark, tmp_path, capsys):
    clean, out = str(tmp_path / "clean"), str(tmp_path / "hourly")
    append_table(archive_observations(texts(spark, [message(), message(reference_time=None)])), clean)
    for _ in range(2):
        run_hourly(spark, clean, out)
    assert read_table(spark, out).count() == 1
    assert run_summary(spark, clean, show=True).first().nb_observations == 2
    assert "geo_id_insee" in capsys.readouterr().out
    replace_table(read_table(spark, clean).limit(1), out)
    assert read_table(spark, out).count() == 1


def test_shared_folder(spark, tmp_path):
    before = spark.conf.get(storage.SHARED_DIR_SETTING, None)
    if before is not None:
        assert storage.new_folder(spark, "x").startswith(before.rstrip("/") + "/x-")
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="spark://host:7077")
    )
    with pytest.raises(ValueError, match=storage.SHARED_DIR_SETTING):
        storage.shared_dir(cluster)
    cluster.sparkContext.master = "local[2]"
    assert Path(storage.shared_dir(cluster)).is_dir()
    cluster.conf.get = lambda key, default: "hdfs://host/shared/"
    assert storage.new_folder(cluster, "x").startswith("hdfs://host/shared/x-")
    df = storage.materialize(spark.range(3), "numbers")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2]
    assert not storage.is_folder(spark, str(tmp_path / "none"))
    assert storage.is_folder(spark, str(tmp_path))
