"""How messages decode: types, missing parts, times and units."""

import datetime
import math

import pytest
from helpers import NORMAL, OFF_SCHEMA, UNUSABLE, message, rows, texts

import json

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obslayers.functions.messages import encode, extract, extract_paths, json_column, message_text, present
from obslayers.operators.aggregates import daily_averages, hourly_rollup, row_count, running_summary, station_summary
from obslayers.operators.clean import archive_observations, clean_messages, daily_observations, speed_observations
from obslayers.operators.inspect import first_days, preview, schema_text, show_preview
from obslayers.operators.report import report_lines
from obslayers.functions.times import parse_time
from obslayers.schemas import DAILY_FIELDS, OBSERVATION, OBSERVATION_WHOLE, SPEED_FIELDS, TIME_PATTERN, only
from obslayers.session import settings
from obslayers.sources.topic import Topic, topic_records

UTC = datetime.timezone.utc


def speed(spark, *messages, **options):
    return speed_observations(texts(spark, messages), **options)


def daily(spark, *messages, **options):
    return daily_observations(texts(spark, messages), **options)


def seconds(df):
    """Event times as seconds since the epoch, independent of the Python zone."""
    return [row[0] for row in df.select(F.unix_timestamp("reference_time")).collect()]


MIDNIGHT = int(datetime.datetime(2024, 1, 1, tzinfo=UTC).timestamp())


def test_normal_message(spark):
    df = speed(spark, message())
    assert df.dtypes == [
        ("geo_id_insee", "string"),
        ("reference_time", "timestamp"),
        ("temperature_c", "double"),
        ("humidity", "double"),
        ("wind_speed", "double"),
        ("wind_direction", "double"),
        ("rain", "double"),
        ("pressure", "double"),
    ]
    (row,) = df.collect()
    assert row.geo_id_insee == "29075001" and seconds(df) == [MIDNIGHT]
    assert row.temperature_c == pytest.approx(12.25) and row.wind_speed == pytest.approx(9.0)
    assert (row.humidity, row.wind_direction, row.rain, row.pressure) == (78.0, 240.0, 0.2, 101325.0)


def test_archive_keeps_position_and_metres_per_second(spark):
    df = archive_observations(texts(spark, [message(lat=48.4, lon=-4.4)]))
    assert df.columns[:4] == ["geo_id_insee", "lat", "lon", "reference_time"]
    (row,) = df.collect()
    assert (row.lat, row.lon, row.wind_speed) == (48.4, -4.4, 2.5)


def test_temperature_source_differs_by_view(spark):
    text = message(t_10=284.0)
    assert speed(spark, text).first().temperature_c == pytest.approx(285.4 - 273.15)
    assert daily(spark, text).first().temperature_c == pytest.approx(284.0 - 273.15)
    assert daily(spark, message(t_10=None)).first().temperature_c == pytest.approx(285.4 - 273.15)


def test_quoted_number(spark):
    text = message(t="285.4")
    assert speed(spark, text).first().temperature_c is None
    assert daily(spark, text).first().temperature_c == pytest.approx(285.4 - 273.15)


def test_text_in_a_number_field(spark):
    text = message(t="abc")
    assert speed(spark, text).first().temperature_c is None
    assert daily(spark, text).first().temperature_c is None
    assert daily(spark, text, by_path=True).first().temperature_c is None
    with pytest.raises(PySparkException):
        daily(spark, text, strict=True).collect()


def test_whole_number_schema_loses_fractions(spark):
    text = '{"geo_id_insee":"a","reference_time":"2024-01-01T00:00:00Z","u":78.0,"dd":12}'
    assert archive_observations(texts(spark, [text])).first().humidity == 78.0
    row = archive_observations(texts(spark, [text]), schema=OBSERVATION_WHOLE).first()
    assert row.humidity is None and row.wind_direction == 12


@pytest.mark.parametrize(
    ("time", "by_pattern", "by_default"),
    [
        ("2024-01-01T00:00:00Z", 0, 0),
        ("2024-01-01T00:00:00+01", -3600, -3600),
        ("2024-01-01T00:00:00+0100", -3600, None),
        ("2024-01-01T00:00:00+01:00", None, -3600),
        ("2024-01-01T00:00:00.5Z", None, 0),
        ("garbage", None, None),
        (None, None, None),
    ],
)
def test_time_patterns(spark, time, by_pattern, by_default):
    text = message(reference_time=time)
    expected = [None if part is None else MIDNIGHT + part for part in (by_pattern, by_default)]
    assert seconds(speed(spark, text)) == expected[:1]
    # The default accepts more offset forms than the two final jobs need.
    if time != "2024-01-01T00:00:00+0100":
        assert seconds(archive_observations(texts(spark, [text]))) == expected[1:]


def test_usual_times_parse_like_the_pattern(spark):
    dates = "2024-02-29 2023-02-29 2024-04-31 0000-01-01 0001-01-01 1582-10-10 9999-12-31 2024-13-01".split()
    clocks = ["00:00:00", "23:59:59", "24:00:00", "12:60:00", "12:00:60", "1:00:00", "12:00"]
    ends = ["Z", "z", "+01", "-0530", "+00", "Z\n", " Z", "Z ", "", ".5Z", "Zulu", "+01:00"]
    times = [f"{date}{t}{clock}{end}" for date in dates for t in "Tt " for clock in clocks for end in ends]
    times += ["", *[f"{year}-01-01T00:00:00Z" for year in (" 2024", "+024", "-024", "２０２４", "02024")]]
    df = spark.createDataFrame([(time,) for time in times], "time string")
    plain = F.try_to_timestamp("time", F.lit(TIME_PATTERN))
    differ = df.filter(~parse_time(F.col("time")).eqNullSafe(plain))
    assert rows(differ) == []
    assert df.filter(parse_time(F.col("time")).isNotNull()).count() > 20


@pytest.mark.parametrize("time", ["2024-01-01T00:00:00+01:00", "2024-01-01T00:00:00.5Z", "garbage"])
def test_strict_times_fail(spark, time):
    with pytest.raises(PySparkException):
        speed(spark, message(reference_time=time), strict=True).collect()
    assert speed(spark, message(reference_time=None), strict=True).count() == 1


def test_missing_time(spark):
    text = message(drop=["reference_time"])
    assert speed(spark, text).count() == 1
    assert daily(spark, text).count() == 0
    clean = archive_observations(texts(spark, [text]))
    assert hourly_rollup(clean).count() == 0
    assert station_summary(clean).first().nb_observations == 1
    assert running_summary(clean).first().nb_messages == 1


def test_unusable_messages_are_removed(spark):
    bad = [message(drop=["geo_id_insee"]), json.dumps(OFF_SCHEMA), *UNUSABLE]
    assert speed(spark, *bad).count() == 0
    assert daily(spark, *bad).count() == 0
    assert daily(spark, *bad, by_path=True).count() == 0
    assert archive_observations(texts(spark, bad)).count() == 0
    everything = archive_observations(texts(spark, bad), station_required=False)
    assert everything.count() == len(bad)


def test_not_a_number_spreads(spark):
    text = '{"geo_id_insee":"a","reference_time":"2024-01-01T00:00:00Z","t":NaN}'
    clean = archive_observations(texts(spark, [text, message(geo_id_insee="a")]))
    row = hourly_rollup(clean).first()
    assert math.isnan(row.avg_temperature_c) and math.isnan(row.max_temperature_c)
    assert row.min_temperature_c == pytest.approx(12.25)


def test_numeric_station_is_text(spark):
    assert speed(spark, message(geo_id_insee=29075001)).first().geo_id_insee == "29075001"
    assert daily(spark, message(geo_id_insee=29075001)).first().geo_id_insee == "29075001"


def test_all_null_measures_still_count(spark):
    text = '{"geo_id_insee":"a","reference_time":"2024-01-01T00:00:00Z"}'
    row = hourly_rollup(archive_observations(texts(spark, [text, text]))).first()
    assert row.nb_observations == 2
    assert (row.avg_temperature_c, row.min_temperature_c, row.total_rain, row.avg_pressure) == (None,) * 4


def test_day_follows_the_session_zone(spark):
    text = message(reference_time="2024-01-01T23:30:00Z")
    assert daily_averages(daily(spark, text)).first().date == datetime.date(2024, 1, 1)
    with settings(spark, {"spark.sql.session.timeZone": "Europe/Paris"}):
        assert daily_averages(daily(spark, text)).first().date == datetime.date(2024, 1, 2)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_local_time(spark):
    assert seconds(speed(spark, message(), zone="Europe/Paris")) == [MIDNIGHT + 3600]
    summer = message(reference_time="2024-07-01T00:00:00Z")
    offset = seconds(speed(spark, summer, zone="Europe/Paris"))[0] - seconds(speed(spark, summer))[0]
    assert offset == 7200


def test_fewer_fields_give_the_same_values(spark):
    few = speed(spark, message(), fields=SPEED_FIELDS)
    assert rows(few) == rows(speed(spark, message()).select(*few.columns))
    with pytest.raises(ValueError):
        only(OBSERVATION, ["nothing"])


def test_one_parse_equals_a_parse_per_field(spark):
    odd = [
        message(t="285.4", t_10=None),
        message(t=True, u=[1, 2], ff={"x": 1}),
        message(geo_id_insee="éé", t=-0.0, u=1e300),
        '{"geo_id_insee":"a","t":NaN}',
        '{"geo_id_insee":"a","t":1} trailing',
        "{'geo_id_insee':'a','t':4}",
        '{"a":{"geo_id_insee":"z"},"geo_id_insee":"q","t":0.1}',
        *UNUSABLE,
    ]
    df = texts(spark, odd)
    assert rows(extract(df, DAILY_FIELDS), "t", "geo_id_insee") == rows(
        extract_paths(df, DAILY_FIELDS), "t", "geo_id_insee"
    )
    twice = texts(spark, ['{"t":1,"t":2}'])
    assert (extract(twice, ["t"]).first().t, extract_paths(twice, ["t"]).first().t) == ("2", "1")


def test_message_column(spark):
    df = texts(spark, [message()])
    assert json_column(df) == "json"
    renamed = df.withColumnRenamed("json", "value")
    assert json_column(renamed) == "value"
    assert daily_observations(renamed).count() == 1
    with pytest.raises(ValueError):
        json_column(df.withColumnRenamed("json", "text"))


def test_bytes_and_empty_records(spark):
    df = spark.createDataFrame([(b"abc",), (None,)], "value binary")
    assert rows(present(message_text(df))) == [("abc",)]


def test_encode_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, None, "é")], "a int, b string, c string")
    assert encode(df).first().json == '{"a":1,"c":"é"}'
    assert encode(df, ["c"], "value").first().value == '{"c":"é"}'


def test_report_lines(spark):
    messages = [message(t=285.415), message(t="x", u=78.5), message(drop=["t", "rr_per"]), json.dumps(OFF_SCHEMA), None]
    records = topic_records(texts(spark, messages).coalesce(1), Topic(folder="unused"))
    lines = [row.line for row in report_lines(records).orderBy("offset").collect()]
    start = "2024-01-01T00:00:00Z geo=29075001 "
    value = f"{285.415 - 273.15:.2f}"
    assert lines == [
        f"{start}T={value}°C U=78 FF=2.5 RR=0.2",
        f"{start}T=N/A U=78.5 FF=2.5 RR=0.2",
        f"{start}T=N/A U=78 FF=2.5 RR=None",
        "None geo=None T=N/A U=None FF=None RR=None",
    ]


@pytest.mark.parametrize("degrees", [0.125, 0.375, 2.675, -0.001, 1234.5, -7.0])
def test_report_rounds_like_a_decimal_format(spark, degrees):
    kelvin = degrees + 273.15
    records = topic_records(texts(spark, [message(t=kelvin)]), Topic(folder="unused"))
    assert f"T={kelvin - 273.15:.2f}°C" in report_lines(records).first().line


def test_previews(spark, capsys):
    df = daily_averages(
        daily(spark, *[message(geo_id_insee=s, reference_time=f"2024-01-0{d}T00:00:00Z") for d in (2, 1) for s in "ba"])
    )
    assert [(row.date.day, row.geo_id_insee) for row in first_days(df, 3).collect()] == [(1, "a"), (1, "b"), (2, "a")]
    assert preview(df, 2).count() == 2
    assert row_count(df).first().n == 4
    show_preview(df, 1)
    assert "only showing top 1 row" in capsys.readouterr().out
    assert "avg_temp: double" in schema_text(df)


def test_clean_messages_reads_any_column(spark):
    df = spark.createDataFrame([(json.dumps(NORMAL),)], "value string")
    assert clean_messages(df, column="value").count() == 1
