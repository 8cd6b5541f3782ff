"""The views against a plain Python computation, with one station sending most messages."""

import collections
import datetime
import json
import math
import random

import pytest
from helpers import OFF_SCHEMA, UNUSABLE, texts

from pyspark.sql import functions as F

from obslayers.operators.aggregates import daily_averages, hourly_rollup, station_summary, windowed_averages
from obslayers.operators.clean import archive_observations, averaged_observations, daily_observations

UTC = datetime.timezone.utc
START = datetime.datetime(2024, 1, 1, tzinfo=UTC)


def random_message(rng):
    """A message as a dictionary, or text that is none."""
    if rng.random() < 0.05:
        return rng.choice([*UNUSABLE, json.dumps(OFF_SCHEMA)])
    time = START + datetime.timedelta(seconds=rng.randrange(2 * 86400))
    fields = {
        "geo_id_insee": rng.choice(["hot"] * 6 + ["a", "b", "c", None]),
        "reference_time": rng.choice([time.strftime("%Y-%m-%dT%H:%M:%SZ")] * 9 + [None]),
        "t": rng.choice([round(rng.uniform(250, 310), 2), None, "285.4", "abc"]),
        "t_10": rng.choice([None, None, round(rng.uniform(250, 310), 2)]),
        "u": rng.choice([None, rng.randrange(100), 55.5]),
        "ff": rng.choice([None, round(rng.uniform(0, 30), 1)]),
        "rr_per": rng.choice([None, 0.2, 1]),
        "pres": rng.choice([None, 101325]),
    }
    return {name: value for name, value in fields.items() if value is not None or rng.random() < 0.5}


@pytest.fixture(scope="module")
def messages():
    rng = random.Random(42)
    return [random_message(rng) for _ in range(4000)]


@pytest.fixture(scope="module")
def frame(spark, messages):
    rows = [json.dumps(text) if isinstance(text, dict) else text for text in messages]
    return texts(spark, rows).repartition(6).cache()


def number(value, quoted=False):
    """The value as the typed decoder reads it, or with ``quoted`` as the text decoder does."""
    if isinstance(value, str):
        try:
            return float(value) if quoted else None
        except ValueError:
            return None
    return None if value is None else float(value)


def moment(fields):
    time = fields.get("reference_time")
    return time and datetime.datetime.strptime(time, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC)


def mean(values):
    present = [value for value in values if value is not None]
    return math.fsum(present) / len(present) if present else None


def less(value, by):
    return None if value is None else value - by


def times(value, by):
    return None if value is None else value * by


def grouped(messages, key):
    groups = collections.defaultdict(list)
    for fields in messages:
        if isinstance(fields, dict) and fields.get("geo_id_insee") is not None:
            place = key(fields)
            if place is not None:
                groups[fields["geo_id_insee"], place].append(fields)
    return groups


def check(df, keys, expected):
    actual = {tuple(row[name] for name in keys): row for row in df.collect()}
    assert set(actual) == set(expected)
    for key, values in expected.items():
        for name, value in values.items():
            ours = actual[key][name]
            assert (ours is None) == (value is None), (key, name)
            assert value is None or ours == pytest.approx(value, abs=1e-9), (key, name)


def in_seconds(df, name):
    return df.withColumn(name, F.unix_timestamp(name))


def test_daily(frame, messages):
    def temperature(fields):
        first = number(fields.get("t_10"), True)
        return less(first if first is not None else number(fields.get("t"), True), 273.15)

    groups = grouped(messages, lambda fields: moment(fields) and moment(fields).date())
    expected = {
        key: {
            "avg_temp": mean(temperature(f) for f in rows),
            "avg_wind": mean(times(number(f.get("ff"), True), 3.6) for f in rows),
            "avg_humidity": mean(number(f.get("u"), True) for f in rows),
        }
        for key, rows in groups.items()
    }
    for by_path in (False, True):
        daily = daily_averages(daily_observations(frame, by_path=by_path))
        check(daily, ["geo_id_insee", "date"], expected)


def test_windows(frame, messages):
    groups = grouped(messages, lambda f: moment(f) and int(moment(f).timestamp()) // 360 * 360)
    expected = {
        key: {
            "avg_temp": mean(less(number(f.get("t")), 273.15) for f in rows),
            "avg_wind": mean(times(number(f.get("ff")), 3.6) for f in rows),
            "avg_humidity": mean(number(f.get("u")) for f in rows),
        }
        for key, rows in groups.items()
    }
    windows = windowed_averages(averaged_observations(frame))
    check(in_seconds(windows, "window_start"), ["geo_id_insee", "window_start"], expected)


def test_hourly(frame, messages):
    groups = grouped(messages, lambda f: moment(f) and int(moment(f).timestamp()) // 3600 * 3600)
    expected = {}
    for key, rows in groups.items():
        degrees = [value for f in rows if (value := less(number(f.get("t")), 273.15)) is not None]
        rain = [value for f in rows if (value := number(f.get("rr_per"))) is not None]
        expected[key] = {
            "avg_temperature_c": mean(degrees),
            "min_temperature_c": min(degrees, default=None),
            "max_temperature_c": max(degrees, default=None),
            "avg_humidity": mean(number(f.get("u")) for f in rows),
            "avg_wind_speed": mean(number(f.get("ff")) for f in rows),
            "total_rain": math.fsum(rain) if rain else None,
            "avg_pressure": mean(number(f.get("pres")) for f in rows),
            "nb_observations": len(rows),
        }
    hourly = hourly_rollup(archive_observations(frame))
    check(in_seconds(hourly, "hour_bucket"), ["geo_id_insee", "hour_bucket"], expected)


def test_summary_counts_rows_without_time(frame, messages):
    groups = grouped(messages, lambda f: "all")
    expected = {
        (station,): {
            "nb_observations": len(rows),
            "avg_temperature_c": mean(less(number(f.get("t")), 273.15) for f in rows),
            "avg_humidity": mean(number(f.get("u")) for f in rows),
        }
        for (station, _), rows in groups.items()
    }
    check(station_summary(archive_observations(frame)), ["geo_id_insee"], expected)
