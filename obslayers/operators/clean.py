"""From messages to clean observations: typed, renamed, in the wanted units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslayers.functions.messages import (
    computed_once,
    decode,
    extract,
    extract_paths,
    json_column,
    to_double,
)
from obslayers.functions.times import in_zone, parse_time
from obslayers.functions.units import best_celsius, celsius, kmh
from obslayers.schemas import (
    DAILY_FIELDS,
    EVENT_TIME,
    OBSERVATION,
    SPEED_FIELDS,
    STATION,
    TIME_PATTERN,
    only,
)

# Clean name of each message field that is kept besides station, time and position.
MEASURES = {
    "t": "temperature_c",
    "u": "humidity",
    "ff": "wind_speed",
    "dd": "wind_direction",
    "rr_per": "rain",
    "pres": "pressure",
}


# Message fields behind the aggregates over the clean table.
SUMMARY_FIELDS = [STATION, "t", "u", "ff"]
WINDOW_FIELDS = [STATION, EVENT_TIME, "t", "u", "ff"]
HOURLY_FIELDS = [*WINDOW_FIELDS, "rr_per", "pres"]


def with_station(df: DataFrame) -> DataFrame:
    """Rows that name their station; unusable messages decode to nulls and go here too."""
    return df.filter(F.col(STATION).isNotNull())


def with_station_and_time(df: DataFrame) -> DataFrame:
    return df.filter(F.col(STATION).isNotNull() & F.col(EVENT_TIME).isNotNull())


def clean_decoded(
    decoded: DataFrame, wind_in_kmh: bool = True, position: bool = False, zone: str | None = None
) -> dict[str, Column]:
    """The clean columns of decoded messages, by name, from the fields that are there."""
    convert = {"t": celsius, "ff": kmh} if wind_in_kmh else {"t": celsius}
    columns = {STATION: F.col(STATION)}
    if position:
        columns |= {name: F.col(name) for name in ("lat", "lon") if name in decoded.columns}
    if EVENT_TIME in decoded.columns:
        columns[EVENT_TIME] = in_zone(F.col(EVENT_TIME), zone)
    for name, clean in MEASURES.items():
        if name in decoded.columns:
            columns[clean] = convert.get(name, lambda value: value)(F.col(name))
    return columns


def clean_messages(
    df: DataFrame,
    column: str = "json",
    schema: StructType = OBSERVATION,
    pattern: str | None = TIME_PATTERN,
    wind_in_kmh: bool = True,
    position: bool = False,
    station_required: bool = True,
    strict: bool = False,
    zone: str | None = None,
) -> DataFrame:
    """Clean observations from messages, with the fields that ``schema`` declares.

    A schema without the time gives rows without one, and no time is parsed.
    ``pattern=None`` reads times by the ISO default instead of the offset pattern.
    ``zone`` shifts times to that zone's wall clock.
    """
    decoded = decode(df, schema, column)
    if EVENT_TIME in decoded.columns:
        decoded = computed_once(decoded, EVENT_TIME, parse_time(F.col(EVENT_TIME), pattern, strict))
    cleaned = decoded.select(*[value.alias(name) for name, value in clean_decoded(decoded, wind_in_kmh, position, zone).items()])
    return with_station(cleaned) if station_required else cleaned


def speed_observations(
    df: DataFrame,
    column: str = "json",
    fields: Sequence[str] | None = None,
    strict: bool = False,
    zone: str | None = None,
) -> DataFrame:
    """Observations for the live view: °C, km/h, station required.

    ``fields`` limits decoding to the message fields a query needs.
    """
    schema = OBSERVATION if fields is None else only(OBSERVATION, fields)
    return clean_messages(df, column, schema, strict=strict, zone=zone)


def averaged_observations(df: DataFrame, column: str = "json", strict: bool = False) -> DataFrame:
    """Speed observations with only the three averaged measures decoded."""
    return speed_observations(df, column, SPEED_FIELDS, strict)


def archive_observations(
    df: DataFrame,
    column: str = "json",
    schema: StructType = OBSERVATION,
    station_required: bool = True,
    strict: bool = False,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Observations as the clean table keeps them: with position, wind in m/s, ISO times.

    ``fields`` limits decoding to the message fields a query needs.
    """
    if fields is not None:
        schema = only(schema, fields)
    return clean_messages(
        df,
        column,
        schema,
        pattern=None,
        wind_in_kmh=False,
        position=True,
        station_required=station_required,
        strict=strict,
    )


def daily_observations(
    df: DataFrame,
    column: str | None = None,
    by_path: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Observations for the daily view, from raw messages.

    The temperature is ``t_10`` where present, else ``t``; quoted numbers count.
    A number field holding other text gives null, or fails the query when
    ``strict``. ``by_path`` extracts field by field, parsing the message each time.
    """
    take = extract_paths if by_path else extract
    fields = take(df, DAILY_FIELDS, column or json_column(df))
    fields = computed_once(fields, EVENT_TIME, parse_time(F.col(EVENT_TIME), TIME_PATTERN, strict))
    t_10, t, u, ff = (to_double(F.col(name), strict) for name in ("t_10", "t", "u", "ff"))
    return with_station_and_time(
        fields.select(
            F.col(STATION),
            F.col(EVENT_TIME),
            best_celsius(t_10, t).alias("temperature_c"),
            u.alias("humidity"),
            kmh(ff).alias("wind_speed"),
        )
    )
