"""Why a message is of no use: good and bad ones told apart where they are decoded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from obslayers.functions.messages import computed_once
from obslayers.functions.times import parse_time
from obslayers.operators.clean import clean_decoded
from obslayers.schemas import EVENT_TIME, OBSERVATION, STATION, TIME_PATTERN

# Reasons, in the order they are looked for.
NULL, BROKEN, OFF_SCHEMA, NO_STATION, NO_TIME = "null", "broken", "off schema", "no station", "no time"
REASON, MESSAGE, VERDICT = "reason", "message", "verdict"
USABLE, REJECTED = "usable", "rejected"
# Where the parser leaves a message that it could not read in full; a parsed time beside its text.
_CORRUPT, _TIME = "_corrupt", "_time"


def _reason(message: Column, schema: StructType) -> Column:
    nothing = F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields]).isNull()
    # A readable object can hold nothing but fields of the wrong type.
    unread = F.col(_CORRUPT).isNotNull() & F.json_object_keys(message).isNull()
    return (
        F.when(message.isNull(), NULL)
        .when(nothing & (unread | (F.trim(message) == "")), BROKEN)
        .when(nothing, OFF_SCHEMA)
        .when(F.col(STATION).isNull(), NO_STATION)
        .when(F.col(_TIME).isNull(), NO_TIME)
    )


def judged_messages(
    df: DataFrame,
    keep: Sequence[str] = (),
    column: str = "json",
    schema: StructType = OBSERVATION,
    pattern: str | None = TIME_PATTERN,
    wind_in_kmh: bool = True,
) -> DataFrame:
    """Every message decoded once, beside the columns to ``keep``, with a ``verdict``.

    A usable message has a station and a time and gives a clean observation; a rejected
    one gives its ``reason``, the ``message`` itself and nulls. ``null`` is no message at all,
    ``broken`` no JSON object, ``off schema`` an object without any of the fields, or
    without one of the declared type; then come a missing station, and a missing time or one
    that does not fit the pattern. A single field of a wrong type does not reject a message.
    """
    parsed = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    decoding = F.from_json(F.col(column), parsed, {"columnNameOfCorruptRecord": _CORRUPT})
    decoded = df.select(*keep, F.col(column).alias(MESSAGE), F.inline(F.array(decoding)))
    decoded = computed_once(decoded, _TIME, parse_time(F.col(EVENT_TIME), pattern))
    judged = computed_once(decoded, REASON, _reason(F.col(MESSAGE), schema))
    good = F.col(REASON).isNull()
    judged = judged.withColumn(EVENT_TIME, F.col(_TIME))
    clean = clean_decoded(judged, wind_in_kmh, position=True)
    shown = [F.when(good, value).alias(name) for name, value in clean.items()]
    return judged.select(
        *keep,
        REASON,
        F.when(~good, F.col(MESSAGE)).alias(MESSAGE),
        *shown,
        F.when(good, USABLE).otherwise(REJECTED).alias(VERDICT),
    )
