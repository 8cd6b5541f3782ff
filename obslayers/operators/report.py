"""One readable line per message of a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from obslayers.functions.units import celsius, or_text, two_decimals
from obslayers.schemas import EVENT_TIME, STATION

# Fixed values of the line.
LINE = "%s geo=%s T=%s U=%s FF=%s RR=%s"
NOT_A_NUMBER = "N/A"
ABSENT = "None"

# Only the temperature is computed with; the rest is shown as the message has it.
REPORT_FIELDS = StructType(
    [
        StructField(EVENT_TIME, StringType()),
        StructField(STATION, StringType()),
        StructField("t", DoubleType()),
        StructField("u", StringType()),
        StructField("ff", StringType()),
        StructField("rr_per", StringType()),
    ]
)


def _shown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(ABSENT))


def report_lines(records: DataFrame) -> DataFrame:
    """``partition``, ``offset`` and the line of each topic record that has a value.

    A temperature that is not a number shows as N/A, any absent field as None.
    Replay order is by partition and offset, which the caller sorts by where it
    matters; the lines themselves need no shuffle.
    """
    message = F.from_json(F.col("value").cast("string"), REPORT_FIELDS)
    rows = records.filter(F.col("value").isNotNull()).select("partition", "offset", F.inline(F.array(message)))
    degrees = celsius(F.col("t"))
    temperature = or_text(F.col("t"), F.concat(two_decimals(degrees), F.lit("°C")), NOT_A_NUMBER)
    line = F.format_string(
        LINE, _shown(EVENT_TIME), _shown(STATION), temperature, _shown("u"), _shown("ff"), _shown("rr_per")
    )
    return rows.select("partition", "offset", line.alias("line"))
