"""Decoding and encoding of JSON messages.

A message is decoded once per row. Catalyst pushes a filter on a decoded field
below the projection that decodes it, and then the parser runs again for every
such filter; a generator is a barrier for that push-down. So the struct form uses
``inline`` and the text form ``json_tuple``, both of which parse each message a
single time whatever is filtered afterwards. ``computed_once`` does the same for any
other column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def message_text(df: DataFrame, name: str = "json") -> DataFrame:
    """Topic record bytes as text in one column."""
    return df.select(F.col("value").cast("string").alias(name))


def present(df: DataFrame, column: str = "json") -> DataFrame:
    """Rows that carry a message."""
    return df.filter(F.col(column).isNotNull())


def json_column(df: DataFrame) -> str:
    """Name of the column that holds the message: ``json``, else ``value``."""
    for name in ("json", "value"):
        if name in df.columns:
            return name
    raise ValueError("no message column: expected 'json' or 'value'")


def decode(df: DataFrame, schema: StructType, column: str = "json") -> DataFrame:
    """One column per field of ``schema``.

    A message that is not a JSON object gives a row of nulls, and a field of
    another type than declared gives null in that field.
    """
    return df.select(F.inline(F.array(F.from_json(F.col(column), schema))))


def extract(df: DataFrame, fields: Sequence[str], column: str = "json") -> DataFrame:
    """The top-level ``fields`` of each message as text, from one parse.

    Same values as ``extract_paths``, save that the last of two equal keys in one
    message wins instead of the first.
    """
    return df.select(F.json_tuple(F.col(column), *fields).alias(*fields))


def extract_paths(df: DataFrame, fields: Sequence[str], column: str = "json") -> DataFrame:
    """The same ``fields`` by JSON path, which parses the message per field."""
    return df.select(*[F.get_json_object(F.col(column), f"$.{name}").alias(name) for name in fields])


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Column ``name`` as ``value``, evaluated a single time per row.

    For a costly value that later steps filter on: as a plain projection it would be
    evaluated in the pushed-down filter and again for its result.
    """
    others = [column for column in df.columns if column != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def to_double(column: Column, strict: bool = False) -> Column:
    """Text as a double; text that is no number gives null, or fails when strict."""
    return column.cast("double") if strict else column.try_cast("double")


def encode(df: DataFrame, columns: Sequence[str] | None = None, name: str = "json") -> DataFrame:
    """Each row as one JSON object; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(name))
