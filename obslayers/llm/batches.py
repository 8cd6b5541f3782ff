"""Arrow batches of texts through plain Python, with bounded memory and any id type."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

# Characters of text worked on at a time. One longer text is a block of its own.
BLOCK_CHARS = 1 << 21

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "float": pa.float32(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<float>": pa.list_(pa.float32()),
    "array<double>": pa.list_(pa.float64()),
}

# Rows that one text gives; the worker sees a block of texts at a time.
Rows = Iterable[Sequence[tuple]]
Work = Callable[[list[str]], Rows]


def blocks(texts: Sequence[str], size: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive slices of about ``size`` characters, one text at least."""
    begin = chars = 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= size:
            yield begin, i + 1
            begin, chars = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def map_texts(docs: DataFrame, carried: list[str], text: str, fields: str, make: Callable[[], Work]) -> DataFrame:
    """For each row its ``carried`` columns beside the rows made from its text.

    ``make`` runs once a task and returns the worker; a null text counts as empty.
    Only the named columns reach Python, and the carried ones stay Arrow arrays, so
    ids of any type and null ids come out as they went in.
    """
    made = _parse_datatype_string(fields)
    kinds = [pa.field(f.name, ARROW[f.dataType.simpleString()]) for f in made]
    names = [f"c{i}" for i in range(len(carried))]
    given = docs.select(*[docs[c].alias(n) for c, n in zip(carried, names)], docs[text].alias("text"))
    schema = StructType([StructField(c, docs.schema[c].dataType) for c in carried] + list(made))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for begin, end in blocks(texts):
                origin: list[int] = []
                out: list[tuple] = []
                for i, rows in enumerate(work(texts[begin:end]), begin):
                    origin.extend([i] * len(rows))
                    out.extend(rows)
                taken = pa.array(origin, pa.int64())
                columns = [batch.column(n).take(taken) for n in names]
                columns += [pa.array(v, k.type) for v, k in zip(zip(*out), kinds)] if out else [pa.array([], k.type) for k in kinds]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(run, schema)
