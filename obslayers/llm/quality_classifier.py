"""Quality classifier by a regularised quadratic discriminant (operator 9).

Each whole text becomes a few transformed statistics. The labelled rows' sums and sums
of products, taken per class by Spark, give both classes' means and covariances; the
covariances are shrunk towards a round one and factored once. A text's score is the
difference of its two log densities, squashed to 0..1.

Statistics are written once, to be read by the fit and by the scoring. The fit gathers
one row per class, whatever the number of labels; nothing else leaves the executors.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from obslayers.llm.batches import map_texts
from obslayers.storage import materialize

NAMES = (
    "words",
    "word_length",
    "symbols",
    "capitals",
    "capital_words",
    "digits",
    "exclamations",
    "marks",
    "distinct_words",
    "distinct_triples",
    "commonest_word",
    "repeated_lines",
)
SYMBOLS, DIGITS, MARKS = b"#*$%&|<>", b"0123456789", b".,;:?"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Share of the covariance that is replaced by a round one.
SHRINKAGE = 0.1


def _share(part: int, whole: int) -> float:
    """The logarithm of a smoothed share: closer to a normal distribution than the share."""
    return math.log((part + 0.5) / (whole + 1))


def text_statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``NAMES``."""
    raw, words = text.encode("utf-8"), text.split()
    n, size = len(words), len(raw)

    def among(chars: bytes) -> int:
        return size - len(raw.translate(None, chars))

    lines = [line for line in text.split("\n") if line.strip()]
    triples = max(n - 2, 0)
    commonest = max(Counter(words).values(), default=0)
    return [
        math.log1p(n),
        math.log((sum(map(len, words)) + 1) / (n + 1)),
        _share(among(SYMBOLS), size),
        _share(among(CAPITALS), size),
        _share(sum(map(str.isupper, words)), n),
        _share(among(DIGITS), size),
        _share(among(b"!"), n),
        _share(among(MARKS), n),
        math.log((len(set(words)) + 1) / (n + 1)),
        math.log((len(set(zip(words, words[1:], words[2:]))) + 1) / (triples + 1)),
        _share(commonest, n),
        _share(len(lines) - len(set(lines)), len(lines)),
    ]


def free_name(docs: DataFrame, wanted: str) -> str:
    """``wanted``, or that with underscores behind it, whichever no column has."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_statistics(docs: DataFrame, carried: list[str], text_column: str, name: str) -> DataFrame:
    """The ``carried`` columns and the statistics as an array ``name``; a null text is empty."""

    def make():
        return lambda texts: ([(text_statistics(text),)] for text in texts)

    return map_texts(docs, carried, text_column, f"{name} array<double>", make)


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): mean, inverse of the covariance's Cholesky factor, log weight.

    Statistics are brought to the scale of the labelled rows first.
    """

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    whitening: tuple[np.ndarray, np.ndarray]
    log_weights: tuple[float, float]

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        """Scores of rows of statistics: over 0.5 where class 1 is the likelier one."""
        x = (statistics - self.centre) / self.scale
        densities = []
        for mean, whitening, weight in zip(self.means, self.whitening, self.log_weights):
            distance = np.square((x - mean) @ whitening.T).sum(1)
            densities.append(weight - distance / 2)
        ratio = densities[1] - densities[0]
        # Log densities far out reach thousands; this keeps them apart where a logistic
        # function would round them all to 0 or 1.
        return 0.5 + 0.5 * ratio / (len(self.centre) + np.abs(ratio))


def fit(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE) -> Discriminant | None:
    """The discriminant from each class's count, sums and sums of products.

    None unless both classes have a row.
    """
    if any(moments.get(c, (0,))[0] == 0 for c in (0, 1)):
        return None
    total = sum(m[0] for m in moments.values())
    centre = sum(m[1] for m in moments.values()) / total
    products = sum(m[2] for m in moments.values())
    spread = np.diag(products) / total - centre**2
    scale = np.sqrt(np.where(spread > 1e-12, spread, 1.0))
    means, whitening, weights = [], [], []
    for c in (0, 1):
        n, sums, own = moments[c]
        mean = sums / n
        covariance = (own / n - np.outer(mean, mean)) / np.outer(scale, scale)
        # Of few rows the covariance says little: the pooled unit spread counts as one
        # more row per statistic.
        weight = n / (n + len(mean))
        covariance = weight * covariance + (1 - weight) * np.eye(len(mean))
        level = max(np.trace(covariance) / len(mean), 1e-3)
        covariance = (1 - shrinkage) * covariance + shrinkage * level * np.eye(len(mean))
        factor = np.linalg.cholesky(covariance)
        means.append((mean - centre) / scale)
        whitening.append(np.linalg.inv(factor))
        weights.append(math.log(n / total) - np.log(np.diag(factor)).sum())
    return Discriminant(centre, scale, tuple(means), tuple(whitening), tuple(weights))


def class_moments(statistics: DataFrame, name: str, label: str) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products per class: partial sums in the tasks, then one row each."""
    d = len(NAMES)
    x = [F.col(name)[i] for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = statistics.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()
    out = {}
    for row in rows:
        square = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                square[i, j] = square[j, i] = row[f"p{i}_{j}"]
        out[int(row[label])] = (row["n"], np.array([row[f"s{i}"] for i in range(d)]), square)
    return out


def _held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(statistics: DataFrame, labels: DataFrame, name: str, id_column: str, label_column: str) -> Discriminant | None:
    """The discriminant of the labelled rows that are not held out.

    Of an id with labels of both kinds nothing is learned, nor from null labels; repeated
    documents count as often as they are there.
    """
    wanted = labels.where(F.col(label_column).isin(0, 1) & ~_held_out(F.col(id_column)))
    agreed = wanted.groupBy(F.col(id_column).alias("labelled")).agg(
        F.min(label_column).alias("least"), F.max(label_column).alias("most")
    )
    agreed = agreed.where("least = most").select("labelled", F.col("least").alias("label"))
    own = statistics.select(F.col(id_column).alias("own"), F.col(name).alias("x"))
    return fit(class_moments(own.join(agreed, F.col("own") == F.col("labelled")), "x", "label"))


def scored(statistics: DataFrame, model: Discriminant | None, name: str, score: str) -> DataFrame:
    """``statistics`` with ``score`` in the place of ``name``; 0.5 everywhere without a model."""
    kept = [f for f in statistics.schema if f.name != name]
    schema = StructType([*kept, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            values = np.full(len(x), 0.5) if model is None else model.scores(x)
            columns = [batch.column(f.name) for f in kept] + [pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return statistics.mapInArrow(run, schema)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    carried: list[str] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """Every row's ``carried`` columns (the id alone, if not given), ``held_out``, ``score``, ``predicted``.

    A null text counts as empty and is scored like any text. Rows with a null id are
    never held out. Without labels of both classes every score is 0.5. Should ``carried``
    have a column called ``score``, and so on, the new one gets an underscore.
    """
    carried = carried or [id_column]
    name = free_name(docs, "statistics")
    statistics = materialize(with_statistics(docs, carried, text_column, name), "statistics")
    model = learned(statistics, labels, name, id_column, label_column)
    held, score, predicted = (free_name(docs.select(*carried), n) for n in ("held_out", "score", "predicted"))
    return scored(statistics, model, name, score).select(
        *carried,
        _held_out(F.col(id_column)).alias(held),
        F.col(score),
        (F.col(score) >= 0.5).cast("int").alias(predicted),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, with their columns as they are."""
    rows = score_documents(docs, labels, docs.columns, id_column, text_column)
    predicted = rows.columns[-1]
    return rows.where(F.col(predicted) == 1).select(*docs.columns)
