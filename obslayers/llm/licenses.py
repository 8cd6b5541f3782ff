"""License scans (operator 13): word grams of texts voted onto the diagonals of license notices.

Every run of four words of every text is a rolling hash, joined to the places of those hashes in
the notices. A place in the text less the place in the notice is a diagonal; the notice's words
in a row, with some replaced, vote for one diagonal, and words added or left out move the
votes to a diagonal near it. Votes are summed by text, notice and diagonal, diagonals near each
other make one span, and the words of the span are held against the notice: it is
found where 80 % of its words stand there in order, with no more than as many others between
them. Of notices at one place the best gives its label.

A notice with 80 % of its words in place on a diagonal keeps runs of four words that hold a fifth of
it less three words at least, so spans with fewer votes are left out without a loss. Votes of a text
are kept by the text's digest, so copies of a text are voted for together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from obslayers.llm.batches import blocks, map_texts
from obslayers.storage import materialize

# The words of a text, and the phrases whose every place counts.
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Usual notices, by the identifier of the license.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    ),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    ),
    (
        "bsd-3-clause",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT.""",
    ),
)

# Words of a gram, share of a notice that must be there, diagonals apart that make one span.
GRAM, SHARE, NEAR = 4, 0.8, 8
# Grams of notices, and spans, up to which every executor gets a copy (some 20 and 40 bytes each).
BROADCAST_ROWS = 500_000
# Words of which a task remembers the hash.
HELD_WORDS = 500_000
_FACTORS = np.array([0x9E3779B97F4A7C15**j % 2**64 for j in range(GRAM)], np.uint64)


@dataclass(frozen=True)
class Notice:
    label: str
    words: tuple[bytes, ...]

    @staticmethod
    def of(label: str, text: str) -> Notice:
        return Notice(label, tuple(words_of(text)))


def words_of(text: str) -> list[bytes]:
    """The words of a text with A-Z in lower case, in UTF-8."""
    return WORDS.findall(text.encode("utf-8").lower())


class Grams:
    """Rolling hashes of all runs of ``GRAM`` words; alike in every task."""

    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def __call__(self, words: Sequence[bytes]) -> np.ndarray:
        n = len(words) - GRAM + 1
        if n < 1:
            return np.empty(0, np.int64)
        if len(self._known) > HELD_WORDS:
            self._known.clear()
        known = self._known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        total = np.zeros(n, np.uint64)
        for j in range(GRAM):
            total += codes[j : j + n] * _FACTORS[j]
        return total.view(np.int64)


def _key(text: Column) -> list[Column]:
    """128 bits of a text's digest."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _texts(docs: DataFrame, text_column: str) -> Column:
    return F.coalesce(docs[text_column], F.lit(""))


def _gram_places(spark: SparkSession, notices: Sequence[Notice]) -> DataFrame:
    make = Grams()
    rows = [(int(gram), i, at) for i, notice in enumerate(notices) for at, gram in enumerate(make(notice.words))]
    places = spark.createDataFrame(rows, "gram bigint, notice int, at int")
    return F.broadcast(places) if len(rows) <= BROADCAST_ROWS else places


def votes(docs: DataFrame, notices: Sequence[Notice], text_column: str = "text") -> DataFrame:
    """Per text (h1, h2), notice and diagonal the number of ``votes`` and the first and last of them in the text."""

    def make():
        grams = Grams()
        return lambda texts: [[(grams(words_of(text)),)] for text in texts]

    text = _texts(docs, text_column)
    given = docs.select(*_key(text), text.alias("text"))
    grams = map_texts(given, ["h1", "h2"], "text", "grams array<bigint>", make)
    each = grams.select("h1", "h2", F.posexplode("grams").alias("pos", "gram"))
    met = each.join(_gram_places(docs.sparkSession, notices), "gram")
    return met.groupBy("h1", "h2", "notice", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )


def spans(voted: DataFrame, notices: Sequence[Notice]) -> DataFrame:
    """Neighbouring diagonals as one span each, from the lowest to the highest, with enough votes to be the notice."""
    sizes = F.array(*[F.lit(len(notice.words)) for notice in notices])
    voted = voted.withColumn("size", F.get(sizes, F.col("notice")))
    order = Window.partitionBy("h1", "h2", "notice").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.least(F.lit(NEAR), F.col("size") / 2)
    numbered = voted.withColumn("begins", F.coalesce(apart, F.lit(False)).cast("int"))
    numbered = numbered.withColumn("span", F.sum("begins").over(order))
    # No more words are covered than this.
    covered = F.least(F.col("votes") * GRAM, F.col("high") - F.col("low") + GRAM)
    merged = numbered.groupBy("h1", "h2", "notice", "span").agg(
        F.min("diagonal").alias("first"), F.max("diagonal").alias("last"), F.sum(covered).alias("covered"), F.max("size").alias("size")
    )
    return merged.where(F.col("covered") >= F.col("size") * (1 - SHARE) - (GRAM - 1)).select("h1", "h2", "notice", "first", "last")


def found_at(words: Sequence[bytes], notice: Notice, first: int, last: int) -> tuple[float, int, int]:
    """How much of the notice stands in order where diagonals ``first`` to ``last`` have it, and where it begins and ends.

    The words in place, of all words of the notice or of the text between the first and the last of them.
    """
    begin = max(first, 0)
    window = words[begin : last + len(notice.words)]
    same = [x for x in SequenceMatcher(None, notice.words, window, autojunk=False).get_matching_blocks() if x.size]
    if not same:
        return 0.0, begin, begin
    low, high = same[0].b, same[-1].b + same[-1].size
    return sum(x.size for x in same) / max(len(notice.words), high - low), begin + low, begin + high


def phrase_places(words: Sequence[bytes], phrases: Sequence[tuple[tuple[bytes, ...], str]]) -> list[tuple[int, str]]:
    """Every place (first word, label) where a phrase's words stand."""
    found = []
    for phrase, label in phrases:
        at = -1
        for _ in range(words.count(phrase[0])):
            at = words.index(phrase[0], at + 1)
            if tuple(words[at : at + len(phrase)]) == phrase:
                found.append((at, label))
    return found


FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
)


def judged(text: str, marks: Sequence[dict], notices: Sequence[Notice], phrases) -> tuple:
    """The result row of a text with the given spans."""
    words = words_of(text)
    places = phrase_places(words, phrases)
    starts = [at for at, _ in places]
    base, labels = {label for _, label in places}, {label for _, label in places}
    best, met = 1.0 if places else 0.0, []
    for mark in marks:
        notice = notices[mark["notice"]]
        part, begin, end = found_at(words, notice, mark["first"], mark["last"])
        best = max(best, part)
        if part >= SHARE:
            met.append((-part, begin - end, notice.label, begin, end))
    # Of notices at one place the one that fits best, and of these the longest.
    taken: list[tuple[int, int]] = []
    for _, _, label, begin, end in sorted(met):
        if all(end <= b or begin >= e for b, e in taken):
            taken.append((begin, end))
            labels.add(label)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), best


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
) -> DataFrame:
    """Per document its phrases' places, the labels of phrases and of notices, and a score.

    The score is 1 where a phrase stands, else the largest share of a notice that was found. A null
    text counts as empty and has no words, no places (null first and last) and no labels
    (empty). Ids may be null or repeated; every row has its own result. Notices of under four
    words are refused. Other columns are not read, whatever their names.
    """
    made = [Notice.of(*notice) for notice in notices]
    if any(len(notice.words) < GRAM for notice in made):
        raise ValueError(f"a notice has {GRAM} words at least")
    split = [(tuple(words_of(phrase)), label) for phrase, label in phrases]
    found = materialize(spans(votes(docs, made, text_column), made), "spans")
    marks = found.groupBy("h1", "h2").agg(F.collect_list(F.struct("notice", "first", "last")).alias("marks"))
    n_spans = found.count()
    text = _texts(docs, text_column)
    given = docs.select(docs[id_column].alias("id"), text.alias("text"), *_key(text))
    # Beyond that size the join deals out the texts by their digests.
    given = given.join(F.broadcast(marks) if n_spans <= BROADCAST_ROWS else marks, ["h1", "h2"], "left")
    given = given.select("id", "text", "marks")
    id_field = StructField(id_column, docs.schema[id_column].dataType)
    schema = StructType([id_field, *StructType.fromDDL(FIELDS)])
    arrow = [pa.string() if isinstance(f.dataType, StringType) else pa.float64() if f.name == "score" else pa.int64() for f in schema[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own = batch.column("text").to_pylist(), batch.column("marks").to_pylist()
            for begin, end in blocks(texts):
                rows = [judged(texts[i], own[i] or (), made, split) for i in range(begin, end)]
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(begin, end - begin), *columns], names=schema.names)

    return given.mapInArrow(run, schema)
