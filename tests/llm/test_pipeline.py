"""The pipeline against its stages' own decisions, and the registration."""

from collections import Counter

import __spark_entry__ as entry
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from obslayers.llm import near_duplicates, quality_classifier, quality_rules, queries

SF = "/root/testdata/sf0.001"
NAMES = ["quality_rules", "quality_classifier", "near_dedup", "best_fit_packing"]


def test_every_operator_is_registered():
    found = entry.queries()
    assert all(sum(name.startswith(f"op{n}_") for name in found) == 1 for n in range(1, 11))
    assert found.keys() == {*entry.QUERIES, *queries.QUERIES, "pipeline"}
    assert [name for name, _ in pipeline.STAGES] == NAMES


def test_stages_keep_what_their_operators_keep(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    extra = spark.createDataFrame(
        [(None, "good words make a text " * 3 + "of some length that is said once only", "en", "s", 1), (5000, None, None, None, None), (5001, "", "en", "s", 0)],
        docs.schema,
    )
    docs = docs.unionByName(extra)
    outputs = []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, outputs[-1] if outputs else docs, SF)
        out.write.parquet(str(tmp_path / str(i)))
        outputs.append(spark.read.parquet(str(tmp_path / str(i))))
    rules, classes, unique, packed = outputs
    for out in outputs[:3]:
        assert out.columns == docs.columns

    def ids(df):
        return Counter(r.doc_id for r in df.select("doc_id").collect())

    kept = Counter(r.doc_id for r in quality_rules.verdicts(docs, labels).where("kept").collect())
    assert ids(rules) == kept and 5000 not in kept and 5001 not in kept
    assert ids(classes) == Counter(r.doc_id for r in quality_classifier.score_documents(rules, labels).where("predicted = 1").collect())
    heads = {r.class_id for r in near_duplicates.near_duplicates(classes).collect()}
    assert ids(unique) == Counter(heads)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in unique.collect()}
    totals = Counter()
    for r in packed.collect():
        totals[r.doc_id] += r.length
    assert totals == Counter(lengths)
