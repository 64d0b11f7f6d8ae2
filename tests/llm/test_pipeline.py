import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from fieldweave.llm import toxicity
from tests.llm import test_minhash, test_mixing, test_packing

STAGES = dict(corpus_pipeline.STAGES)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_by_brute_force(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        held[name], docs = docs, spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
    after = dict(zip(list(STAGES)[:-1], list(held.values())[1:]))

    before = held["toxicity"].collect()
    lexicon = toxicity.learn(held["toxicity"], spark.read.parquet(f"{folder}/labels.parquet"))
    assert rows(after["toxicity"]) == sorted((tuple(r) for r in before if toxicity.score(lexicon.evidence(r.text)) < 0.3), key=str)
    assert after["toxicity"].count() < len(before)

    first = {}
    for r in sorted(held["exact dedup"].collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[ \t-\r]+", " ", r.text), tuple(r))
    assert rows(after["exact dedup"]) == sorted(first.values(), key=str)
    assert len(first) < held["exact dedup"].count()

    before = held["near dedup"].collect()
    kept = {r[0] for r in test_minhash.brute([(r.doc_id, r.text) for r in before]) if r[3]}
    assert rows(after["near dedup"]) == sorted((tuple(r) for r in before if r.doc_id in kept), key=str)

    before = held["mixing"].collect()
    want = Counter({r[0]: r[4] for r in test_mixing.brute([(r.doc_id, r.text, r.source) for r in before]) if r[4]})
    got = Counter()
    for r in after["mixing"].collect():
        got[r.doc_id] += len(r.text.encode().split())
    # Targets are doubles here and fractions there: one word in a source may differ.
    assert sum(abs(got[i] - want[i]) for i in got | want) <= 20

    pieces = docs.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    ids = Counter()
    for r in held["packing"].collect():
        ids[r.doc_id] += len(test_packing.want(r.text))
    assert {r.doc_id: r.n for r in pieces} == dict(ids)
    full = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in full) and sum(r.n < 2048 for r in full) <= 1


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row int"


def test_edges(spark, folder):
    """NULLs, blanks, a very long text, repeated rows and clashing names pass every stage; empty tables stay empty."""
    data = [(None, None, None, None, None, None, None), (1, "", "en", "a", 0, "x", 1), (2, "b c d e f", "en", "a", 9, "x", 1), (2, "b c d e f", "en", "a", 9, "x", 1),
            (3, "b  c d e f", "en", None, 10, "x", 1), (4, "long " * 60000, "en", "a", 300000, "x", 1), (None, "k l m n o p", "en", "b", 11, "x", 1)]
    docs = spark.createDataFrame(data, SCHEMA)
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = stage(spark, docs, folder)
        assert name == "packing" or found[name].columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert found["toxicity"].count() == 7

    assert found["exact dedup"].count() == 4
    assert found["near dedup"].filter("text is not null and text != ''").count() == 4


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


@pytest.mark.parametrize("stage", list(STAGES))
def test_columns_of_any_name(spark, folder, stage):
    """Names that the operators use themselves, and one with a dot."""
    names = ["_key", "_id", "_kept", "_text", "_cut", "row", "part", "a.b", "gone_id", "kept", "size", "label", "doc_key", "node"]
    texts = ["one two three four five six", "one two  three four five six", "x y", None]
    data = [(n, t, "en", "s", n, *[f"{c}{n}" for c in names]) for n, t in enumerate(texts)]
    schema = ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *[f"`{c}` string" for c in names]])
    out = STAGES[stage](spark, spark.createDataFrame(data, schema), folder)
    if stage == "packing":
        assert out.count() == 4
    else:
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
        assert all(tuple(r)[5:] == tuple(f"{c}{r.doc_id}" for c in names) for r in out.collect())
