"""The pipeline's stages on a small table, each against what it says it does."""

from collections import Counter

import corpus_pipeline
from riskstream.llm import quality_rules
from tests.conftest import TESTDATA
from tests.llm.test_operators import DOCS, ODD, brute_components

FOLDER = f"{TESTDATA}/sf0.001"


def test_stages_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, FOLDER)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == before.columns
        kept[name] = (before, docs)
    before, after = kept["quality_rules"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    field = quality_rules.learn(before, labels)
    expected = {r.doc_id for r in quality_rules.quality_rules(before, field).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == expected
    before, after = kept["near_duplicates"]
    components = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in components.items() if i == c}
    before, after = kept["repeated_passages"]
    whole = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_chars == len(r.text) and len(r.text) <= len(whole[r.doc_id])
    before, after = kept["mixing"]
    times = Counter(r.doc_id for r in after.collect())
    assert set(times) == {r.doc_id for r in before.collect()}
    before, after = kept["packing"]
    pieces = Counter((r.doc_id, r.piece) for r in after.collect())
    assert {i for i, _ in pieces} == set(times)
    assert all(n == times[i] for (i, _), n in pieces.items())


def test_run_and_odd_rows(spark):
    rows = [(i, t, "en", "s", None) for i, t in ODD]
    docs = spark.createDataFrame(rows, DOCS)
    for empty in (False, True):
        frame = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, FOLDER).count() >= 0
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
