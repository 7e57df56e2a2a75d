import os

import pyarrow as pa
import pytest

import corpus_pipeline
from tidelog.llm.common import staged, table
from tidelog.llm.decontaminate import plain

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_stages_over_the_smallest_table(spark):
    docs = table(spark, SF, "documents")
    columns, items = docs.columns, [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = staged(stage(spark, docs, SF))
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and set(after) <= set(before)
        if name == "line_dedup":
            assert all(set((after[i] or "").split("\n")) <= set((before[i] or "").split("\n")) for i in after)
        else:
            assert all(after[i] == before[i] for i in after)
        if name == "near_dedup":
            texts = [t for t in after.values() if t]
            assert len(set(texts)) == len(texts)
        if name == "decontamination":
            hit = {i for i, t in before.items() if any(x in plain(t) for x in items)}
            assert not hit & set(after) and len(before) - len(after) <= len(hit) + 2
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == set(after)


def test_python_gets_few_texts_at_once(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        corpus_pipeline.near_dedup(spark, docs([(1, "a")]), SF).collect()
        held = spark.range(0, 2500, 1, 1).mapInArrow(lambda batches: (b.slice(0, 1).set_column(0, "id", pa.array([b.num_rows])) for b in batches), "id long")
        assert sorted(r.id for r in held.collect()) == [500, 1000, 1000]
    finally:
        spark.conf.set(key, before)
