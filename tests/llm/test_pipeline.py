"""The pipeline against a plain version of its stages, and its contract."""

from collections import Counter

import corpus_pipeline
from jobloom.llm import language_id, quality

from tests.llm.test_operators import brute_components


def test_run_against_plain_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = [r for r in docs.collect() if quality.first_rejection(quality.Text.of((r.text or "").encode()), list(quality.RULES)) is None]
    table = spark.createDataFrame(left, docs.schema)
    model = language_id.train(table.where("crc32(cast(cast(doc_id as string) as binary)) % 3 != 1"))
    known = {r.doc_id for r in language_id.identify(table, model).where("lang_pred != 'und' and score >= 0.5").collect()}
    left = [r for r in left if r.doc_id in known]
    groups = brute_components([(r.doc_id, r.text) for r in left], 5)
    want = {i for i, (_, root) in groups.items() if i == root}
    got = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in got.collect()} == want
    sizes = Counter()
    for r in got.collect():
        sizes[r.sequence_id] += r.length
    assert max(sizes.values()) <= 1024


def test_stages_keep_the_columns_and_handle_edges(spark, edge_docs, no_docs):
    for table in (edge_docs, no_docs):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, "")
            assert now.columns == table.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() >= 0
