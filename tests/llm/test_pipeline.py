from pathlib import Path

import pytest

import corpus_pipeline
from linkgraph.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == columns, name
        assert 0.5 * n < out.count() <= n
    last = corpus_pipeline.run(spark, FOLDER)
    rows = last.collect()
    assert 0.5 * n < len(rows) < n and all(r.n_tokens == len(r.ids) for r in rows)


def test_every_operator_has_a_query():
    assert [name.split("_")[0] for name in queries.queries() if name[:2] == "op"] == [f"op{k}" for k in range(1, 11)]
