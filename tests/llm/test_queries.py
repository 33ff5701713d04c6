"""The registered queries: columns, SQL, and the pipeline's stages."""

import pytest
from compare import normalised, oracle_rows

import corpus_pipeline
from askquarry.llm.queries import QUERIES
from askquarry.llm.sql import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = oracle_rows(ORACLE[name], sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert normalised(df.columns, [tuple(r) for r in df.collect()]) == normalised(columns, expected)


def test_pipeline_narrows_and_packs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(packed.columns) and packed.count() > 0
