"""Pipeline stages on odd rows and on columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logtally.llm.queries import table
from logtally.llm.shared import written

SMALL = "/root/testdata/sf0.001"
CLASHES = ("n_spans", "removed_bytes", "score", "_score", "row", "marks", "id", "h", "component_id", "n_shingles")


@pytest.fixture(scope="module")
def odd_docs(spark):
    docs = table(spark, SMALL, "documents")
    odd = [(None, None, None, None, None), (5, "", "en", "", 0), (5, None, "xx", "s", 1), (10**12, "x" * 70_000, "en", "s", 70_000)]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.where("doc_id < 5"))
    for name in CLASHES:
        both = both.withColumn(name, F.concat(F.lit(f"{name}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return written(spark, both, "odd")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_all_columns(spark, odd_docs, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, odd_docs, SMALL)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert 0 < len(rows) <= odd_docs.count()
    for r in rows:
        assert all(r[c] == f"{c}-{'' if r.doc_id is None else r.doc_id}" for c in CLASHES)
    if name == "substring_dedup":
        assert len(rows) == odd_docs.count()


def test_last_stage_packs_every_row(spark, odd_docs):
    out = corpus_pipeline.best_fit_packing(spark, odd_docs, SMALL)
    firsts = out.where("piece = 0")
    assert firsts.count() == odd_docs.count()
