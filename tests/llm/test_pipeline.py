"""The pipeline as a whole and the registered queries of the package."""

import importlib.util

import corpus_pipeline
from lakerisk.llm import catalog
from lakerisk.session import stage_table


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 11))
    assert importlib.util.find_spec("__spark_entry__")


def test_stages_keep_the_columns_and_shrink(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf))
        assert docs.columns == columns and 0 < docs.count() <= rows, name
        rows = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == rows
    assert corpus_pipeline.run(spark, sf).count() == rows


def test_stages_take_odd_and_empty_tables(spark, documents, odd_rows, sf):
    for rows in (odd_rows, []):
        docs = documents(rows)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert out.count() <= len(rows)
            docs = stage_table(out) if out.columns == docs.columns else docs
