import importlib.util
import os

import pytest

import __spark_entry__
from clickloom.llm import queries

spec = importlib.util.find_spec("corpus_pipeline")


@pytest.mark.skipif(spec is None, reason="the pipeline was taken away")
def test_every_stage_keeps_rows_of_its_input(spark, folder):
    import corpus_pipeline
    from clickloom.llm.common import table
    from clickloom.session import materialize

    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, folder), "stage")
        assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert out.select("doc_id", "text").exceptAll(docs.select("doc_id", "text").join(out.select("doc_id"), "doc_id", "left_semi")).distinct().count() == 0 or name == "mixing"
        assert 0 < out.count() and (name == "mixing" or out.count() <= docs.count())
        docs = out
    assert "shard" in docs.columns


@pytest.mark.skipif(spec is None, reason="the pipeline was taken away")
def test_stages_take_empty_tables_and_nulls(spark, folder):
    import corpus_pipeline
    from clickloom.llm.common import table

    for rows in ([], [(None, None, None, None, None), (1, "", None, "a", 0), (2, None, "en", None, None)]):
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(rows, table(spark, folder, "documents").schema)
            assert stage(spark, docs, folder).count() <= len(rows)


def test_queries_are_registered():
    assert set(queries.QUERIES) <= set(__spark_entry__.queries()) and set(queries.ORACLE) <= set(__spark_entry__.oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", queries.ORACLE)
def test_queries_match_their_sql(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(folder, 'documents.parquet')}'")
    mine = queries.QUERIES[name](spark, folder)
    theirs = duck.execute(queries.ORACLE[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(mine.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in mine.select(columns).collect()))) == sorted(map(repr, theirs.fetchall()))
