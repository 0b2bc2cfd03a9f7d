import duckdb
import pytest
from conftest import TESTDATA
from helpers import AWKWARD, docs_of
from oracle_check import compare, connect

import corpus_pipeline
from halfstar.llm import queries as Q

SQL = Q.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert compare(connect(TESTDATA), SQL[name], Q.queries()[name](spark, TESTDATA)) is None


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_rows(spark, name, stage):
    docs = docs_of(spark, AWKWARD, clash=True)
    out = stage(spark, docs, TESTDATA)
    assert out.count() <= len(AWKWARD)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert 5 in {r.doc_id for r in out.collect()} or name == "quality classifier"
    assert stage(spark, docs.limit(0), TESTDATA).count() == 0


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TESTDATA)
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > counts[0] / 2
    assert sorted(map(tuple, corpus_pipeline.run(spark, TESTDATA).collect())) == sorted(map(tuple, docs.collect()))


def test_clean_documents_stay(spark):
    """Labelled good documents with a text and lines of their own come through the first stages."""
    con = duckdb.connect()
    good = {
        r[0] for r in con.execute(
            f"""select d.doc_id from '{TESTDATA}/documents.parquet' d join '{TESTDATA}/labels.parquet' l using (doc_id)
                where quality = 1 and length(text) > 200"""
        ).fetchall()
    }
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.classify_quality(spark, docs, TESTDATA).collect()}
    assert len(good - kept) <= 0.02 * len(good)
