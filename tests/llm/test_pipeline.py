"""The pipeline: stage by stage on odd rows, and as a whole against brute force."""

import cases
import corpus_pipeline
import oracle
import pytest
import test_line_dedup
import test_simhash
from conftest import SF_DIR

import __spark_entry__ as entry_points
from txlake.llm import queries


def test_stages_take_odd_rows(spark):
    docs = cases.clashing(spark, cases.documents())
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(apply(spark, docs, SF_DIR).collect(), docs.schema)
        assert docs.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_no_rows(spark, stage):
    assert stage[1](spark, cases.frame(spark, []), SF_DIR).count() == 0


def test_first_three_stages_equal_brute_force(spark):
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    con = oracle.connect(SF_DIR)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.SQL['op3_quality_rules']}) WHERE kept").fetchall()}
    docs = cases.frame(spark, rows)
    good = corpus_pipeline.good_documents(spark, docs, SF_DIR)
    assert {r["doc_id"] for r in good.collect()} == kept
    rows = [r for r in rows if r[0] in kept]
    lines = corpus_pipeline.without_repeated_lines(spark, cases.frame(spark, rows), SF_DIR)
    want = {r[0]: r[1] for r in test_line_dedup.expected(rows)}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want
    fps = {i: test_simhash.brute_fingerprint(t) for i, t in want.items()}
    comp = test_simhash.brute_components(fps.values())
    least = {}
    for i in sorted(fps):
        least.setdefault(comp[fps[i]], i)
    one = corpus_pipeline.without_near_duplicates(spark, lines, SF_DIR)
    assert {r["doc_id"] for r in one.collect()} == set(least.values())


def test_whole(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.count() > 0 and out.where("n_tokens <= 2").count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    assert oracle.differences(queries.QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), queries.SQL[name]) == []


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
