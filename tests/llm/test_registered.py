"""The registered queries on the test data, and the pipeline's stages one by one."""
import duckdb
import pytest
from llm_helpers import importable
from test_decontaminate import words
from test_overlap import brute as near_brute

import corpus_pipeline
from weekwise.llm import queries as llm_queries
from weekwise.llm import toxicity
from weekwise.llm.common import Scratch, table
from weekwise.oracle.compare import compare

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


@pytest.mark.parametrize("name", sorted(llm_queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    con.sql(f"CREATE VIEW oracle AS {llm_queries.oracle_sql()[name]}")
    found = compare(llm_queries.queries()[name](importable(spark), SF), con, "SELECT * FROM oracle")
    assert found["ok"], found


def test_all_are_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names


def test_pipeline_stages(spark):
    docs = table(importable(spark), SF, "documents")
    scratch = Scratch(spark, "test")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(scratch.save(stage(spark, tables[-1], SF), name))
    assert all(t.columns == docs.columns for t in tables[:-1])
    rows = [{r.doc_id: r for r in t.collect()} for t in tables]
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    toxic = {r.doc_id for r in toxicity.score_documents(docs, model).collect() if r.score >= toxicity.THRESHOLD}
    assert set(rows[1]) == set(rows[0]) - toxic
    last = {}
    for i, r in rows[1].items():
        last[r.text.lower() if r.text.isascii() else r.text] = i
    assert {r.text for r in rows[2].values()} == {r.text for r in rows[1].values()} or len(rows[2]) == len(last)
    linked = near_brute([(i, r.text) for i, r in rows[2].items()], 5, (80, 100))
    assert set(rows[3]) == {i for i, n, c in linked if i == c}
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = words(r.text)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    for i, r in rows[3].items():
        w = words(r.text)
        if not any(tuple(w[k:k + 10]) in windows for k in range(max(1, len(w) - 9))):
            assert rows[4][i].text == r.text
    assert set(rows[5]) == set(rows[4])
    assert corpus_pipeline.run(spark, SF).count() == len(rows[5])
