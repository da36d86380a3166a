"""Corpus queries against their SQL, and the pipeline against a plain model of its stages."""

import cases
import oracle
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from clickloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER) is None


def test_stages_keep_what_they_should(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], FOLDER).write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
        if name != "packing":
            assert tables[-1].columns == docs.columns
    whole, clean, single, distinct, mixed, packed = [t.collect() for t in tables]
    toxic = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 1").collect()}
    ids = lambda rows: {r.doc_id for r in rows}
    assert len(ids(whole) - ids(clean) - toxic) <= 2
    squeezed = lambda t: "".join((t or "").split())
    assert len(single) == len({squeezed(r.text) for r in clean})
    expected = set(cases.brute_components([r.doc_id for r in single], [r.text for r in single], 5, 80))
    assert ids(distinct) == expected
    assert ids(mixed) <= ids(distinct) and len(mixed) > len(distinct)
    assert ids(packed) == ids(mixed) and sum(r.piece == 0 for r in packed) == len(mixed)


def _stages(spark, docs, folder):
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], FOLDER).write.parquet(f"{folder}/{name}")
        tables.append(spark.read.parquet(f"{folder}/{name}"))
        if name != "packing":
            assert tables[-1].columns == docs.columns
    return [t.collect() for t in tables]


def test_stages_take_nulls_ties_repeats_and_any_column_name(spark, folder):
    names = {"lang": "__score", "n_chars": "position", "row": "__mix", "node": "kept__", "pivot": "_metadata"}
    docs = cases.edge_docs(spark).withColumnsRenamed(names)
    whole, clean, single, distinct, mixed, packed = _stages(spark, docs, folder)
    assert len(clean) == len(whole)
    squeezed = {"".join((r.text or "").split()) for r in whole}
    assert {"".join((r.text or "").split()) for r in single} == squeezed and len(single) == len(squeezed)
    # The long text and its longer copy, the short one and its two near copies.
    assert len({r.doc_id for r in distinct} & {7, 8}) == 1 and len({r.doc_id for r in distinct} & {9, 10, 11}) == 1
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}
    assert sum(r.piece == 0 for r in packed) == len(mixed)


def test_stages_take_an_empty_table(spark, folder):
    assert all(not rows for rows in _stages(spark, cases.edge_docs(spark, empty=True), folder))
