"""Registered corpus queries against their SQL, and the pipeline against its stages by hand."""

import pytest
from compare import difference, duck
from conftest import SMALL
from llm_cases import no_documents, odd_documents, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tripworks.llm import decontaminate, oracles, queries, simhash
from tripworks.sources.scratch import materialise

SQL = oracles.all_sql()
CONTRACT = {
    1: "page_id bigint, url string, text string, n_chars bigint",
    2: "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    4: "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    5: "query_id bigint, rank int, vec_id bigint, score double",
    6: "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    7: "doc_id bigint, fingerprint string, component_id bigint",
    8: "page_id bigint, host string, path string, rule string, verdict string",
    9: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    11: "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
    12: "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    13: "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
}


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert difference(queries.REGISTRY[name](spark, SMALL), connection, SQL[name]) is None


def test_all_are_registered():
    names = [*queries.REGISTRY, "pipeline"]
    assert set(names) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_results_have_the_columns_asked_for_and_a_row_each(spark, name):
    found = queries.REGISTRY[name](spark, SMALL)
    kinds = dict(found.dtypes)
    for column in CONTRACT.get(int(name[2:].split("_")[0]), "").split(", "):
        if column:
            assert kinds[column.split()[0]] == column.split()[1]
    table = {"op1": "pages", "op8": "pages", "op5": None, "op10": None, "op11": None}.get(name.split("_")[0], "documents")
    if table:
        assert found.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_is_its_stages_one_after_another(spark):
    docs = start = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SMALL), name)
        if name == "source_mixing":
            assert docs.columns == [*start.columns, "copy"]
            continue
        assert docs.dtypes == start.dtypes
        if name == "simhash_near_dedup":
            keep = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(keep)
        elif name == "benchmark_decontamination":
            bad = decontaminate.contamination(before, spark.read.parquet(f"{SMALL}/benchmark.parquet")).where("contaminated")
            assert docs.count() == before.count() - bad.count() and bad.count() > 0
        elif name == "pii":
            assert docs.count() == before.count()
            assert docs.where(F.col("text").rlike(r"[a-z]+@[a-z0-9]+\.example\.com")).count() == 0
            assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
        else:
            assert docs.count() == before.count()
    assert rows_of(corpus_pipeline.run(spark, SMALL)) == rows_of(docs)


def test_stages_bear_odd_documents(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        schema = docs.dtypes
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, SMALL), name)
            assert docs.dtypes == schema or name == "source_mixing"
        assert docs.columns[-1] == "copy"
