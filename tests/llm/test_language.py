"""Fusion of evidence: held-out accuracy, priors by hand, odd rows."""

import numpy as np
import pytest
from conftest import SMALL
from llm_cases import no_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from tripworks.llm import language
from tripworks.llm.frames import prepare, read


@pytest.fixture(scope="module")
def documents(spark):
    return read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang", "source").cache()


def test_held_out_accuracy(spark, documents):
    prepare(spark)
    fit, rest = documents.where("doc_id % 2 = 0"), documents.where("doc_id % 2 = 1")
    blind = rest.withColumn("declared", F.lit(None).cast("string")).withColumn("nowhere", F.lit("x"))
    found = language.identify(blind, "doc_id", "text", "declared", "nowhere", fit_on=fit.withColumn("declared", F.col("lang")))
    met = found.join(rest, found["row_id"] == rest["doc_id"])
    share, accepted = met.agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.avg(F.col("accepted").cast("int"))).first()
    assert share > 0.97 and accepted > 0.999


def test_clean_documents_are_accepted(spark, documents):
    found = language.identify(documents, "doc_id", "text", "lang", "source")
    assert found.where("not accepted").count() == 0
    assert found.where("language = declared").count() > 0.98 * documents.count()


def test_evidence_beside_the_text(spark, documents):
    """A text of one shared word goes with what its host mostly holds, or with what it declares."""
    rows = [(10_000, "la", None, "h1", "fr"), (10_001, "la", None, "h2", "es"), (10_002, "la", "fr", "h3", ""), (10_003, "zzqx jjkw qqq zzzx wwq " * 20, None, "h1", "fr")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, suffix string")
    hosts = documents.withColumn("source", F.when(F.col("lang") == "fr", "h1").when(F.col("lang") == "es", "h2").otherwise("h0"))
    hosts = hosts.withColumn("suffix", F.when(F.col("lang") == "fr", "fr").otherwise("es"))
    found = language.identify(hosts.unionByName(odd), "doc_id", "text", "lang", "source", "suffix")
    by_id = {r["row_id"]: r for r in found.where("row_id >= 10000").collect()}
    assert [by_id[i]["language"] for i in (10_000, 10_001, 10_002)] == ["fr", "es", "fr"]
    assert not by_id[10_003]["accepted"]


def test_priors_are_smoothed_upwards(spark):
    votes = spark.createDataFrame([("h", "s", "en", 10), ("g", "s", "fr", 30), ("e", "t", "de", 5)], "host string, suffix string, language string, n bigint")
    names, k = ("de", "en", "fr"), language.STRENGTH
    whole = (np.array([5, 10, 30]) + k / 3) / (45 + k)
    suffix = (np.array([0, 10, 30]) + k * whole) / (40 + k)
    expected = (np.array([0, 10, 0]) + k * suffix) / (10 + k)
    found = {r["host"]: r["prior"] for r in language.host_priors(votes, names).collect()}
    assert found["h"] == pytest.approx(list(expected)) and all(sum(p) == pytest.approx(1) for p in found.values())


def test_long_texts_are_read_in_runs(monkeypatch):
    text = ("Été river " * 500).encode()
    whole = np.concatenate(list(language.triples(text)))
    monkeypatch.setattr(language, "RUN", 100)
    assert np.array_equal(np.concatenate(list(language.triples(text))), whole)
    assert sum(map(len, language.triples(b""))) == 0 and sum(map(len, language.triples(b" 1 2 "))) == 0


def test_odd_documents(spark):
    prepare(spark)
    docs = odd_documents(spark)
    found = language.identify(docs, "doc_id", "text", "lang", "source")
    assert found.count() == docs.count()
    silent = {r["row_id"]: r for r in found.where("row_id in (3, 4, 5)").collect()}
    assert all(not r["accepted"] and r["language"] == "und" and r["text_language"] is None for r in silent.values())
    kept = language.keep_identified(docs)
    assert kept.dtypes == docs.dtypes
    assert rows_of(kept.where("doc_id in (1, 2, 6, 7)")) == rows_of(docs.where("doc_id in (1, 2, 6, 7)"))
    assert kept.where("doc_id in (3, 4, 5)").count() == 0 and kept.where("doc_id is null and text is not null").count() == 1 and kept.where("doc_id is null").count() == 1
    assert language.identify(no_documents(spark), "doc_id", "text", "lang", "source").count() == 0
    assert language.keep_identified(no_documents(spark)).count() == 0


def test_pages_bring_markup_suffix_and_host(spark):
    prepare(spark)
    evidence = language.page_evidence(read(spark, SMALL, "pages"))
    found = language.identify(evidence, "page_id", "text", "declared", "host", "suffix")
    assert found.where("language = declared").count() > 0.95 * evidence.count()
    odd = spark.createDataFrame([(1, None, None), (2, "x", "<HTML LANG=fr><p>"), (3, "http://A.b.ORG:80/x", "<html lang='de-AT'>Wort")], "page_id bigint, url string, html string")
    rows = {r["page_id"]: r for r in language.page_evidence(odd).collect()}
    assert [rows[i]["declared"] for i in (1, 2, 3)] == [None, "fr", "de"]
    assert (rows[3]["host"], rows[3]["suffix"], rows[1]["host"]) == ("a.b.org:80", "org", "")
