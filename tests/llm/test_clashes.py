"""Columns of the caller that are called like a result, or like a name used on the way."""

import pytest
from helpers import bag
from pyspark.sql import functions as F

from hitledger.llm.decontaminate import contamination, cut_contaminated, drop_contaminated
from hitledger.llm.language_id import fit, keep_known, languages
from hitledger.llm.log_templates import drop_template_lines
from hitledger.llm.queries import URL_RULES
from hitledger.llm.secret_scan import redact, secret_spans
from hitledger.llm.url_filter import judge


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").cache()


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


def _with(frame, *names):
    return frame.withColumns({name: F.concat(F.lit(name), F.col(frame.columns[0]).cast("string")) for name in names})


def test_results_replace_columns_of_their_names(spark, docs, benchmark):
    net = fit(docs)
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    cases = [
        (lambda d: languages(d, net), docs, ("Score", "lang_pred"), ()),
        (lambda d: contamination(d, benchmark), docs, ("n_hit", "hit_spans", "N_WORDS"), ()),
        (drop_template_lines, docs, ("n_lines", "n_dropped"), ("_gone",)),
        (secret_spans, docs, ("spans", "base_spans"), ("_more",)),
        (lambda p: judge(p, URL_RULES), pages, ("host", "verdict", "purity"), ("_ruled", "_shape")),
    ]
    for operator, frame, results, hidden in cases:
        plain, clashing = operator(frame), operator(_with(frame, *results, *hidden, "other"))
        shown = [F.col(c).cast("string").alias(c) for c in plain.columns]
        assert bag(clashing.select(shown)) == bag(plain.select(shown))
        assert sorted(clashing.columns) == sorted([*plain.columns, *hidden, "other"])
        for name in (*hidden, "other"):
            assert clashing.where(F.col(name) != F.concat(F.lit(name), F.col(frame.columns[0]).cast("string"))).count() == 0


def test_filters_keep_the_callers_columns(docs, benchmark):
    net = fit(docs)
    cases = [
        (lambda d: keep_known(d, net), ("score", "lang_pred")), (lambda d: drop_contaminated(d, benchmark), ("n_hit", "hit_items")),
        (lambda d: cut_contaminated(d, benchmark), ("N_hit", "hit_spans")), (redact, ("spans", "base_spans")),
    ]
    for operator, names in cases:
        frame = _with(docs, *names)
        plain, found = operator(docs), operator(frame)
        assert found.columns == frame.columns
        assert bag(found.select(plain.columns)) == bag(plain)
        for name in names:
            assert found.where(F.col(name) != F.concat(F.lit(name), F.col("doc_id").cast("string"))).count() == 0
