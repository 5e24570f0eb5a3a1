import numpy as np
import pytest
from conftest import SF

from hitledger.llm.language_id import Lookup, WIDTHS, Network, DEPTH, FILTERS, N_SYMBOLS, _softmax, fit, fold, keep_known, languages, windows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").cache()


@pytest.fixture(scope="module")
def net(docs):
    return fit(docs.where(fold("doc_id") != 2))


def test_held_out_accuracy(docs, net):
    found = languages(docs.where(fold("doc_id") == 2), net).collect()
    assert len(found) > 200 and all(0 <= r.score <= 1 for r in found)
    known = [r for r in found if r.lang_pred != "und"]
    assert sum(r.lang_pred == r.lang for r in known) / len(known) > 0.95
    assert len(known) > 0.95 * len(found)


def test_same_rows_same_network(docs, net):
    again = fit(docs.where(fold("doc_id") != 2).repartition(5))
    assert again.languages == net.languages and np.array_equal(again.dense, net.dense)


def test_edges(spark, net):
    long = "the and of with hention thaner " * 6000
    rows = [(1, None), (2, ""), (3, " 12 !? "), (4, long), (5, "x"), (6, "中"), (7, "é" * 300), (7, "é" * 300)]
    frame = spark.createDataFrame([(i, t, "xx", 4) for i, t in rows], "doc_id long, text string, lang string, row int")
    got = languages(frame, net).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert all(r.lang_pred in net.languages and 0 < r.score <= 1 for r in got[3:])
    assert languages(frame.limit(0), net).collect() == []
    assert keep_known(frame, net).columns == frame.columns
    assert {1, 2, 3}.isdisjoint(r.doc_id for r in keep_known(frame, net).collect())


def test_without_labels(spark):
    none = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, " ", "de")], "doc_id long, text string, lang string")
    assert fit(none) is None and fit(none.limit(0)) is None
    assert [(r.lang_pred, r.score) for r in languages(none, None).collect()] == [("und", 0.0)] * 3


def test_one_language(spark):
    net = fit(spark.createDataFrame([(1, "only one", "en")], "doc_id long, text string, lang string"))
    assert net.languages == ["en"]


def test_tables_give_what_the_filters_give():
    rng = np.random.default_rng(0)
    net = Network(
        ["a", "b"], rng.normal(size=(N_SYMBOLS, DEPTH)), {w: rng.normal(size=(w * DEPTH, FILTERS)) for w in WIDTHS},
        {w: rng.normal(size=FILTERS) for w in WIDTHS}, rng.normal(size=(len(WIDTHS) * FILTERS, 2)), rng.normal(size=2),
    )
    data = np.frombuffer(b"Some text, of 2 windows" * 20, np.uint8)
    grid, row, held = windows(data, np.array([0, 100, 100, len(data)]))
    assert row.tolist() == [0, 2, 2] and held.tolist() == [100, 256, len(data) - 356]
    hidden = []
    for w in WIDTHS:
        emb = net.embedding[grid]
        out = np.stack([emb[:, i:i + w].reshape(len(grid), -1) @ net.filters[w] for i in range(grid.shape[1] - w + 1)], 1)
        hidden.append(np.maximum(out.max(1) + net.biases[w], 0))
    want = _softmax(np.concatenate(hidden, 1) @ net.dense + net.offset)
    assert np.allclose(Lookup(net).rate(grid), want, atol=1e-4)


def test_sample_table(spark, net):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert languages(docs, net).count() == docs.count()
