import numpy as np
import pytest
from pyspark.sql import functions as F

from hitledger.llm.language_id import fold
from hitledger.llm.queries import op11_toxicity_cnn
from hitledger.llm.toxicity import BUCKETS, FILTERS, KEPT, WIDTHS, _best_threshold, _joined, _pool, bucket_counts, fit, raw_scores, toxicity, word_features

SF01 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "toxic")


@pytest.fixture(scope="module")
def model(docs, labels):
    return fit(docs, labels.where(fold("doc_id") != 2))


def test_held_out(docs, labels, model):
    held = labels.where(fold("doc_id") == 2).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity(docs, model).join(held, "doc_id").collect()
    positive, negative = ([r for r in found if r.label == y] for y in (1, 0))
    assert len(positive) > 80 and len(negative) > 500
    assert sum(r.score >= 0.3 for r in positive) / len(positive) > 0.9
    assert sum(r.score >= 0.3 for r in negative) / len(negative) < 0.02
    assert sum(r.toxic for r in positive) / len(positive) > 0.9 and sum(r.toxic for r in negative) / len(negative) < 0.02
    assert all(0 <= r.score <= 1 for r in found) and len(model["thresholds"]) >= 4


def test_rows_in_another_order_give_the_same(docs, labels):
    few = labels.where("doc_id < 900")
    one, two = fit(docs, few), fit(docs.repartition(5), few.union(few).repartition(3))
    assert all(np.array_equal(one[k], two[k]) for k in one if isinstance(one[k], np.ndarray))
    assert one["thresholds"] == two["thresholds"]


def test_edges(spark, model):
    long = "this is a longish text without insults and words " * 20_000
    rows = [(1, None, None), (2, "", "en"), (3, "12 !?", "xx"), (4, long, "en"), (5, long + " idiot moron scum trash", "en"), (None, "IDIOT!!! you Moron$$$ and scum", "en"), (7, "é" * 500, "fr"), (7, "é" * 500, "fr")]
    frame = spark.createDataFrame([(*r, 0.5, True) for r in rows], "doc_id long, text string, lang string, score double, toxic boolean")
    found = toxicity(frame, model)
    got = found.collect()
    assert found.columns == ["doc_id", "score", "threshold", "toxic"] and [r.doc_id for r in got] == [r[0] for r in rows]
    assert got[0].score == got[1].score == got[2].score and got[6] == got[7]
    assert got[2].threshold == model["threshold"] and got[1].threshold == model["thresholds"]["en"]
    assert got[4].score > 0.5 > got[3].score and got[5].score > 0.5  # words at the very end of a long text count
    assert toxicity(frame.limit(0), model).collect() == []


def test_nothing_to_learn(spark, model):
    frame = spark.createDataFrame([(1, "a b", "en", 1), (2, None, "en", 0), (3, "c", "en", None)], "doc_id long, text string, lang string, toxic int")
    assert fit(frame, frame) is None and fit(frame, frame.limit(0)) is None and fit(frame.limit(0), frame) is None
    assert {(r.score, r.toxic) for r in toxicity(frame, None).collect()} == {(0.0, False)}
    small = spark.createDataFrame([(i, "you idiot" if i % 2 else "fine words", None, i % 2) for i in range(12)], "doc_id long, text string, lang string, toxic int")
    scores = {r.doc_id % 2: r.score for r in toxicity(small, fit(small, small)).collect()}
    assert scores[1] > scores[0]


def test_scores_do_not_depend_on_the_batch(model):
    texts = [t.encode() for t in ("one two three", "", "you idiot", "ÀÉ x " * 50, "last moron")]
    together = raw_scores(model, *_joined(texts))
    assert np.allclose(together, [raw_scores(model, *_joined([t]))[0] for t in texts], atol=1e-5)


def test_pooling_keeps_the_greatest():
    rng = np.random.default_rng(1)
    out, bias = rng.normal(size=(50, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32)
    begin, sizes = np.array([0, 20, 20, 22]), np.array([20, 0, 2, 28])
    top, place = _pool(out, begin, sizes, bias)
    for i, (a, n) in enumerate(zip(begin, sizes)):
        want = np.zeros((KEPT, FILTERS))
        best = -np.sort(-out[a : a + n], 0)[:KEPT]
        want[: len(best)] = np.maximum(best, 0)
        assert np.allclose(top[i], want)
    assert len(WIDTHS) > 2 and (place[1] == -1).all()


def test_capitals_and_marks_do_not_matter():
    one, two = (word_features(*_joined([t.encode()]))[0] for t in ("Idiot$$$ ÉTÉ", "idiot été"))
    assert np.array_equal(one, two)


def test_threshold():
    assert _best_threshold(np.array([0.9, 0.8, 0.2]), np.array([1.0, 1, 0])) == 0.5
    assert _best_threshold(np.array([0.5, 0.5, 0.1]), np.array([1.0, 0, 0])) == 0.3
    assert _best_threshold(np.array([0.5]), np.array([1.0])) is None


def test_query(spark):
    got = op11_toxicity_cnn(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and (got.predicted == (got.score >= 0.3)).all()


def test_tasks_stay_small(model):
    """What the driver computed for training is not sent along with every task."""
    from pyspark import cloudpickle

    raw_scores(model, *_joined([b"some words " * 100_000]))
    assert len(cloudpickle.dumps(raw_scores)) < 200_000


LABELLED = "doc_id long, text string, lang string, toxic int"


def test_whole_texts_teach(spark):
    """The only word that tells is the last one of long texts."""
    long = "some words of no weight " * 500
    frame = spark.createDataFrame([(i, long + (" moron" if i % 2 else " house"), "en", i % 2) for i in range(24)], LABELLED)
    short = spark.createDataFrame([(1, "moron", "en"), (0, "house", "en")], "doc_id long, text string, lang string")
    scores = {r.doc_id: r.score for r in toxicity(short, fit(frame, frame)).collect()}
    assert scores[1] > 0.5 > scores[0]


def test_all_rows_teach(spark):
    """Words that are met in six rows only, of more rows than one task learns."""
    rows = [(i, f"{'xyzuvw'[i % 6]}{i // 36:05d}".translate(str.maketrans("0123456789", "abcdefghij")) + f" plain words {'bad' if i % 2 else 'good'}", "en", i % 2) for i in range(18_000)]
    frame = spark.createDataFrame(rows, LABELLED)
    learned = frame.repartition(6)
    met = bucket_counts(learned.select("text", "toxic"))
    features, first = word_features(*_joined([r[1].encode() for r in rows]))
    want = np.zeros((BUCKETS, 2), int)
    for a, b, r in zip(first[:-1], first[1:], rows):
        want[np.unique(features[a:b]), r[3]] += 1
    assert np.array_equal(met, want)
    model = fit(learned, frame)
    scores = {y: [r.score for r in toxicity(frame.where(F.col("toxic") == y), model).collect()] for y in (0, 1)}
    assert min(scores[1]) > 0.5 > max(scores[0])
    # Only words of three rows and more have a vector.
    words = word_features(*_joined([b" ".join(r[1].split()[0].encode() for r in rows)]))[0][:, 0]
    assert (model["e"][words].any(1)).mean() > 0.9


def test_rounds_of_many_tasks(spark, docs, labels, monkeypatch):
    monkeypatch.setattr("hitledger.llm.toxicity.ALONE_ROWS", 500)
    model = fit(docs, labels.where(fold("doc_id") != 2))
    found = toxicity(docs, model).join(labels.where(fold("doc_id") == 2).select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    positive, negative = ([r.score for r in found if r.label == y] for y in (1, 0))
    assert np.mean(np.array(positive) >= 0.3) > 0.9 and np.mean(np.array(negative) >= 0.3) < 0.02
