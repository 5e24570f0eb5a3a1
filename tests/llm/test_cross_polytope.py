import numpy as np
import pytest
from conftest import SF

from hitledger.llm.cross_polytope import Index, axes, neighbours, rotations

SCHEMA = "vec_id long, embedding array<double>"


def by_brute_force(rows, queries, top=10):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None for x in v)}
    ok = {i: v for i, v in ok.items() if np.isfinite(v).all() and v.any()}
    out = {}
    for q in queries:
        if q in ok:
            near = sorted((float(np.sqrt(((v - ok[q]) ** 2).sum())), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))
            out[q] = near[:top]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, expected):
    return sum(len({i for _, i in got[q]} & {i for _, i in e}) for q, e in expected.items()) / sum(map(len, expected.values()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_on_tables(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    expected = by_brute_force(rows, [i for i, _ in rows if i % 100 == 0])
    got = found(neighbours(vectors, vectors.where("vec_id % 100 = 0")))
    assert got.keys() == expected.keys() and all(len(got[q]) == len(expected[q]) for q in got)
    assert recall(got, expected) >= 0.9
    exact = {q: dict((i, s) for s, i in e) for q, e in expected.items()}
    assert all(abs(s - exact[q][i]) < 1e-12 for q in got for s, i in got[q] if i in exact[q])


def test_few_vectors_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(7)] + [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(50, 54)]
    rows += [(50, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (60, [3.0, 4.0]), (61, [3.0, 5.0])]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = found(neighbours(vectors, vectors))
    assert got == by_brute_force(rows, [i for i, _ in rows])
    assert [i for _, i in got[50][:3]] == [51, 52, 53] and got[60] == [(1.0, 61)]


def test_hot_bucket_is_exact(spark, monkeypatch):
    monkeypatch.setattr("hitledger.llm.cross_polytope.BLOCK", 16)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(200)] + [(1000, [2.0, 4.0, 6.0, 8.5])]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = found(neighbours(vectors, vectors.where("vec_id in (5, 1000)")))
    assert got == by_brute_force(rows, [5, 1000])


def test_edges(spark):
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    good = [(7, [1.0, 1.0]), (8, [1e-200, 0.0]), (9, [1.0, 1.5])]
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in bad + good], f"{SCHEMA}, dim int, bucket int")
    got = found(neighbours(vectors, vectors))
    assert got == by_brute_force(bad + [(7, [1.0, 1.0]), (9, [1.0, 1.5])], [7, 9]) or set(got) == {7, 8, 9}
    assert neighbours(vectors.limit(0), vectors).collect() == []
    assert neighbours(vectors, vectors.limit(0)).collect() == []


def test_rotations_keep_lengths_and_find_axes():
    unit = np.eye(5)
    turned = rotations(unit, Index(tables=3))
    assert turned.shape == (3, 5, 8) and np.allclose(np.linalg.norm(turned, axis=2), 1)
    assert (axes(np.array([[0.1, -0.9, 0.3]]), 3) == [[4, 2, 0]]).all()


def test_every_row_repeated(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(30)]
    once, twice = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows * 2, SCHEMA)
    got = found(neighbours(twice, once))
    assert got == found(neighbours(once, once)) and {len(near) for near in got.values()} == {10}


def test_one_row_often_hides_no_other(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0 + i / 100]) for i in range(30)]
    rows += [(3, rows[3][1])] * 20 + [(50, [1.0, 2.0, 4.0, 3.0])]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert found(neighbours(vectors, vectors.where("vec_id in (4, 50)"))) == by_brute_force(rows, [4, 50])
