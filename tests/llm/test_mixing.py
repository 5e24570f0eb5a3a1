import random
import re
from collections import Counter

import pytest
from conftest import SF

from hitledger.llm.mixing import Mix, copies, mix_documents, targets


def expected_targets(sizes, mix):
    """By resharing the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    left, open_, out = mix.share * sum(sizes.values()), set(order), {}
    while True:
        level = left / (sum(weight[s] for s in open_) or 1)
        full = {s for s in open_ if level * weight[s] > mix.most * sizes[s]}
        for s in full:
            out[s] = mix.most * sizes[s]
            left -= out[s]
        open_ -= full
        if not full:
            return out | {s: level * weight[s] for s in open_}


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 50}, {None: 5, "": 7, "é": 9, "z": 0, "A": 1000}, {"x": 0}, {"one": 3}])
def test_targets(spark, sizes):
    got = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), Mix()).collect()
    assert {r.source: r.target for r in got} == pytest.approx(expected_targets(sizes, Mix()))


def test_sample_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    got = copies(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in got:
        n = words(rows[r.doc_id].text)
        assert r.size == n and r.taken == r.copies * n and 0 <= r.copies <= 2
        sizes[r.source] += n
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], n)
    assert {r.source: r.target for r in got} == pytest.approx(expected_targets(sizes, Mix()))
    assert all(r.source_size == sizes[r.source] for r in got)
    for r in got:
        assert abs(taken[r.source] - r.target) <= largest[r.source]
    assert sorted(map(tuple, got)) == sorted(map(tuple, copies(docs.repartition(7)).collect()))


@pytest.fixture(scope="module")
def many(spark):
    """One source with most rows and a few long texts, more than two levels of blocks."""
    rng = random.Random(3)
    rows = []
    for i in range(9000):
        n = rng.choice([1, 2, 3, 5, 8, 13]) if i % 100 else rng.randrange(50, 900)
        rows.append((i, "w " * n, "hot" if i % 3 else f"s{i % 5}"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string").cache()


def test_close_to_targets_over_levels(many):
    got = copies(many).collect()
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    for r in got:
        assert abs(taken[r.source] - r.target) <= max(0.01 * r.source_size, 3)


def test_no_document_is_favoured(many):
    """Over seeds, a document is taken as often as its source's ratio says."""
    total, ratio, runs = Counter(), {}, 6
    for seed in range(runs):
        for r in copies(many, Mix(seed=1000 * seed)).collect():
            total[r.source, r.size < 50] += r.copies
            ratio[r.source] = r.target / r.source_size
    n = Counter((r.source, words(r.text) < 50) for r in many.collect())
    for key, copies_ in total.items():
        assert abs(copies_ / (runs * n[key]) - ratio[key[0]]) < 0.12


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (4, "x", None), (4, "x", None), (None, "p q r", "b"), (5, "w " * 30_000, "b"), (6, "u", "")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, copies int")
    got = copies(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(r.taken <= 2 * r.size for r in got)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in got:
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +want
    assert copies(docs.limit(0)).collect() == [] and mix_documents(docs.limit(0)).collect() == []


def test_stays_in_the_engine(many):
    plan = copies(many)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
