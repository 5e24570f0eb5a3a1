import random

import pytest
from conftest import SF

from hitledger.llm.near_dup import Shingles, drop_near_duplicates, near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text, words):
    own = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ")
    own = [w for part in own for w in __import__("re").split("[\x09-\x0d]", part) if w]
    if not own:
        return frozenset()
    return frozenset(tuple(own[i:i + words]) for i in range(max(1, len(own) - words + 1)))


def by_brute_force(rows, words=4, percent=80):
    """rows: (doc_id, text) with distinct ids."""
    sets = {i: shingle_set(t, words) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()))


def test_sample_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = by_brute_force(rows)
    assert found(near_duplicates(docs, Shingles(4, 80))) == expected
    assert any(i != c for i, _, c, _ in expected)


def test_large_group_of_near_copies(spark):
    """A bucket beyond SMALL: chains that no hub reaches, and shared passages that are no copies."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(9000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(0, 6)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(9000)}"
        rows.append((i, " ".join(own)))
    drift = list(base)
    for i in range(60):
        drift[(i * 2) % 120] = f"y{i}"
        rows.append((1000 + i, " ".join(drift)))
    for i in range(60):
        rows.append((2000 + i, " ".join(base[:30] + [f"z{i}-{k}" for k in range(20)])))
    rows += [(5000 + i, rows[3][1]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(docs, Shingles(4, 80))) == by_brute_force(rows)


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three four"), (7, "one  two\nthree four"),
        (8, long), (9, long + " more"), (10, "ÉCOLE a b c d"), (11, "école a b c d"),
    ]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert found(near_duplicates(docs, Shingles(4, 80))) == by_brute_force(rows)
    assert found(near_duplicates(docs.limit(0))) == []


def test_extra_columns_repeats_and_missing_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e"), (None, "a b c d e"), (None, "p q r s t"), (None, None), (3, None)]
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, node int, k1 string")
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=repr)
    assert got == sorted([
        (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 1, 1, False), (None, 1, None, True),
        (None, 0, None, True), (3, 0, 3, True),
    ], key=repr)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [
        (0, ""), (0, "a b c d e"), (0, "p q r s t"), (1, "a b c d e"), (3, ""),
    ]


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_sketch_bound_grows_with_distance(percent):
    assert 0 < Shingles(percent=percent).most_bits < 256
