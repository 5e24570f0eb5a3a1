import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from hitledger.llm import spill_count
from hitledger.llm.align import Aligner, Alignment, ByteSide, PieceSide
from hitledger.llm.queries import op13_spill_alignment
from hitledger.llm.spill_count import merged_all, packed, unpacked

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a", "the", " ", "  ", "\n", "\t", "é", "😀", " ", "　", "▁", "<s>", "<|endoftext|>", "'s", "'S", "12", "!!", "\x1c", "\x85", "日本",
    "und", "ing ", "The ", " of", "\r\n", " ", "don't", "\x00", "ﬁ", "́",
]


@pytest.fixture(scope="module")
def sides():
    return ByteSide(A_PATH), PieceSide(B_PATH)


def by_hand(sides, text):
    """Tokens of whole texts, groups and links by comparing all tokens of both sides."""
    if not text:
        return 0, 0, 0, "", []
    a, b = sides
    whole = (" " + text).encode()
    one, two = a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    if b"".join(a.bytes[i] for i in one) != whole or b"".join(b.bytes[i] for i in two) != whole:
        return 0, 0, 0, "", []
    ends = [np.cumsum([len(side.bytes[i]) for i in ids]).tolist() for side, ids in ((a, one), (b, two))]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i2, j2 = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append(",".join(map(str, one[i:i2])) + "|" + ",".join(map(str, two[j:j2])))
        i, j = i2, j2
    starts = [[0, *e[:-1]] for e in ends]
    links = [(x, y) for x, s, e in zip(one, starts[0], ends[0]) for y, s2, e2 in zip(two, starts[1], ends[1]) if s < e2 and s2 < e]
    return len(one), len(two), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def check(found, rows, sides):
    hand = [(doc_id, *by_hand(sides, text)) for doc_id, text in rows]
    counts = Counter(link for *_, links in hand for link in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = Counter(
        (doc_id, a, b, g, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for doc_id, a, b, g, digest, links in hand
    )
    got = found.texts().select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert Counter(map(tuple, got.collect())) == want
    pairs = {(r.a, r.b): (r.n, r.best) for r in found.pairs().collect()}
    assert pairs == {k: (n, n == highest[k[1]]) for k, n in counts.items()}


def rows_of(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return [(r.doc_id, r.text) for r in docs.where("length(text) < 1500").select("doc_id", "text").collect()]


def odd_rows(n=400):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(n)]
    return [*enumerate(texts), (5, texts[5]), (None, "the end"), (900, None), (901, ""), (902, " "), (903, "  x"), (904, "x  "), (905, " \n"), (906, "日" * 3000)]


@pytest.mark.parametrize("small", [False, True])
def test_by_hand(spark, sides, monkeypatch, small):
    if small:  # many runs, slices and rounds
        for name, value in (("RUN_RECORDS", 300), ("BLOCK", 16), ("SLICE_KEYS", 400), ("SLICE_RECORDS", 500), ("OPEN_RUNS", 3), ("TABLE_KEYS", 50)):
            monkeypatch.setattr(spill_count, name, value)
    rows = odd_rows(150) + rows_of(spark, "/root/testdata/sf0.001")[:60]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, radix int, task long").repartition(6)
    check(Alignment(frame, A_PATH, B_PATH), rows, sides)


def test_empty(spark):
    frame = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    for docs, n in ((frame, 2), (frame.limit(0), 0)):
        found = Alignment(docs, A_PATH, B_PATH)
        assert found.texts().count() == n and found.pairs().count() == 0


def test_chunks_give_the_tokens_of_whole_texts(sides):
    aligner = Aligner(*sides)
    for text in [t for _, t in odd_rows(1500) if t]:
        data = np.frombuffer(text.encode(), np.uint8)
        place, _ = aligner.chunks(data, np.array([0, len(data)]))
        n_a, n_b, n_groups, *_ = by_hand(sides, text)
        facts = aligner.facts[place]
        if (facts[:, 0] == 1).all():
            assert facts[:, 1:4].sum(0).tolist() == [n_a, n_b, n_groups], repr(text)
        else:
            assert n_a == 0, repr(text)


def test_cache_is_emptied(sides, monkeypatch):
    monkeypatch.setattr("hitledger.llm.align.CACHED_CHUNKS", 5)
    aligner = Aligner(*sides)
    for text in ("one two three four five six seven", "eight nine", "one nine"):
        data = np.frombuffer(text.encode(), np.uint8)
        place, _ = aligner.chunks(data, np.array([0, len(data)]))
        assert aligner.facts[place, 1:4].sum(0).tolist() == list(by_hand(sides, text)[:3])


def test_merge(monkeypatch):
    monkeypatch.setattr(spill_count, "BLOCK", 8)
    monkeypatch.setattr(spill_count, "OPEN_RUNS", 4)
    rng = np.random.default_rng(2)
    want, blobs = Counter(), []
    for _ in range(40):
        keys, counts = np.unique(rng.integers(0, 300, rng.integers(1, 100)), return_counts=True)
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        blobs.append(packed(keys.astype(np.int64), counts.astype(np.uint64), np.ones(len(keys), np.uint32)))
    keys, counts = map(np.concatenate, zip(*merged_all(blobs)))
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), counts.tolist())) == want
    assert list(merged_all([])) == [] and len(list(unpacked(blobs[0], "<i8", "<u8", "<u4"))) >= 1


def test_query(spark):
    got = op13_spill_alignment(spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and (got.n_links >= got.n_groups).all() and (got.n_best <= got.n_links).all()
