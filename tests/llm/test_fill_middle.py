import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF
from oracle import differences, duck

from hitledger.llm.fill_middle import POINTS, WORDS, SkipList, fill_in_middle, restored
from hitledger.llm.queries import op12_fill_in_middle
from hitledger.llm.queries_sql import SQL


def expected(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_sql(spark):
    got, want = op12_fill_in_middle(spark, SF).toPandas(), duck(SF).execute(SQL["op12_fill_in_middle"]).df()
    for name in ("prefix_chars", "middle_chars"):  # the two have different kinds of whole numbers with nulls
        got[name], want[name] = (frame[name].astype("Int64").astype(object) for frame in (got, want))
    assert differences(got, want) == ""
    assert (got.form == "psm").any() and (got.form == "spm").any() and (got.form == "plain").any()


def test_brute_force(spark):
    rng = random.Random(4)
    alphabet = ["a", "B ", "é", "😀", "中", "\n", "<", "P>", "<P", "́", "\x00", "<S>" if rng.random() < 0.1 else "z"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(300)]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [
        (900, None, 0), (901, "", 0), (902, "x<S>y", 0), (903, "<M>", 0), (904, "é😀" * 400_000, 0), (7, texts[7], 1), (905, "one", 0),
    ]
    # Extra columns with the names of results.
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumnsRenamed({"n": "form"})
    found = fill_in_middle(frame)
    got = found.withColumn("again", restored()).collect()
    assert len(got) == len(rows) and found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    text_of = {i: t for i, t, _ in rows}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, text_of[r.doc_id])
        assert r.again == (text_of[r.doc_id] or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_null_id_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "some text"), (None, None)], "doc_id long, text string")
    got = fill_in_middle(frame).withColumn("again", restored()).collect()
    assert sorted(r.again for r in got) == ["", "some text"]
    assert fill_in_middle(frame.limit(0)).collect() == []


@pytest.mark.parametrize("units", [POINTS, WORDS])
def test_skip_list(units):
    rng = np.random.default_rng(0)
    for trial in range(60):
        texts = ["".join(rng.choice(list("ab é€😀 \n"), rng.integers(0, 5000 if trial % 3 == 0 else 40))) for _ in range(5)]
        encoded = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(b) for b in encoded])])
        lanes = SkipList(np.frombuffer(b"".join(encoded), np.uint8), offsets, units)
        own = [list(t) if units == POINTS else re.findall(r"^[ \n]+[^ \n]*|[ \n]*[^ \n]+|[ \n]+$", t) for t in texts]
        assert lanes.counts.tolist() == [len(x) for x in own]
        for ranks in (np.array([rng.integers(0, len(x) + 1) for x in own]), np.array([len(x) for x in own])):
            points, places = lanes.find(ranks)
            assert points.tolist() == [len("".join(x[:k])) for x, k in zip(own, ranks)]
            assert places.tolist() == [len("".join(x[:k]).encode()) for x, k in zip(own, ranks)]
    assert len(lanes.lanes) >= 1


def test_lanes_carry_all_widths():
    data = np.frombuffer(("aé" * 20_000).encode(), np.uint8)
    lanes = SkipList(data, np.array([0, len(data)]))
    assert len(lanes.lanes) > 2
    for lane in lanes.lanes:
        assert (lane.units.sum(), lane.points.sum(), lane.bytes.sum()) == (40_000, 40_000, 60_000)
