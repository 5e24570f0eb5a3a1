import re

from conftest import SF

from hitledger.llm import decontaminate
from hitledger.llm.decontaminate import contamination, cut_contaminated, drop_contaminated

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_brute_force(docs, items, window=10):
    tests = {}
    for item, text in items:
        own = words(text)
        n = min(window, len(own))
        for at in range(len(own) - n + 1 if own else 0):
            tests.setdefault(tuple(own[at:at + n]), set()).add(str(item))
    lengths = {len(w) for w in tests}
    out = []
    for doc, text in docs:
        own, hit, ids = words(text), set(), set()
        for n in lengths:
            for at in range(len(own) - n + 1):
                found = tests.get(tuple(own[at:at + n]))
                if found:
                    hit.update(range(at, at + n))
                    ids |= found
        out.append((doc, len(own), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.hit_items) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_sample_table(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = by_brute_force([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(contamination(docs, items)) == expected
    assert any(n for _, _, n, _ in expected)


DOCS = [
    (1, None), (2, ""), (3, "!!"), (4, "a b c d e f g h i j"), (5, "x A,b;C d-e f g h i j k l"), (6, "two words here"), (7, "two"),
    (8, "ÉA b " * 4000 + "a b c d e f g h i j"), (4, "a b c d e f g h i j"), (None, "Two\nWords"), (9, "straße é 1 2"), (10, "a b c d e f g h i"),
]
ITEMS = [(1, "a b c d e f g h i j k"), (2, "TWO words"), (3, None), (4, "..."), (5, "two words"), (12, "b c d e f g h i j k l"), (6, "é 1")]


def test_edges_and_repeats(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert found(contamination(docs, items)) == by_brute_force(DOCS, ITEMS)
    assert found(contamination(docs.limit(0), items)) == []
    assert {n for _, _, n, _ in found(contamination(docs, items.limit(0)))} == {0}


def test_benchmark_in_several_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 20)
    docs, items = frames(spark, DOCS, ITEMS)
    assert found(contamination(docs, items)) == by_brute_force(DOCS, ITEMS)


def test_removal(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    docs = docs.selectExpr("*", "doc_id as n", "text as item_id")
    clean = drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect())) == [1, 2, 3, 7, 10]
    texts = {r.doc_id: r.text for r in cut_contaminated(docs, items).collect()}
    assert texts[5] == "x " and texts[9] == "straße  2" and texts[10] == DOCS[-1][1] and texts[1] is None
