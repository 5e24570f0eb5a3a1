import re
from collections import Counter, defaultdict

from conftest import SF

from hitledger.llm.log_templates import Parse, drop_template_lines


def by_brute_force(rows, parse=Parse()):
    """rows: (doc_id, text) -> {doc_id: (text left, n_lines, n_dropped)}"""
    lines = []
    for doc, text in rows:
        for at, line in enumerate((text or "").split("\n") if text is not None else []):
            toks = tuple("*" if re.search("[0-9]", w) else w for w in re.split("[\x20\x09-\x0d]+", line) if w)
            if toks:
                lines.append((doc, at, (len(toks), toks[:parse.leading]), toks))
    docs_of, n_of = defaultdict(set), Counter()
    for doc, _, leaf, _ in lines:
        docs_of[leaf].add(doc)
        n_of[leaf] += 1
    seen = Counter((leaf, i, t) for _, _, leaf, toks in lines for i, t in enumerate(toks))
    tagged, holders = [], defaultdict(set)
    for doc, at, leaf, toks in lines:
        if len(docs_of[leaf]) < parse.min_docs:
            continue
        field = tuple(
            t if seen[leaf, i, t] >= parse.min_docs and seen[leaf, i, t] >= n_of[leaf] * parse.frequent else None for i, t in enumerate(toks)
        )
        if sum(t is not None for t in field) >= len(field) * parse.fixed:
            tagged.append((doc, at, (leaf, field)))
            holders[leaf, field].add(doc)
    gone = defaultdict(set)
    for doc, at, template in tagged:
        if len(holders[template]) >= parse.min_docs:
            gone[doc].add(at)
    out = {}
    for doc, text in rows:
        own = text.split("\n") if text is not None else []
        left = [line for at, line in enumerate(own) if at not in gone[doc]]
        out[doc] = ("\n".join(left) if text is not None else None, len(own), len(own) - len(left))
    return out


def found(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in df.collect()}


def test_sample_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    expected = by_brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert found(drop_template_lines(docs)) == expected
    assert any(n for _, _, n in expected.values())


def test_variable_fields_and_clean_lines(spark):
    rows = [(i, f"{chr(97 + i)}x Own text number here\nPosted by user{i} on day {i * 7} in city {'abcdefghij'[i % 10] * 3}\nonly {chr(97 + i)} untouched words") for i in range(20)]
    rows += [(100 + i, "All rights reserved to the authors of this page") for i in range(3)]
    got = found(drop_template_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == by_brute_force(rows)
    assert all("Posted" not in got[i][0] and "Own text" in got[i][0] for i in range(20))
    assert all(got[100 + i][2] == 0 for i in range(3))


def test_edges(spark):
    line = "same words in each of these documents"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, line), (5, f"{line}\n{line}"), (6, f" {line} "), (7, f"x\n{line}\n"), (8, "w " * 50_000 + f"\n{line}"), (9, "é\t1")]
    docs = spark.createDataFrame([(i, t, "k", 3) for i, t in rows], "doc_id long, text string, leaf string, at int")
    assert found(drop_template_lines(docs)) == by_brute_force(rows)
    assert drop_template_lines(docs).columns == [*docs.columns, "n_lines", "n_dropped"]
    assert drop_template_lines(docs.limit(0)).collect() == []
    repeated = spark.createDataFrame([*rows[3:8], rows[3], (None, line), (None, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in drop_template_lines(repeated).collect())
    assert got[4, ""] == 2 and got[None, line] == 1 and got[None, None] == 1


def test_crowded_leaf(spark):
    """Thirty fixed lines of one leaf, each in a few documents: none has a tenth of the leaf."""
    words = lambda k: " ".join(f"{chr(97 + k // 6)}{chr(97 + k % 6)}{c}" for c in "uvwxyz")
    line = lambda k, i: f"2024-01-{i + 10} 12:00:{i + 10} INFO {words(k)}"
    rows = [(100 * k + i, line(k, i)) for k in range(30) for i in range(5)] + [(9000 + i, line(31, i)) for i in range(3)]
    rows += [(9100, "\n".join(line(32, i) for i in range(6)))]
    got = found(drop_template_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(got[i] == (("", 1, 1) if i < 9000 else (text, text.count("\n") + 1, 0)) for i, text in rows)
