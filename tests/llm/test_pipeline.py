import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF

import corpus_pipeline
from hitledger.llm.queries import QUERIES
from hitledger.llm.queries_sql import SQL
from oracle import differences, duck
from test_decontaminate import by_brute_force as contaminated
from test_near_dup import by_brute_force as classes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, on the smallest table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        given, docs = docs, spark.read.parquet(path)
        out.append((name, given.collect(), docs.collect(), docs.columns))
    return {name: rest for name, *rest in out}


def test_stages(stages):
    assert list(stages) == ["language_id", "near_dedup", "decontaminate", "mix_sources", "token_output"]
    for name, (given, kept, columns) in stages.items():
        assert kept and (name == "token_output" or columns == COLUMNS)


def test_language_id_keeps_clean_documents(stages):
    given, kept, _ = stages["language_id"]
    assert {r.doc_id for r in kept} <= {r.doc_id for r in given}
    assert len(kept) > 0.95 * sum(any(map(str.isalpha, r.text or "")) for r in given)


def test_near_dedup(stages):
    given, kept, _ = stages["near_dedup"]
    expected = [i for i, _, _, keep in classes([(r.doc_id, r.text) for r in given], 5) if keep]
    assert sorted(r.doc_id for r in kept) == expected and len(kept) < len(given)


def test_decontaminate(spark, stages):
    given, kept, _ = stages["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = [i for i, _, hit, _ in contaminated([(r.doc_id, r.text) for r in given], items) if not hit]
    assert sorted(r.doc_id for r in kept) == sorted(expected)


def test_mix_and_tokens(stages):
    given, kept, _ = stages["mix_sources"]
    assert Counter(map(tuple, kept)).keys() <= {tuple(r) for r in given}
    assert max(Counter(map(tuple, kept)).values()) <= 2
    _, digests, _ = stages["token_output"]
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = Counter()
    for r in kept:
        ids = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        want[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in digests) == want
    ends = sorted((r.start, r.start + r.n_tokens, r.doc_id) for r in digests)
    assert ends[0][0] == 0 and all(a[1] == b[0] and a[2] <= b[2] for a, b in zip(ends, ends[1:]))


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        given = docs.limit(0)
        assert stage(spark, given, SF).collect() == []


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# test_fill_middle.py compares op12: pandas has two kinds of whole numbers with nulls.
@pytest.mark.parametrize("name", sorted(SQL.keys() - {"op12_fill_in_middle"}))
def test_query_against_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).df()) == ""


