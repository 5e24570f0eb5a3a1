import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF
from helpers import explained
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from hitledger.llm import token_output  # noqa: E402
from hitledger.llm.token_output import PieceEncoder, read_tokens, token_digest, write_tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = PieceEncoder(TOKENIZER)


def ids_of(texts):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    ids, bounds = ENCODER.encode(np.frombuffer(b"".join(data), np.uint8), offsets)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def direct(texts):
    return [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", [
    "", " ", "Hello, World!", "it's they'RE don't 'll", "a1b22c 333", "<|endoftext|> x<|startoftext|>", "ÀÉÎ été ×÷ a×b", "é J̌ ≠",
    "x y z\u0085w", "…... —***—", "́start", "中文 テスト", "a\x00b\x1cc", "ß ſ K İ Σας", "a" * 500, "😀a😀 b", "tab\tnew\nline\r\nend\x0b",
    "don’t <b>x</b>", "́ ̂a", "é́x",
])
def test_encodes_as_the_library_does(text):
    assert ids_of([text, "mid", text]) == direct([text, "mid", text])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n'<|>aBcÉé×1.-"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=5))
def test_encodes_any_text_as_the_library_does(texts):
    assert ids_of(texts) == direct(texts)


def test_forgets_and_learns_again(monkeypatch):
    texts = [f"word{i} other{i * 7}" for i in range(50)]
    monkeypatch.setattr(token_output, "CACHED_PIECES", 10)
    assert [ids_of([t])[0] for t in texts] == direct(texts)


def check(spark, docs, path, rows):
    write_tokens(docs, path, PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    digests = sorted(token_digest(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in digests] == [r[0] for r in order]
    start = 0
    for r in digests:
        texts = [t for i, t in rows if i == r.doc_id]
        sums = {}
        for t in texts:
            ids = [*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 1]
            sums[zlib.crc32(np.array(ids, "<u4").tobytes())] = len(ids)
        assert r.start == start and sums[r.ids_crc32] == r.n_tokens
        start += r.n_tokens


def test_sample_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(spark, docs, str(tmp_path / "ids"), [(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark, tmp_path):
    rows = [(3, None), (1, ""), (2, "a b"), (2, "a b"), (2, "c"), (None, "z"), (None, None), (-5, "word " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, part int, ids int")
    check(spark, docs, str(tmp_path / "ids"), rows)
    check(spark, docs.limit(0), str(tmp_path / "none"), [])


def test_selective_reads_and_layout(spark, tmp_path):
    path = str(tmp_path / "ids")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    write_tokens(docs, path, PATH)
    meta = explained(read_tokens(spark, path, ("doc_id", "n_tokens"), 10, 20))
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in meta and "GreaterThanOrEqual(doc_id,10)" in meta
    assert read_tokens(spark, path, ("doc_id",), 10, 20).count() == docs.where("doc_id between 10 and 20").count()
    for file in (tmp_path / "ids").glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
