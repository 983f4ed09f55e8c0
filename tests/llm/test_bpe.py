import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import bpe
from sluice.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
EXACT = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER, DECODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN), bpe.Decoder(RANKS)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_like_the_library(text):
    ids = ENCODER.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == EXACT.encode_ordinary(text)
    assert DECODER.decode(ids) == text.encode()


def test_long_pieces():
    for text in ("a" * 5000, "ab" * 3000, "日本語" * 800, "!?" * 2000, " " * 3000, "the" * 1000, "<|endoftext|>"):
        assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == EXACT.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(), max_size=80))
def test_side_by_side(texts):
    """Pieces merged as rows of one array get the ids they get alone, at any row and slice size."""
    pieces = [t.encode() for t in texts]
    alone = [np.array(bpe.merge(p, RANKS), dtype="<u4").tobytes() if p else b"" for p in pieces]
    least, leaves = bpe.SIDE_BY_SIDE, bpe.LEAVES
    try:
        for bpe.SIDE_BY_SIDE, bpe.LEAVES in ((0, 1 << 19), (0, 16), (5, 64), (10 ** 9, 1 << 19)):
            assert ENCODER.merger.merge_all(pieces) == alone
    finally:
        bpe.SIDE_BY_SIDE, bpe.LEAVES = least, leaves


def test_many_pieces_of_one_size():
    texts = [f"{'abcdefghij'[k % 10]}{k * 7919 % 10007:x}zq{k % 13}ü" for k in range(3000)]
    texts += ["the" * (20 + k % 7) for k in range(100)] + ["x" * k for k in range(300)]
    found = bpe.Encoder(RANKS, public_tokenizers.PATTERN).encode_all(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in found] == [EXACT.encode_ordinary(t) for t in texts]


def test_all_bytes_are_needed():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Merger({b"a": 0})


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "PART_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["aaaa", None, "", "b" * 50, "cc", "d" * 8, "ee"]})
    parts = [p.column("text").to_pylist() for p in bpe._slices(batch, "text")]
    assert parts == [["aaaa", None, ""], ["b" * 50], ["cc", "d" * 8], ["ee"]]
    assert list(bpe._slices(batch.slice(0, 0), "text")) == []


def test_query(spark, small):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op8_byte_bpe"](spark, small).collect():
        ids = EXACT.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_odd_rows(spark, docs_of):
    df = docs_of([(None, "x"), (1, None), (1, None), (2, "")])
    out = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert sorted((r.doc_id is None, r.n_tokens, bytes(r.bytes)) for r in out) == [
        (False, 0, b""), (False, 0, b""), (False, 0, b""), (True, 1, b"x")]
    both = bpe.encode(df.withColumn("ids", F.lit("clash")), PATH, public_tokenizers.PATTERN, decoded=True)
    assert both.columns == ["doc_id", "n_tokens", "ids", "bytes"]
    assert sorted(map(str, both.collect())) == sorted(map(str, out))
    assert bpe.encode(df.where("false"), PATH, public_tokenizers.PATTERN).count() == 0
