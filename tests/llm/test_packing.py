import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sluice.llm import packing as P
from sluice.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference_ids(texts):
    exact = Tokenizer.from_file(PATH)
    return [[*exact.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def check_packing(rows, ids_of, size=1024):
    """Pieces cover the documents; sequences are gapless and within the size."""
    places, pieces = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, parts in pieces.items():
        ids = np.array(ids_of[doc], dtype="<u4")
        at = 0
        for k, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.length == size or k == 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def first_fit_decreasing(lengths, size=1024):
    room = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, r in enumerate(room) if r >= n), None)
        if k is None:
            room.append(size - n)
        else:
            room[k] -= n
    return len(room)


def test_encoder_is_the_tokenizer():
    texts = ["", "a", "Hello  world's\n\n é日本 \U0001f600 x", "<|endoftext|> and <|endoftext|>", " " * 50, "a" * 500]
    encode = P._encoder(PATH)
    assert [[*encode(t), 2] for t in texts] == reference_ids(texts)


def test_fullest_is_the_best_subset():
    rng = random.Random(4)
    for _ in range(200):
        room = rng.randrange(0, 40)
        counts = [0] + [rng.choice([0, 0, 1, 2, 5]) for _ in range(50)]
        sums = {0}
        for length, n in enumerate(counts):
            for _ in range(n):
                sums |= {s + length for s in sums if s + length <= room}
        found = P.fullest(counts, room)
        assert all(0 < k <= counts[length] for length, k in found)
        assert sum(length * k for length, k in found) == max(sums)


def test_packs_tightly(spark, docs_of):
    rng = random.Random(8)
    texts = ["word " * rng.choice([3, 3, 3, 40, 200, 500, 900, 1023, 1024, 3000]) for _ in range(300)]
    texts += [None, "", texts[0], "<|endoftext|>"]
    df = docs_of(list(enumerate(texts)))
    rows = P.pack(df, PATH).collect()
    ids = dict(enumerate(reference_ids(texts)))
    bins = check_packing(rows, ids)
    assert bins <= first_fit_decreasing([n for x in ids.values() for _, n in P.cut(len(x), 1024)])
    assert P.pack(df.where("false"), PATH).count() == 0
    with_ids = P.pack(df, PATH, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in with_ids)


def test_repeated_rows_and_null_ids(spark, docs_of):
    rows = P.pack(docs_of([(None, "a b"), (1, "x"), (1, "x"), (None, "a b")]), PATH).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    ids = dict(zip([d.doc_id for d in docs], reference_ids([d.text for d in docs])))
    bins = check_packing(QUERIES["op6_best_fit_packing"](spark, small).collect(), ids)
    assert bins <= -(-sum(map(len, ids.values())) // 1024) + 2
