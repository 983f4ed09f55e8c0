import bisect
import collections
import hashlib
import itertools
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sluice.llm import alignment as A
from sluice.llm.queries import QUERIES

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def spans(ids, token):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(token[i])))
        at += len(token[i])
    return out


def grouped(cuts, *sides):
    out = [([], []) for _ in cuts]
    for k, some in enumerate(sides):
        for i, _, e in some:
            out[bisect.bisect_left(cuts, e)][k].append(str(i))
    return out


def brute(texts):
    """Every pair of tokens of a text, by byte ranges; ids from the libraries themselves."""
    exact = Tokenizer.from_file(FIRST)
    exact.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    letters = A._byte_of()
    bytes_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in exact.get_vocab().items()}
    bytes_b = {i: bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
               for i in range(32000) for p in [model.id_to_piece(i)]}
    found = []
    for t in texts:
        whole = (" " + (t or "")).encode()
        a = spans(exact.encode(" " + t, add_special_tokens=False).ids, bytes_a) if t else []
        b = spans(model.encode(t), bytes_b) if t else []
        if b"".join(bytes_a[i] for i, *_ in a) != whole or b"".join(bytes_b[i] for i, *_ in b) != whole:
            a = b = []
        links, j = [], 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            links += [(i, k) for k, x, y in itertools.takewhile(lambda p: p[1] < e, itertools.islice(b, j, None))]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [(",".join(x), ",".join(y)) for x, y in grouped(cuts, a, b)]
        found.append((len(a), len(b), len(cuts), links, ";".join(f"{x}|{y}" for x, y in groups)))
    count = collections.Counter(p for *_, links, _ in found for p in set(links))
    best = collections.defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(na, nb, ng, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(s.encode()).hexdigest() if s else "") for na, nb, ng, links, s in found]


ODD = [None, "", " ", "  two  blanks ", "a", "▁mark", "<|endoftext|> and </s> <0x41>", "naïve 日本語 🙂\n\ttab",
       "\x00nul", "a" * 700, "the " * 300, "é decomposed", "the cat", "the cat", "the dog"]


def rows(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


@pytest.mark.parametrize("entries, pairs", [(2_000_000, 500_000), (7, 3)])
def test_like_brute_force(spark, docs_of, monkeypatch, entries, pairs):
    monkeypatch.setattr(A, "TASK_ENTRIES", entries)
    monkeypatch.setattr(A, "TASK_PAIRS", pairs)
    rng = random.Random(3)
    letters = ["the", " of", "日", "é", " ", "\n", "42", "ing", "!", "🙂", "▁"]
    texts = ODD + ["".join(rng.choice(letters[:rng.choice([5, 11])]) for _ in range(rng.randrange(60))) for _ in range(60)]
    got = A.align_tokenizers(docs_of(list(enumerate(texts))), FIRST, SECOND)
    expected = brute(texts)
    assert [tuple(r[n] for n in NAMES) for r in got.orderBy("doc_id").collect()] == expected


def test_small_batches_change_nothing(spark, docs_of, monkeypatch):
    sides = A._sides(FIRST, SECOND)
    whole = A.align(ODD, *sides)
    single = [A.align([t], *sides) for t in ODD]
    assert whole.digests == [x for s in single for x in s.digests]
    assert whole.n_links.tolist() == [int(s.n_links[0]) for s in single]
    monkeypatch.setattr(A, "BATCH_BYTES", 10)
    assert [t for _, some in A._in_batches(ODD, ODD) for t in some] == ODD
    assert len(list(A._in_batches(ODD, ODD))) > 5


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op13_tokenizer_alignment"](spark, small).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [d.doc_id for d in docs]
    assert [tuple(r[n] for n in NAMES) for r in got] == brute([d.text for d in docs])


def test_odd_rows(spark, docs_of):
    df = docs_of([(None, "the cat"), (1, None), (1, None), (2, "")])
    out = A.align_tokenizers(df.withColumnRenamed("lang", "n_a").withColumnRenamed("source", "batch"), FIRST, SECOND)
    assert sorted((r.doc_id is None, r.n_a > 0, r.groups_sha256 == "") for r in out.collect()) == [
        (False, False, True)] * 3 + [(True, True, False)]
    assert A.align_tokenizers(df.where("false"), FIRST, SECOND).count() == 0


def test_other_files_are_read_by_their_own_library():
    import json
    with open(FIRST, encoding="utf-8") as f:
        content = json.load(f)
    special = {"<|endoftext|>"}
    assert A._ranked(content, special)
    assert not A._ranked({**content, "normalizer": {"type": "NFC"}}, special)
    model = dict(content["model"], merges=content["model"]["merges"][::-1])
    assert not A._ranked({**content, "model": model}, special)
