import hashlib
import random

from sluice.llm.substring_dedup import substring_dedup
from sluice.llm.suffix_dedup import removed_repeats, suffix_array_dedup


def brute_bytes(texts, width):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(raw):
        for s in range(len(b) - width + 1):
            seen.setdefault(b[s:s + width], []).append((d, s))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, s in places:
                gone[d][s:s + width] = b"\1" * width
    out = []
    for b, g in zip(raw, gone):
        spans = sum(1 for k in range(len(g)) if g[k] and (k == 0 or not g[k - 1]))
        kept = bytes(x for x, y in zip(b, g) if not y)
        out.append((len(b), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(pairs, width):
    big = float("inf")
    words = [(big if i is None else i, (t or "").encode().split()) for i, t in pairs]
    least = {}
    for i, w in words:
        for s in range(len(w) - width + 1):
            key = tuple(w[s:s + width])
            least[key] = min(least.get(key, big), i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - width + 1):
            if least[tuple(w[s:s + width])] < i:
                gone.update(range(s, s + width))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    alphabet = ["a", "b", "é", "日", " ", "\n", "xyz "]
    say = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [say(rng.randrange(30, 200)) for _ in range(5)]
    texts = [None, "", "a" * 300, "é" * 90, "x"]
    while len(texts) < n:
        t = say(rng.randrange(0, 150))
        for _ in range(rng.randrange(3)):
            p, part = rng.choice(shared), 0
            part = rng.randrange(len(p))
            at = rng.randrange(len(t) + 1)
            t = t[:at] + p[part:] + t[at:]
        texts.append(t)
    texts += rng.sample(texts, 6)
    return texts


def test_bytes_like_brute_force(spark, docs_of):
    for seed, width in ((1, 20), (2, 7), (3, 33)):
        texts = corpus(seed)
        df = docs_of(list(enumerate(texts)))
        got = removed_repeats(df, threshold=width, chunk_bytes=2000).selectExpr(
            "id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) s").collect()
        got = [tuple(r)[1:] for r in sorted(got)]
        assert got == brute_bytes(texts, width), (seed, width)


def test_words_like_brute_force(spark, docs_of):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c d", "é", " "]
    for width in (3, 4, 13):
        pairs = []
        for k in range(80):
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 40))]
            pairs.append((rng.choice([k, k, k, 7, None]), rng.choice([" ", "\t", "\n "]).join(words)))
        pairs += [(500, pairs[3][1]), (501, pairs[3][1]), (None, None), (502, "")]
        df = docs_of(pairs)
        got = substring_dedup(df, window=width, chunk_bytes=500).selectExpr(
            "rest.chunk k", "n_words", "n_removed", "kept").collect()
        assert [tuple(r)[1:] for r in sorted(got)] == brute_words(pairs, width), width


def test_cut_documents_keep_their_columns(spark, docs_of):
    text = "éé" + "passage " * 40
    df = docs_of([(1, text + "one"), (2, "two" + text), (3, None), (None, "alone"), (3, None)])
    out = suffix_array_dedup(df, threshold=50)
    assert out.columns == df.columns and out.schema["text"].dataType == df.schema["text"].dataType
    rows = {r.chunk: r for r in out.collect()}
    assert len(rows) == 5 and rows[2].text is None and rows[3].text == "alone"
    assert rows[3].doc_id is None
    assert rows[0].text.endswith("one") and len(rows[0].text) < 10


def test_empty_table(spark, docs_of):
    empty = docs_of([(1, "x")]).where("false")
    assert removed_repeats(empty).count() == 0
    assert substring_dedup(empty).count() == 0
