"""Cross-tokenizer alignment: where two tokenizers cut the same bytes, in Arrow."""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, quoted

#: Bytes of text, and texts, that are aligned at a time; a longer text goes alone.
BATCH_BYTES = 1 << 20
BATCH_DOCS = 1 << 15
#: Id pairs are dealt into so many buckets, by their number alone.
BUCKETS = 256
#: Distinct pairs and entries that one task looks up.
TASK_PAIRS = 500_000
TASK_ENTRIES = 1_000_000

PARTS = ("kind string, doc_id long, batch long, place int, n_a long, n_b long, n_groups long, "
         "n_links long, groups_sha256 string, bucket int, pairs array<long>, runs array<int>, "
         "docs array<int>, times array<int>")


@dataclass(frozen=True)
class Side:
    """One tokenizer: texts to ids, and the bytes of each id."""

    encode: object
    tokens: pa.LargeBinaryArray

    @property
    def size(self) -> int:
        return len(self.tokens)


def _byte_of() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked(content: dict, special: set[str]) -> bool:
    """Whether a file's ids are its merge order and its splitter the known one.

    Only then may a library that merges by id stand in for the tokenizers library.
    """
    model, splitter = content["model"], content.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not content.get("normalizer") and splitter.get("type") == "ByteLevel"
             and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                "ignore_merges", "byte_fallback")))
    if not plain:
        return False
    vocab = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocab.get("".join(m), -1) for m in merges]
    letters = _byte_of()
    return (all(a < b for a, b in zip(made, made[1:]))
            and set(made) == {i for t, i in vocab.items() if len(t) > 1 and t not in special}
            and set(letters) <= set(vocab) and max(vocab[c] for c in letters) < min(made, default=1 << 30))


def byte_level(path: str) -> Side:
    """A byte-level tokenizer file, special strings read as plain text."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    vocab, letters = content["model"]["vocab"], _byte_of()
    special = {t["content"] for t in content.get("added_tokens", ())}
    size = 1 + max([*vocab.values(), *(t["id"] for t in content.get("added_tokens", ()))])
    tokens = [b""] * size
    for token, i in vocab.items():
        if token not in special:
            tokens[i] = bytes(letters[c] for c in token)
    if _ranked(content, special):
        import public_tokenizers
        import tiktoken

        ranks = {tokens[i]: i for token, i in vocab.items() if token not in special}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})

        def encode(texts: list[str]) -> list[list[int]]:
            return [fast.encode_ordinary(t) for t in texts]
    else:
        exact = Tokenizer.from_file(path)
        exact.encode_special_tokens = True

        def encode(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in exact.encode_batch(texts, add_special_tokens=False)]

    return Side(encode, pa.array(tokens, pa.large_binary()))


def pieces(path: str) -> Side:
    """A piece model: the mark U+2581 is a space, ``<0xHH>`` a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece) if model.is_byte(i) else None
        tokens.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return Side(lambda texts: model.encode(texts, num_threads=1), pa.array(tokens, pa.large_binary()))


@functools.lru_cache(maxsize=2)
def _sides(first: str, second: str) -> tuple[Side, Side]:
    return byte_level(first), pieces(second)


@functools.lru_cache(maxsize=2)
def _spelled(n_a: int, n_b: int) -> pa.LargeStringArray:
    """Every id with what may follow it: ``,`` or ``|`` after A's, ``,`` ``;`` or nothing after B's."""
    return pa.array([f"{i}{s}" for i in range(n_a) for s in ",|"]
                    + [f"{i}{s}" for i in range(n_b) for s in (",", ";", "")], pa.large_string())


@dataclass
class Tokens:
    """The ids of several texts as one Arrow list, with what follows from their bytes."""

    lists: pa.LargeListArray
    side: Side

    def __post_init__(self):
        self.ids = pc.list_flatten(self.lists)
        self.doc = pc.list_parent_indices(self.lists)
        self.bytes = self.side.tokens.take(self.ids)
        # Sums of byte lengths run through the texts: a text's share ends where the next begins.
        self.ends = pc.cumulative_sum(pc.cast(pc.binary_length(self.bytes), pa.int64()))
        self.cuts = np.asarray(self.lists.offsets)

    def same_as(self, texts: list[bytes]) -> np.ndarray:
        """Whether the bytes of each text's tokens are the text."""
        data = memoryview(self.bytes.buffers()[2] or b"")
        at = np.concatenate([[0], np.asarray(self.ends)])[self.cuts]
        return np.array([b - a == len(t) and bytes(data[a:b]) == t for a, b, t in zip(at, at[1:], texts)], dtype=bool)


def _as_lists(ids: list[list[int]]) -> pa.LargeListArray:
    counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    flat = np.empty(int(counts.sum()), dtype=np.int64)
    at = 0
    for some in ids:
        flat[at:at + len(some)] = some
        at += len(some)
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), flat)


@dataclass(frozen=True)
class Aligned:
    """Per text: tokens, groups, links, a digest; and per link: text, ids."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    links: pa.Table


def align(texts: list[str | None], a_side: Side, b_side: Side, spell: bool = True) -> Aligned:
    """Tokens of both sides, their groups and links.

    Both sides' ends meet in a full outer hash join on the end, counted through
    all texts, so it names the text too.  Between two neighbouring ends of either
    side lies the overlap of exactly one token of A and one of B: each row of the
    join is a link, and a row with both sides present ends a group.
    """
    given = [(" " + t).encode() if t else None for t in texts]
    some = [i for i, t in enumerate(given) if t]
    ids_a = dict(zip(some, a_side.encode([" " + texts[i] for i in some])))
    ids_b = dict(zip(some, b_side.encode([texts[i] for i in some])))
    n = len(texts)
    while True:
        a = Tokens(_as_lists([ids_a.get(i, ()) for i in range(n)]), a_side)
        b = Tokens(_as_lists([ids_b.get(i, ()) for i in range(n)]), b_side)
        left = [given[i] if i in ids_a else b"" for i in range(n)]
        same = a.same_as(left) & b.same_as(left)
        if same.all():
            break
        for i in np.flatnonzero(~same).tolist():  # these have no tokens
            ids_a.pop(i)
            ids_b.pop(i)
    of_a = pa.table({"end": a.ends, "a": pa.array(np.arange(len(a.ids)))})
    of_b = pa.table({"end": b.ends, "b": pa.array(np.arange(len(b.ids)))})
    rows = of_a.join(of_b, "end", join_type="full outer", use_threads=False).sort_by("end")
    shared = pc.and_(pc.is_valid(rows["a"]), pc.is_valid(rows["b"]))
    link_a = pc.fill_null_backward(rows["a"]).combine_chunks()
    link_b = pc.fill_null_backward(rows["b"]).combine_chunks()
    last = rows.filter(shared)
    last_a, last_b = (last[c].to_numpy().astype(np.int64) for c in "ab")
    doc_a = np.asarray(a.doc)
    link_doc = a.doc.take(link_a)
    links = pa.table({"doc": link_doc, "a": a.ids.take(link_a), "b": b.ids.take(link_b)})
    digests = _digests(a, b, last_a, last_b) if spell else [""] * n
    return Aligned(np.diff(a.cuts), np.diff(b.cuts), np.bincount(doc_a[last_a], minlength=n),
                   np.bincount(np.asarray(link_doc), minlength=n), digests, links)


def _digests(a: Tokens, b: Tokens, last_a: np.ndarray, last_b: np.ndarray) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text; an empty text for one without tokens.

    All texts are spelled at once: a group's tokens of A stand before its tokens
    of B, and the spelled tokens lie next to each other in one buffer.
    """
    sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    place_a = np.arange(len(a.ids)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)
    place_b = np.arange(len(b.ids)) + np.repeat(np.cumsum(sizes_a), sizes_b)
    after_a = np.zeros(len(a.ids), dtype=np.int64)
    after_a[last_a] = 1
    after_b = np.zeros(len(b.ids), dtype=np.int64)
    after_b[last_b] = 1
    ends = b.cuts[1:][np.diff(b.cuts) > 0] - 1
    after_b[ends] = 2
    codes = np.empty(len(a.ids) + len(b.ids), dtype=np.int64)
    codes[place_a] = np.asarray(a.ids) * 2 + after_a
    codes[place_b] = a.side.size * 2 + np.asarray(b.ids) * 3 + after_b
    spelled = _spelled(a.side.size, b.side.size).take(pa.array(codes))
    offsets, data = spelled.buffers()[1:]
    if data is None:
        return [""] * (len(a.cuts) - 1)
    starts = np.frombuffer(offsets, dtype=np.int64)[a.cuts + b.cuts].tolist()
    data = memoryview(data)
    return [hashlib.sha256(data[s:e]).hexdigest() if e > s else "" for s, e in zip(starts, starts[1:])]


def _in_batches(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (held + size > BATCH_BYTES or i - start >= BATCH_DOCS):
            yield ids[start:i], texts[start:i]
            start, held = i, 0
        held += size
    if texts:
        yield ids[start:], texts[start:]


def _blocks(links: pa.Table, size_b: int) -> Iterator[tuple]:
    """Per bucket: its pairs, texts per pair, and those texts with how often they hold it."""
    pair = np.asarray(links["a"].combine_chunks()) * size_b + np.asarray(links["b"].combine_chunks())
    bits = BATCH_DOCS.bit_length()
    keyed = pa.table({"pair": pair, "doc": links["doc"]})
    keyed = pa.table({"key": (pair << bits) | np.asarray(keyed["doc"])})
    counted = keyed.group_by("key", use_threads=False).aggregate([([], "count_all")])
    key, times = counted["key"].to_numpy(), counted["count_all"].to_numpy()
    bucket = bucket_of(key >> bits)
    order = np.lexsort((key, bucket))
    key, times, bucket = key[order], times[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    for k in range(BUCKETS):
        some = slice(cuts[k], cuts[k + 1])
        if some.start == some.stop:
            continue
        pairs, runs = np.unique(key[some] >> bits, return_counts=True)
        yield k, pairs, runs, key[some] & ((1 << bits) - 1), times[some]


def bucket_of(pair: np.ndarray) -> np.ndarray:
    """Mixes all bits of the pair's number; a pair is always in the same bucket."""
    mixed = pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


def _parts(docs: DataFrame, first: str, second: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of kind ``doc``, one per text, and of kind ``block``, one per batch and bucket."""
    columns = [c.split() for c in PARTS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in columns])

    def rows(n: int, **values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(values[f.name], f.type) if f.name in values else pa.nulls(n, f.type) for f in schema],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(first, second)
        for batch in batches:
            given = list(zip(batch["rid"].to_pylist(), batch["id"].to_pylist()))
            for ids, texts in _in_batches(given, batch["text"].to_pylist()):
                found = align(texts, *sides)
                n, name = len(ids), ids[0][0]
                yield rows(n, kind=["doc"] * n, doc_id=[i for _, i in ids], batch=[name] * n, place=range(n),
                           n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups, n_links=found.n_links,
                           groups_sha256=found.digests)
                blocks = list(zip(*_blocks(found.links, sides[1].size)))
                if blocks:
                    bucket, pairs, runs, places, times = blocks
                    n = len(bucket)
                    yield rows(n, kind=["block"] * n, batch=[name] * n, bucket=bucket, pairs=pairs, runs=runs,
                               docs=places, times=times)

    return docs.select(F.monotonically_increasing_id().alias("rid"), quoted(id_col).cast("long").alias("id"),
                       quoted(text_col).alias("text")).mapInArrow(run, PARTS)


def _looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per batch: sums over the links of each of its texts, at the text's place."""
    def flat(table: pa.Table, name: str) -> np.ndarray:
        return pc.list_flatten(table[name]).to_numpy()

    known = pc.list_flatten(right["pairs"]).combine_chunks()
    n, best = flat(right, "n"), flat(right, "best")
    row_of = pc.index_in(pc.list_flatten(left["pairs"]), value_set=known).to_numpy()
    runs = flat(left, "runs")
    times = flat(left, "times").astype(np.int64)
    count = np.repeat(n[row_of], runs)
    entries = pa.table({
        "batch": np.repeat(left["batch"].to_numpy(), pc.list_value_length(left["docs"]).to_numpy()),
        "place": flat(left, "docs"), "n_best": times * np.repeat(best[row_of], runs),
        "count_sum": times * count})
    sums = entries.group_by(["batch", "place"], use_threads=False).aggregate(
        [("n_best", "sum"), ("count_sum", "sum")])
    return pa.table({"batch": sums["batch"], "place": pc.cast(sums["place"], pa.int32()),
                     "n_best": sums["n_best_sum"], "count_sum": sums["count_sum_sum"]})


def _lookup_task(_, left: pa.Table, right: pa.Table) -> pa.Table:
    return _looked_up(left, right)


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """``bucket, pair, n, best``: texts that hold a pair linked; whether it is its A id's highest count."""
    held = (blocks.select("bucket", F.explode(F.arrays_zip("pairs", "runs")).alias("x"))
            .groupBy("bucket", F.col("x.pairs").alias("pair")).agg(F.sum("x.runs").alias("n")))
    held = materialise(held, "pairs").withColumn("a", F.expr(f"pair DIV {size_b}"))
    top = held.groupBy("a").agg(F.max("n").alias("most"))
    return held.join(top, "a").select("bucket", "pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def align_tokenizers(docs: DataFrame, first: str, second: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """How a byte-level tokenizer (A) and a piece model (B) cut the same texts.

    ``first`` and ``second`` are their files.  A reads a space and the text; B
    adds that space itself.  Special strings are plain text.  Per text:
    ``doc_id, n_a, n_b`` (tokens), ``n_groups`` (between ends of both),
    ``n_links`` (tokens of A and B with a byte in common), ``n_best`` (links
    whose id pair no other pair of the same A id beats, counted in texts),
    ``count_sum`` (those counts, over links) and ``groups_sha256``.

    A null or empty text, and one that either side does not spell back byte by
    byte, has no tokens: zeros, and an empty digest.  Repeated rows are texts of
    their own and count each.  Other columns are not read, whatever they are
    called.  An empty table gives no rows.  A text is aligned in one task, and
    takes some 100 times its length in memory there.

    Texts are tokenised once, in batches bounded by bytes.  A batch sends its
    distinct pairs with the texts that hold them, a list per bucket of pairs.
    Their counts are summed by Spark; batches and counts of a bucket then meet
    in tasks that are bounded in both, so a pair that every text holds is spread
    over many.
    """
    a_side, b_side = _sides(first, second)
    parts = materialise(_parts(docs, first, second, id_col, text_col), "aligned", "kind")
    rows = parts.where("kind = 'doc'").select("doc_id", "batch", "place", "n_a", "n_b", "n_groups", "n_links",
                                              "groups_sha256")
    blocks = parts.where("kind = 'block'").select("batch", "bucket", "pairs", "runs", "docs", "times")
    counts = (pair_counts(blocks, b_side.size).groupBy("bucket")
              .agg(F.collect_list(F.struct("pair", "n", "best")).alias("x"))
              .select("bucket", *[F.col(f"x.{c}").alias(to) for c, to in
                                  (("pair", "pairs"), ("n", "n"), ("best", "best"))]))
    counts = materialise(counts, "counts")
    # A bucket has at most (ids of A) * (ids of B) / BUCKETS pairs, whatever the corpus.
    widths = {r.bucket: (r.pairs, r.entries) for r in counts.select("bucket", F.size("pairs").alias("pairs")).join(
        blocks.groupBy("bucket").agg(F.sum(F.size("docs").cast("long")).alias("entries")), "bucket").collect()}
    group, salts, room = {}, [], 0
    for bucket in sorted(widths):  # at most BUCKETS rows
        n, entries = widths[bucket]
        if not salts or room + n > TASK_PAIRS:
            salts.append(0)
            room = 0
        group[bucket], room = len(salts) - 1, room + n
        salts[-1] += entries
    salts = [-(-e // TASK_ENTRIES) for e in salts] or [1]
    groups = F.element_at(F.array(*[F.lit(group.get(b, 0)) for b in range(BUCKETS)]), F.col("bucket") + 1)
    width = F.element_at(F.array(*map(F.lit, salts)), F.col("group") + 1)
    left = blocks.withColumn("group", groups).withColumn(
        "salt", F.pmod(F.xxhash64("batch"), width).cast("int"))
    right = counts.withColumn("group", groups).withColumn("salt", F.explode(F.sequence(F.lit(0), width - 1)))
    sums = (left.groupBy("group", "salt").cogroup(right.groupBy("group", "salt"))
            .applyInArrow(_lookup_task, "batch long, place int, n_best long, count_sum long")
            .groupBy("batch", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    none = F.lit(0).cast("long")
    return rows.join(sums, ["batch", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
