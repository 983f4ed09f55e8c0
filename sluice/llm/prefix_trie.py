"""The trie of conversation prefixes, built by van Emde Boas recursion."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialise, parts_for, quoted

#: A word, for the tokens a shared prefix saves.
WORD = r"[^\x20\x09-\x0D]+"
#: Conversation ids whose digits are joined before they travel: those alike above so many bits.
CHUNK_BITS = 12
#: Turns in one row; the recursion below this height needs no shuffle.  A power of two.
BLOCK = 16
#: The name of the empty prefix.
ROOT = bytearray(16)
#: Turns per task of the sort.
SORTED = 500_000


def _digest(*parts: Column) -> Column:
    """Names equal content equally: 128 bits of SHA-256, of parts whose borders are told apart."""
    sized = [x for p in parts for x in (F.octet_length(p).cast("string"), F.lit(":"), p)]
    return F.substring(F.unhex(F.sha2(F.concat(*[x.cast("binary") for x in sized]), 256)), 1, 16)


def _same_width(*parts: Column) -> Column:
    """The same for parts that are names themselves."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def ordered_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, pos, sym, words``: digests of the turns, numbered within their conversation.

    Sorted as a whole, so a conversation of any length is spread over tasks; a
    task's rows of it are counted, and what the tasks before hold is added.
    """
    role, text = (F.coalesce(quoted(c), F.lit("")) for c in (role_col, text_col))
    digests = turns.where(quoted(conv_col).isNotNull()).select(
        quoted(conv_col).cast("long").alias("conv_id"), quoted(turn_col).alias("turn"),
        _digest(role, text).alias("sym"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    digests = materialise(digests, "turns")
    tasks = max(parts_for(digests.count(), SORTED), 1)
    nth = F.monotonically_increasing_id()
    rows = materialise(digests.repartitionByRange(tasks, "conv_id", F.asc_nulls_first("turn"), "sym")
                       .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "sym")
                       .select("conv_id", "sym", "words", nth.alias("nth"), F.spark_partition_id().alias("task")),
                       "sorted")
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shares = rows.groupBy("conv_id", "task").agg(F.min("nth").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "conv_id", "task", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return rows.join(shares, ["conv_id", "task"]).select(
        "conv_id", (F.col("nth") - F.col("first") + F.col("shift")).cast("int").alias("pos"), "sym", "words")


def borrow_prefixes(rows: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: ``conv_id, len, pos, sym, words``, and ``conv_id, len`` of all, turnless ones too.

    Conversation c starts with the first h turns of conversation c - c % every,
    h = crc32(decimal c) % most, and goes on with its own after its first h.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("n")).select(
        "conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    heads = rows.where((F.col("conv_id") % every == 0) & (F.col("pos") < most - 1)).select(
        F.col("conv_id").alias("base"), "pos", "sym", "words")
    known = sizes.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = materialise(sizes.join(known, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "rebuilt")
    borrowed = convs.join(heads, "base").where("pos < taken").select("conv_id", "len", "pos", "sym", "words")
    own = rows.join(convs, "conv_id").where("pos >= h").select(
        "conv_id", "len", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "sym", "words")
    return borrowed.unionByName(own), convs.select("conv_id", "len")


def cut_names(blocks: DataFrame, convs: DataFrame, levels: int) -> DataFrame:
    """``conv_id, nth, name`` of every prefix of whole blocks, the empty one included.

    At the top the whole depth is cut in half: prefixes up to the cut are named,
    and what is left of each sequence hangs under its prefix's name.  The upper
    trie and the lower forests are then pieces of half the height, all of which
    are cut together in the next round.  The part between a piece's root and its
    cut is named beforehand, from the names of its own halves.
    """
    parts = [blocks]
    for _ in range(1, levels):
        pairs = parts[-1].groupBy("conv_id", F.shiftright("nth", 1).alias("nth")).agg(
            F.max(F.when(F.col("nth") % 2 == 0, F.col("part"))).alias("left"),
            F.max(F.when(F.col("nth") % 2 == 1, F.col("part"))).alias("right"))
        parts.append(materialise(pairs.where("left IS NOT NULL AND right IS NOT NULL").select(
            "conv_id", "nth", _same_width(F.col("left"), F.col("right")).alias("part")), "parts"))
    named = convs.select("conv_id", F.lit(0).alias("nth"), F.lit(ROOT).alias("name"))
    for level in reversed(range(levels)):
        half = 1 << level
        part = parts[level].where("nth % 2 = 0").select("conv_id", (F.col("nth") * half).alias("nth"), "part")
        cuts = named.join(part, ["conv_id", "nth"]).select(
            "conv_id", (F.col("nth") + half).alias("nth"), _same_width(F.col("name"), F.col("part")).alias("name"))
        named = materialise(named.unionByName(cuts), "cuts")
    return named


def _join(a: bytes, b: bytes) -> bytes:
    return hashlib.sha256(a + b).digest()[:16]


def block_names(root: bytes, syms: list[bytes]) -> list[bytes]:
    """Names of the prefixes that end within a block of at most ``BLOCK`` turns; the recursion's last four cuts."""
    n, parts = len(syms), [syms]
    while len(parts[-1]) > 1:
        few = parts[-1]
        parts.append([_join(few[i], few[i + 1]) for i in range(0, len(few) - 1, 2)])
    names = [root] + [b""] * n
    for level in reversed(range(BLOCK.bit_length() - 1)):
        half = 1 << level
        for at in range(0, n - half + 1, 2 * half):
            names[at + half] = _join(names[at], parts[level][at >> level])
    return names


STEPS = "conv_id long, depth int, name binary, parent binary, words long, last boolean, above array<binary>"


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation and turn: its prefix's name and those above it in its block."""
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.list_(pa.binary())]
    names = [c.split()[0] for c in STEPS.split(", ")]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for conv, nth, size, root, following, turns in zip(*(batch[c].to_pylist() for c in (
                "conv_id", "nth", "len", "root", "following", "turns"))):
            found = block_names(root, [t["sym"] for t in turns])
            if len(turns) == BLOCK:
                found[BLOCK] = following
            for i, t in enumerate(turns, 1):
                depth = nth * BLOCK + i
                for column, value in zip(out, (conv, depth, found[i], found[i - 1], t["words"], depth == size,
                                               found[:i] if i < BLOCK else [])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)


def prefix_steps(rows: DataFrame, convs: DataFrame, longest: int) -> DataFrame:
    """``STEPS`` of all sequences, depth 0 included."""
    blocks = materialise(rows.groupBy("conv_id", F.shiftright("pos", BLOCK.bit_length() - 1).alias("nth")).agg(
        F.max("len").alias("len"), F.sort_array(F.collect_list(F.struct("pos", "sym", "words"))).alias("turns")),
        "blocks")
    levels = (longest // BLOCK).bit_length()
    if levels:
        whole = blocks.where(F.size("turns") == BLOCK).select("conv_id", "nth", _same_width(
            *[F.col("turns")[i]["sym"] for i in range(BLOCK)]).alias("part"))
        cuts = cut_names(materialise(whole, "parts"), convs, levels)
        blocks = blocks.join(cuts.withColumnRenamed("name", "root"), ["conv_id", "nth"]).join(
            cuts.select("conv_id", (F.col("nth") - 1).alias("nth"), F.col("name").alias("following")),
            ["conv_id", "nth"], "left")
    else:  # no sequence fills a block
        blocks = blocks.withColumn("root", F.lit(ROOT)).withColumn("following", F.lit(None).cast("binary"))
    top = convs.selectExpr("conv_id", "0 AS depth", "CAST(NULL AS BINARY) AS parent", "CAST(0 AS BIGINT) AS words",
                           "len = 0 AS last", "CAST(array() AS ARRAY<BINARY>) AS above").withColumn("name", F.lit(ROOT))
    return blocks.select("conv_id", "nth", "len", "root", "following", F.transform(
        "turns", lambda t: F.struct(t["sym"].alias("sym"), t["words"].alias("words"))).alias("turns")).mapInArrow(
            _steps, STEPS).unionByName(top)


def _members_digest(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each node, from rows sorted by node and chunk; one digest is held."""
    now, state, out = None, None, []
    for batch in chunks:
        for name, ids in zip(*(batch[c].to_pylist() for c in ("name", "ids"))):
            if now != name:
                if state:
                    out.append((now, state.hexdigest()))
                now, state = name, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(out) >= 10_000:
            yield _digests(out)
            out = []
    if state:
        out.append((now, state.hexdigest()))
    yield _digests(out)


def _digests(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string()))], names=["name", "ends_sha256"])


def _ends(steps: DataFrame) -> DataFrame:
    """Digests of the ids that end at a node.

    Ids are joined within chunks of neighbouring ids first.  The digest of a node
    has to read its ids in order, so its chunks go through one task, as a stream.
    """
    chunks = steps.where("last").groupBy("name", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    return (chunks.repartition("name").sortWithinPartitions("name", "chunk")
            .select("name", "ids").mapInArrow(_members_digest, "name binary, ends_sha256 string"))


def _grafted(totals: DataFrame, pushed: DataFrame) -> DataFrame:
    """Totals of nodes, more by what is pushed to them by name."""
    more = pushed.groupBy("name").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    return materialise(totals.join(more, "name", "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))}).drop(
            "more_leaves", "more_saved"), "grafted")


def graft_totals(nodes: DataFrame, steps: DataFrame, longest: int) -> DataFrame:
    """``n_leaves`` and ``saved_tokens`` of nodes, their own at first, summed over whole subtrees.

    Within blocks every node adds to those above it.  Then a round doubles the
    height of the pieces in which totals are complete: the total of each cut
    node, which stands for a lower forest's tree, is added to the nodes of the
    upper trie above it, all pieces at once.
    """
    totals = _grafted(nodes, nodes.select(F.explode("above").alias("name"), "n_leaves", "saved_tokens")).drop("above")
    for level in range((longest // BLOCK).bit_length()):
        half = BLOCK << level
        cuts = totals.where((F.col("depth") % (2 * half) == half) & ((F.col("n_leaves") > 0) | (F.col("saved_tokens") > 0)))
        above = cuts.select("conv_id", F.explode(F.sequence(F.col("depth") - half, F.col("depth") - 1)).alias("depth"),
                            "n_leaves", "saved_tokens")
        totals = _grafted(totals, steps.select("conv_id", "depth", "name").join(above, ["conv_id", "depth"]))
    return totals


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie over sequences ``conv_id, len, pos, sym, words``; ``convs`` has ``conv_id, len`` of all.

    Per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    A node is named by its content, so two sequences share a node only where
    their prefixes are equal (128-bit digests).  Every grouping on a node is
    reduced per task first; what joins on a node has one row per node on the
    other side.  No sequence is held in one task: blocks of ``BLOCK`` turns are.
    """
    longest = convs.agg(F.max("len")).first()[0] or 0
    steps = materialise(prefix_steps(rows, convs, longest), "steps")
    nodes = materialise(steps.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"), F.first("words").alias("words"), F.first("above").alias("above")), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    counted = materialise(nodes.join(children, "name", "left").join(parents, "parent", "left").select(
        "name", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"), "above"), "counted")
    none = hashlib.sha256(b"").hexdigest()
    return graft_totals(counted, steps, longest).join(_ends(steps), "name", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", every: int = 20, most: int = 4) -> DataFrame:
    """The prefix trie of conversations that borrow their first turns, see :func:`borrow_prefixes`.

    Turns are ordered by ``turn`` (null first), ties by content; repeated rows
    are turns of their own.  A null role or text is an empty one.  Rows without
    a ``conv_id`` belong to no conversation.  Other columns are not read,
    whatever they are called.  Texts of any length travel as digests.  An empty
    table gives no rows, as the root has no smallest member then.
    """
    return prefix_trie(*borrow_prefixes(
        materialise(ordered_turns(turns, conv_col, turn_col, role_col, text_col), "ordered"), every, most))
