"""Line dedup: fuzzy lines by SimHash, pigeonhole blocks and edit similarity.

DataFrame operations only.
"""

from __future__ import annotations

import itertools
import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import (free_name, fresh_path, materialise, parts_for, quoted, text_bytes,
                               without_shuffles_left)
from sluice.llm.components import components

BITS = 64
#: SimHashes of two lines may differ in so many bits.
DISTANCE = 3
#: The bits are cut into BLOCKS blocks; lines meet where BLOCKS - DISTANCE of them agree.
BLOCKS = 5
#: Least edit similarity: 1 - edits / words of the longer line.
SIMILARITY = 0.8
#: Words whose bits are counted in lanes of 8 bits before they go into wider ones.
SHORT = 127
#: Numbers of 64 parities that are kept per line.
PARITIES = 4
MARKS = [f"p{j}" for j in range(PARITIES)]
#: Bytes of text per bucket of the working table.
BUCKET_BYTES = 8 << 20
#: Code points that stand for words in the edit distance, all planes above the first: two
#: different words are taken for equal with odds of one in 983,040.
_FIRST_SYMBOL, _SYMBOLS = 0x10000, 0xF0000


def normalised(line: Column) -> Column:
    """Small letters, digits as 0, one space for anything that is no letter or digit."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{N}+", "0"), r"[^\p{L}0]+", " "))


def _simhash(n: str = "n") -> Column:
    """Majority of each bit from the 32 columns ``s0, s1, ...`` that count two bits each.

    Counts are below 2^30, so one addition carries into bit 30 of both where they
    are over half of ``n``.  It stands in a lambda, as the code made for 32 sums
    and this together is a method too long for the JVM to compile.
    """
    def bits(short: Column) -> Column:
        over = [(F.col(f"s{j}") + short).bitwiseAND(F.lit(0x4000000040000000)) for j in range(32)]
        return reduce(lambda a, b: a.bitwiseOR(b), [
            F.shiftrightunsigned(o, 30 - j) if j <= 30 else F.shiftleft(o, j - 30) for j, o in enumerate(over)])

    lacks = F.lit((1 << 30) - 1) - F.shiftrightunsigned(n, 1)
    return F.transform(F.array((lacks * F.lit((1 << 32) + 1)).cast("long")), bits)[0]


def _lanes(h: Column) -> list[Column]:
    """How often each bit is set in at most ``SHORT`` hashes: 8 numbers of 8 counts each."""
    return [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(0x0101010101010101))).alias(f"t{j}") for j in range(8)]


def _pairs_of_bits() -> list[Column]:
    """The same for a line of any length: 32 numbers of two counts each."""
    return [F.sum(F.shiftrightunsigned(f"t{j % 8}", j - j % 8).bitwiseAND(F.lit(0x000000FF000000FF))).alias(f"s{j}")
            for j in range(32)]


def _parities(h: Column) -> list[Column]:
    """Whether a line has an odd number of words of each of 64 * ``PARITIES`` kinds."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    kind = F.pmod(F.shiftrightunsigned(h, 6), F.lit(PARITIES))
    return [F.bit_xor(F.when(kind == j, bit).otherwise(F.lit(0).cast("long"))).alias(f"p{j}") for j in range(PARITIES)]


def least_words(similarity: float) -> int:
    """Words of the shortest line that another can be similar to without being equal.

    One edit needs a longer line of 1 / (1 - similarity) words, and the shorter
    one has at least that share of them.
    """
    return math.ceil(similarity / (1 - similarity) - 1e-9) if similarity < 1 else 1 << 31


def line_hashes(texts: DataFrame, least: int) -> DataFrame:
    """``id, rid, pos, key, fp, n, p0, ...``: a digest of the normalised line, the SimHash of its words, how many, their parities.

    Lines of fewer than ``least`` words are similar to none but their equals and
    get no SimHash.

    Lines are normalised inside the array, so that it is done once for each.
    Where texts are bucketed by ``rid``, the words of a line are counted in the
    task that reads it, without a shuffle.
    """
    lines = (texts.select("id", "rid", F.posexplode(F.transform(F.split("text", "\n", -1), normalised))
                          .alias("pos", "norm")).where("norm <> ''"))
    line, h = ["id", "rid", "pos", "high", "low"], F.col("h")
    # The digest has a select of its own: beside the words it would be computed once per word.
    # Words are counted by its halves as numbers, as a binary would be copied for each.
    halves = [F.conv(F.substring("digest", at, 16), 16, -10).cast("long").alias(c)
              for at, c in ((1, "high"), (17, "low"))]
    words = lines.select("id", "rid", "pos", F.md5("norm").alias("digest"), "norm").select(
        "id", "rid", "pos", *halves, "norm").select(*line, F.posexplode(F.split("norm", " ")).alias("at", "word"))
    some = words.select(*line, F.expr(f"at DIV {SHORT}").alias("part"), F.xxhash64("word").alias("h")).groupBy(
        *line, "part").agg(F.count(F.lit(1)).alias("n"), *_lanes(h), *_parities(h))
    sums = some.groupBy(*line).agg(F.sum("n").alias("n"), *_pairs_of_bits(), *[F.bit_xor(p).alias(p) for p in MARKS])
    key = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("high", "low")]))
    return sums.select("id", "rid", "pos", key.alias("key"), F.when(F.col("n") >= least, _simhash()).alias("fp"), "n",
                       *MARKS)


def block_keys(fp: Column, blocks: int = BLOCKS, distance: int = DISTANCE) -> Column:
    """One number per choice of blocks that may agree: their bits, and which blocks they are."""
    edges = [round(BITS * b / blocks) for b in range(blocks + 1)]
    masks = [((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in range(blocks)]
    keys = []
    for number, some in enumerate(itertools.combinations(masks, blocks - distance)):
        mask = sum(some)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def _near(a: Column, b: Column, distance: int = DISTANCE) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _spread(marks: DataFrame, *more: str, distance: int = DISTANCE) -> DataFrame:
    return marks.select("fp", *more, F.explode(block_keys(F.col("fp"), distance=distance)).alias("block"))


def shared_blocks(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``block, fp, lead``: SimHashes that are near another of their block, and the smallest of these.

    Most share a block by chance alone.  To stay, one that is near is enough, so
    no pairs come out.
    """
    # Null ones are left out here and no column is renamed, so that both sides read the same shuffle.
    parts = _spread(marks.select("fp").where("fp IS NOT NULL"), distance=distance)
    one, two = F.col("one.fp"), F.col("two.fp")
    near = parts.alias("one").join(parts.alias("two"), (F.col("one.block") == F.col("two.block")) & (one != two) & _near(
        one, two, distance), "left_semi")
    return near.select("block", "fp", F.min("fp").over(Window.partitionBy("block")).alias("lead"))


def leader_pairs(lines: DataFrame, marks: DataFrame, distance: int = DISTANCE,
                 shared: DataFrame | None = None) -> DataFrame:
    """``a, b``: each line with the smallest of its SimHash, and that with the smallest of a near SimHash per block.

    ``marks`` has ``fp, key, n``: a SimHash, its smallest line, its lines.  A row
    per line, and one per SimHash and block, at most.
    """
    own = lines.join(marks.where("n > 1").select("fp", F.col("key").alias("b")), "fp").where("key <> b").select(
        F.col("key").alias("a"), "b")
    if shared is None:
        shared = shared_blocks(marks, distance)
    near = shared.where((F.col("fp") != F.col("lead")) & _near(
        F.col("fp"), F.col("lead"), distance)).select("fp", "lead").distinct()
    tops = marks.select("fp", F.col("key").alias("a"))
    leads = marks.select(F.col("fp").alias("lead"), F.col("key").alias("b"))
    return own.unionByName(near.join(tops, "fp").join(leads, "lead").select("a", "b"))


def _may_be_similar(similarity: float) -> Column:
    """No pair that this leaves out is similar: an edit changes two parities at most, and the length by one word."""
    most = (F.greatest("n_a", "n_b") * (1 - similarity) + 1e-9).cast("int")
    odd = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in MARKS])
    return (F.abs(F.col("n_a") - F.col("n_b")) <= most) & (odd <= most * 2)


def _other_groups(rows: DataFrame, key: str, condition: Column) -> DataFrame:
    """``a, b``: lines that share ``key``, belong to different groups and fulfil ``condition``.

    Keys of a single group are left out before any two lines meet.
    """
    rows = rows.repartition(key)
    several = rows.groupBy(key).agg(F.min("root").alias("least"), F.max("root").alias("most")).where(
        "least <> most").select(key)
    some = rows.join(several, key)
    sides = [some.select(key, *[F.col(c).alias(f"{c}_{side}") for c in some.columns if c != key or key == "fp"])
             for side in "ab"]
    return sides[0].join(sides[1], key).where((F.col("root_a") < F.col("root_b")) & condition).select(
        F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()


def open_pairs(lines: DataFrame, distance: int = DISTANCE, similarity: float = SIMILARITY,
               shared: DataFrame | None = None) -> DataFrame:
    """``a, b``: near lines that belong to different groups so far, from ``key, fp, root``, a number.

    Where lines have their lengths and parities, ``n, p0, ...``, pairs that
    these show to be unlike do not come out: long lines of common words have
    near SimHashes, however different they are.
    """
    alike = _may_be_similar(similarity) if "n" in lines.columns else F.lit(True)
    if shared is None:
        shared = shared_blocks(lines.select("fp").distinct(), distance)
    same = _other_groups(lines, "fp", alike)
    near = (F.col("fp_a") != F.col("fp_b")) & _near(F.col("fp_a"), F.col("fp_b"), distance)
    return same.unionByName(_other_groups(shared.select("block", "fp").join(lines, "fp"), "block", near & alike))


def _as_symbols(norm: Column) -> Column:
    """A line with one character per word, so that edits count words."""
    each = F.transform(F.split(norm, " "), lambda w: F.lpad(F.hex(
        F.pmod(F.xxhash64(w), F.lit(_SYMBOLS)) + _FIRST_SYMBOL), 8, "0"))
    return F.decode(F.unhex(F.array_join(each, "")), "UTF-32")


def _similar(a: Column, b: Column, similarity: float) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    most = (longer * (1 - similarity) + 1e-9).cast("int")
    # With a bound, only cells within it of the diagonal are filled.
    return F.call_function("levenshtein", a, b, most) >= 0


def _lines_of(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """``key, line``: lines by key as strings of symbols, from a place where each stands."""
    needed = keys.groupBy("rid").agg(F.collect_list(F.struct("pos", "key")).alias("needed"))
    # Only lines that are compared are normalised again; "lines" is named twice, so it is split once.
    # The small side is hashed, by bucket, so that texts are not sorted.
    return (texts.join(needed.hint("shuffle_hash"), "rid").select(F.split("text", "\n", -1).alias("lines"), "needed")
            .select(F.explode(F.transform("needed", lambda x: F.struct(
                x["key"].alias("key"),
                F.when(x["pos"] < F.size("lines"), _as_symbols(normalised(F.col("lines")[x["pos"]])))
                .alias("line")))).alias("x")).select("x.*"))


def _links(pairs: DataFrame, keys: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose lines are similar, as edges."""
    pairs = materialise(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    lines = materialise(_lines_of(keys.join(wanted, "key", "left_semi"), texts), "symbols")
    one = lines.select(F.col("key").alias("a"), F.col("line").alias("line_a"))
    two = lines.select(F.col("key").alias("b"), F.col("line").alias("line_b"))
    return materialise(pairs.join(one, "a").join(two, "b").where(_similar(F.col("line_a"), F.col("line_b"), similarity))
                       .select(F.hex("a").alias("u"), F.hex("b").alias("v")), "links")


def line_groups(keys: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``key, root`` of lines that are linked to another, from ``key, fp, rid, pos, n, p0, ...``.

    One row per distinct line comes in, with a place where it stands.  In a
    first pass each line is compared with one leader per SimHash and block, the
    smallest; that joins large groups of near copies with a row per line.  Then
    near lines that are in different groups still are compared pair by pair, so
    every near pair is compared unless its lines are connected already, or their
    lengths and parities tell that they are unlike.  Within a block the numbers
    of all its groups meet, in memory; only pairs that may be similar come out.
    """
    keys = keys.where("fp IS NOT NULL")
    fps = materialise(keys.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "fps")
    shared = materialise(shared_blocks(fps), "shared")
    # Most lines are near no other, and go no further.
    near = shared.select("fp").unionByName(fps.where("n > 1").select("fp")).distinct()
    keys = materialise(keys.join(near, "fp", "left_semi"), "close")
    marks = materialise(keys.groupBy("fp").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n")), "marks")
    lines = keys.select("key", "fp", "n", *MARKS)
    edges = _links(leader_pairs(lines.select("key", "fp"), marks, shared=shared), keys, texts, similarity)
    first = components(edges)
    # Groups by a number of 64 bits: two that share one would be taken for one group already.
    root = F.xxhash64(F.coalesce("root", "node"))
    rooted = lines.withColumn("node", F.hex("key")).join(first, "node", "left").select(
        "key", "fp", root.alias("root"), "n", *MARKS)
    more = _links(open_pairs(rooted, similarity=similarity, shared=shared), keys, texts, similarity)
    tied = first if more.isEmpty() else components(
        first.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))
    return tied.select(F.unhex("node").alias("key"), F.unhex("root").alias("root"))


@without_shuffles_left
def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               similarity: float = SIMILARITY) -> DataFrame:
    """The documents, all columns, with ``text`` reduced, and ``n_lines, n_removed``.

    Lines are split at newlines and normalised (case, digits, punctuation).  A
    group is what links connect: equal lines, and lines whose SimHashes differ in
    at most 3 bits and whose words are at least 80 % alike by edit distance.
    Of each group only the first occurrence stays: by smallest id (null last),
    then by place in the document.  Lines without a letter or digit always stay.
    A null text stays null and has no lines; a document all of whose lines go is
    left with an empty text.  Repeated rows are documents of their own, so the
    second one loses its lines.  An empty table gives no rows.  Where the table
    has columns called ``n_lines`` or ``n_removed``, they stay, and the counts
    get an underscore in front.
    """
    spark = docs.sparkSession
    buckets = parts_for(text_bytes(docs, text_col), BUCKET_BYTES)
    name = f"sluice_lines_{uuid.uuid4().hex}"
    others = [c for c in docs.columns if c != text_col]
    n_lines, n_removed = (free_name(docs.columns, c) for c in ("n_lines", "n_removed"))
    (docs.select(F.monotonically_increasing_id().alias("rid"), quoted(id_col).alias("id"),
                 quoted(text_col).alias("text"), F.struct(*map(quoted, others)).alias("rest"))
     .repartition(buckets, "rid").write.bucketBy(buckets, "rid").option("compression", "snappy")
     .option("path", fresh_path(spark, "lines")).saveAsTable(name))
    texts = spark.table(name)
    hashes = materialise(line_hashes(texts.select("id", "rid", "text"), least_words(similarity)), "hashes")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "rid", "pos")
    keys = materialise(hashes.groupBy("key").agg(
        *[F.min(c).alias(c) for c in ("fp", "n", *MARKS)], F.min(place).alias("first"),
        F.count(F.lit(1)).alias("places")), "keys")
    groups = line_groups(keys.select("key", "fp", "first.rid", "first.pos", "n", *MARKS), texts.select("rid", "text"),
                         similarity)
    groups = groups.unionByName(groups.select(F.col("root").alias("key"), "root").distinct())
    # Lines that stand once and are like no other go no further.
    rooted = materialise(keys.join(groups, "key", "left").where("places > 1 OR root IS NOT NULL").select(
        "key", "first", "places", F.coalesce("root", "key").alias("root")), "rooted")
    tops = (rooted.groupBy("root").agg(F.min("first").alias("top"), F.sum("places").alias("n"))
            .where("n > 1").select("root", "top"))
    kept = rooted.join(tops, "root").select(
        "key", F.col("top.rid").alias("kept_rid"), F.col("top.pos").alias("kept_pos"))
    flags = hashes.select("rid", "pos", "key").join(kept, "key")
    gone = (flags.where("rid <> kept_rid OR pos <> kept_pos").groupBy("rid")
            .agg(F.sort_array(F.collect_list("pos")).alias("gone")))
    lines = F.split("text", "\n", -1)
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.array_except(numbers, F.col("gone"))
    return (texts.join(gone.hint("shuffle_hash"), "rid", "left").withColumn("lines", lines)
            .withColumn("left", F.when(F.col("gone").isNotNull(), left))
            .select(*[F.when(F.col("left").isNull(), F.col("text")).otherwise(F.array_join(
                F.transform("left", lambda i: F.col("lines")[i]), "\n")).alias(c)
                if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns],
                F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias(n_lines),
                F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias(n_removed)))
