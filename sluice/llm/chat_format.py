"""Chat formatting: conversations as training text with a loss mask, and back.

DataFrame operations only.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import quoted

#: Lengths that are summed up in one go; running sums of longer lists go in two steps.
STRETCH = 256


@dataclass(frozen=True)
class Template:
    """Control strings around a conversation, its blocks and its turns.

    A block holds neighbouring turns of one role, ``turn`` between them.  A role
    that is not in ``blocks`` is named inside its block, up to ``name``.  Every
    control string starts with ``[`` or ``<`` and has neither of them later, and
    each kind of block closes in its own way.
    """

    begin: str = "<s>"
    blocks: Mapping[str, tuple[str, str]] = field(default_factory=lambda: {
        "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>"), "system": ("[SYS]", "[/SYS]")})
    other: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    name: str = "[NAME]"
    turn: str = "[TURN]"
    #: Blank inside a block, at both ends, so that words do not touch the control strings.
    pad: str = " "
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        closers = [c for _, c in (*self.blocks.values(), self.other)]
        if len(set(closers)) < len(closers) or not all(re.fullmatch(r"[\[<][^\[<\\]+", c) for c in self.controls):
            raise ValueError("control strings start with [ or <, hold no other, and blocks close differently")

    @property
    def controls(self) -> list[str]:
        found = [self.begin, self.name, self.turn, *self.other, *[c for pair in self.blocks.values() for c in pair]]
        return sorted({c for c in found if c})


def _any_of(strings: list[str]) -> str:
    return "(?:" + "|".join(re.escape(s) for s in strings) + ")"


def escape(text: Column, template: Template) -> Column:
    """A backslash after the first letter of every control string, and one more where some are already.

    What comes out holds no control string; :func:`unescape` takes the
    backslashes away again.
    """
    for first in "[<":
        rest = [c[1:] for c in template.controls if c[0] == first]
        if rest:
            text = F.regexp_replace(text, rf"\{first}(\\*{_any_of(rest)})", rf"\{first}\\$1")
    return text


def unescape(text: Column, template: Template) -> Column:
    for first in "[<":
        rest = [c[1:] for c in template.controls if c[0] == first]
        if rest:
            text = F.regexp_replace(text, rf"\{first}\\(\\*{_any_of(rest)})", rf"\{first}$1")
    return text


def _total(some: Column) -> Column:
    return F.aggregate(some, F.lit(0).cast("long"), lambda a, x: a + x)


def _with_running_sums(df: DataFrame, lengths: str, name: str) -> DataFrame:
    """Adds the sums of all that stands before each element of a list, in two steps.

    Lists are columns of their own where a lambda looks at them, so that they
    are made once and not again for every element.
    """
    last = F.greatest(F.ceil(F.size(lengths) / STRETCH).cast("int") - 1, F.lit(0))
    stretches = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(lengths, i * STRETCH + 1, STRETCH))
    whole = df.withColumn("stretches", stretches).withColumn("whole", F.transform("stretches", _total))
    before = whole.withColumn("before", F.transform("whole", lambda _, i: _total(F.slice("whole", 1, i))))
    return before.withColumn(name, F.flatten(F.transform(F.arrays_zip("stretches", "before"), lambda z: F.transform(
        z["stretches"], lambda _, j: z["before"] + _total(F.slice(z["stretches"], 1, j)))))).drop(
            "stretches", "whole", "before")


def _opener(role: Column, template: Template) -> Column:
    named = F.concat(F.lit(template.other[0]), escape(role, template), F.lit(template.name))
    for name, (opener, _) in template.blocks.items():
        named = F.when(role == name, F.lit(opener)).otherwise(named)
    return F.concat(named, F.lit(template.pad))


def _closer(role: Column, template: Template) -> Column:
    closer = F.lit(template.other[1])
    for name, (_, own) in template.blocks.items():
        closer = F.when(role == name, F.lit(own)).otherwise(closer)
    return F.concat(F.lit(template.pad), closer)


def format_conversations(turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, n_messages, formatted, loss``: a row per conversation.

    Turns are sorted by ``turn`` (null first), then role and text, so repeated
    rows and ties have one order; all of them stay.  A null role or text is an
    empty one.  Rows without a ``conv_id`` make up one conversation without an
    id.  Neighbouring turns of one role become one message, a block of its own.
    ``loss`` holds start and length, in UTF-8 bytes of ``formatted``, of every
    learned text, as it stands there (escaped).  Other columns are not read,
    whatever they are called.  An empty table gives no rows.

    A conversation is one value, so it has to fit into one (2 GB in Spark).
    """
    empty = F.lit("")
    role = F.coalesce(quoted(role_col), empty)
    text = escape(F.coalesce(quoted(text_col), empty), template)
    collected = turns.select(quoted(conv_col).alias("conv_id"), F.struct(
        quoted(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("x")).groupBy(
            "conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns"))
    first = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (
        F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]))
    merged = collected.withColumn("first", first).withColumn("messages", F.transform(
        "first", lambda i, k: F.struct(
            F.col("turns")[i]["role"].alias("role"),
            F.transform(F.slice("turns", i + 1, F.when(k + 1 < F.size("first"), F.try_element_at("first", k + 2))
                                .otherwise(F.size("turns")) - i), lambda t: t["text"]).alias("texts"))))
    # Everything that is written, in order; learned texts are marked.
    pieces = F.flatten(F.transform("messages", lambda m: F.concat(
        F.array(F.struct(_opener(m["role"], template).alias("text"), F.lit(False).alias("learned"))),
        F.flatten(F.transform(m["texts"], lambda t, i: F.array(
            F.struct(F.when(i > 0, template.turn).otherwise("").alias("text"), F.lit(False).alias("learned")),
            F.struct(t.alias("text"), m["role"].isin(*template.learned).alias("learned"))))),
        F.array(F.struct(_closer(m["role"], template).alias("text"), F.lit(False).alias("learned"))))))
    written = merged.select("conv_id", F.size("messages").cast("long").alias("n_messages"), pieces.alias("pieces"))
    placed = _with_running_sums(written.withColumn("lengths", F.transform(
        "pieces", lambda p: F.octet_length(p["text"]).cast("long"))), "lengths", "starts")
    before = len(template.begin.encode())
    spans = F.transform(F.filter(F.arrays_zip("pieces", "starts"), lambda z: z["pieces"]["learned"]), lambda z: F.struct(
        (z["starts"] + before).alias("start"), F.octet_length(z["pieces"]["text"]).cast("long").alias("length")))
    return placed.select("conv_id", "n_messages", F.concat(F.lit(template.begin), F.array_join(
        F.transform("pieces", lambda p: p["text"]), "")).alias("formatted"), spans.alias("loss"))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns, an array of ``role, text``, that a formatted conversation was made of."""
    pad = len(template.pad)
    ends = "|".join(f"(?<={re.escape(c)})" for _, c in (*template.blocks.values(), template.other))
    body = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)
    blocks = F.filter(F.split(body, ends, -1), lambda b: b != "")

    def inner(block: Column, opener: Column | int, closer: str) -> Column:
        return F.substring(block, opener + pad + 1, F.length(block) - opener - 2 * pad - len(closer))

    def turns(block: Column) -> Column:
        named, end = template.other
        header = F.instr(block, template.name)
        role = unescape(F.substring(block, len(named) + 1, header - 1 - len(named)), template)
        texts = inner(block, header - 1 + len(template.name), end)
        for name, (opener, closer) in template.blocks.items():
            own = F.endswith(block, F.lit(closer))
            role = F.when(own, F.lit(name)).otherwise(role)
            texts = F.when(own, inner(block, F.lit(len(opener)), closer)).otherwise(texts)
        return F.transform(F.split(texts, re.escape(template.turn), -1), lambda t: F.struct(
            role.alias("role"), unescape(t, template).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learned_text(raw: Column, loss: Column, template: Template = Template()) -> Column:
    """All text under the mask, unescaped, from the bytes of a formatted conversation."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"), template)), "")


def conversation_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What a formatted table holds, read back from its text and its mask alone."""
    read = formatted.withColumn("turns", read_turns(F.col("formatted"), template))
    # The bytes are used twice, so that they are made once and not again for every span.
    read = read.withColumn("raw", F.col("formatted").cast("binary"))
    learned = read.withColumn("learned", learned_text(F.col("raw"), F.col("loss"), template))
    return learned.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                            ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.octet_length("raw").cast("long").alias("formatted_bytes"), "n_messages")
