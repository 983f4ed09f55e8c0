"""License scans: phrases, and license texts matched by automata made from templates."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from sluice.llm.common import quoted

#: Phrase and label.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))

#: Label and template.  ``[[ ]]`` may be left out, ``(a|b)`` is either, ``{n}``
#: stands for up to n words of any kind; all else must be there word for word.
TEMPLATES = (
    ("mit-text", """permission is hereby granted free of charge to any person obtaining a copy of
        {6} and associated documentation files the software to deal in the software without
        restriction including without limitation the rights to use copy modify merge publish
        distribute sublicense and or sell copies of the software and to permit persons to whom the
        software is furnished to do so subject to the following conditions the above copyright
        notice and this permission notice [[including the next paragraph]] shall be included in all
        copies or substantial portions of the software the software is provided as is without
        warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and (noninfringement|non infringement)
        [[in no event shall the {12} be liable for any claim damages or other liability whether in
        an action of contract tort or otherwise arising from out of or in connection with the
        software or the use or other dealings in the software]]"""),
    ("isc-text", """permission to use copy modify and (or|distribute) [[or distribute]] this software
        for any purpose with or without fee is hereby granted [[provided that the above copyright
        notice and this permission notice appear in all copies]]"""),
    ("bsd-text", """redistribution and use in source and binary forms with or without modification
        are permitted provided that the following conditions are met [[1]] redistributions of source
        code must retain the above copyright notice this list of conditions and the following
        disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice
        this list of conditions and the following disclaimer in the documentation and or other
        materials provided with the distribution [[[[3]] neither the name of {12} nor the names of
        its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission]]"""),
    ("apache-2-notice", """licensed under the apache license version 2 0 [[the license you may not use
        this file except in compliance with the license [[you may obtain a copy of the license at
        {8}]]]]"""),
    ("mit-notice", """(released|licensed|distributed) under the [[terms of the]] mit license"""),
    ("gpl-notice", """(licensed|released|distributed) under the [[terms of the]] gnu
        [[(lesser|affero)]] general public license [[as published by the free software foundation
        either]] version (2|3) [[of the license]] [[or [[at your option]] any later version]]"""),
    ("cc-notice", """(licensed|released) under [[a|the]] [[creative commons {2}]] cc by
        [[(nc|sa|nd)]] [[(sa|nd)]] [[(1|2|3|4) (0|5)]]"""),
)

_WORD = re.compile(r"\[\[|\]\]|\(|\)|\||\{\d+\}|[^\s\[\](){}|]+")
#: Bytes that are no part of a word: ASCII but digits and small letters.
_BLANKS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


@dataclass
class Automaton:
    """States with word moves, free moves, and moves on any word."""

    moves: list[dict[bytes, list[int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    any: list[list[int]] = field(default_factory=list)
    accept: int = -1
    anchors: tuple[bytes, ...] = ()

    def state(self) -> int:
        self.moves.append({})
        self.free.append([])
        self.any.append([])
        return len(self.moves) - 1

    def closed(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def match(self, words: list[bytes], start: int) -> int | None:
        """Where the longest match from ``start`` ends, or None."""
        states, end, i = self.closed({0}), None, start
        while states:
            if self.accept in states:
                end = i
            if i >= len(words):
                break
            word, after = words[i], set()
            for s in states:
                after.update(self.moves[s].get(word, ()))
                after.update(self.any[s])
            states, i = self.closed(after), i + 1
        return end


def compile_template(template: str) -> Automaton:
    """A template's automaton; its first words must be mandatory or a choice."""
    tokens = _WORD.findall(template)
    auto = Automaton()
    at = 0

    def sequence(state: int, stops: tuple[str, ...]) -> int:
        nonlocal at
        while at < len(tokens) and tokens[at] not in stops:
            token = tokens[at]
            at += 1
            if token in ("[[", "("):
                close, begin, done = ("]]" if token == "[[" else ")"), state, auto.state()
                while True:
                    entry = auto.state()
                    auto.free[begin].append(entry)
                    auto.free[sequence(entry, (close, "|"))].append(done)
                    at += 1
                    if tokens[at - 1] == close:
                        break
                if token == "[[":
                    auto.free[begin].append(done)
                state = done
            elif token[0] == "{":
                done = auto.state()
                auto.free[state].append(done)
                for _ in range(int(token[1:-1])):
                    nxt = auto.state()
                    auto.any[state].append(nxt)
                    auto.free[nxt].append(done)
                    state = nxt
                state = done
            else:
                nxt = auto.state()
                auto.moves[state].setdefault(token.encode(), []).append(nxt)
                state = nxt
        return state

    begin = auto.state()
    auto.accept = sequence(begin, ())
    if auto.accept in auto.closed({begin}):
        raise ValueError("a template needs mandatory words")
    auto.anchors = tuple(sorted({w for s in auto.closed({begin}) for w in auto.moves[s]}))
    if any(auto.any[s] for s in auto.closed({begin})):
        raise ValueError("a template must not begin with replaceable words")
    return auto


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_BLANKS).split()


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which the phrase stands; ``joined`` has a blank on both sides of each word."""
    at, word, done = joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", done, at)
        done = at
        yield word
        at = joined.find(phrase, at + 1)


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [(b" " + p.encode() + b" ", len(p.split()), label) for p, label in phrases]
        self.automata = [(label, compile_template(t)) for label, t in templates]
        # All templates begin within a few words; each is tried only at these.
        self.starts: dict[bytes, list[int]] = {}
        for k, (_, auto) in enumerate(self.automata):
            for word in auto.anchors:
                self.starts.setdefault(word, []).append(k)

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        places, base, labels, spans = [], set(), set(), []
        for phrase, n, label in self.phrases:
            for at in _places(joined, phrase):
                places.append(at)
                base.add(label)
                spans.append((at, at + n))
        for word, which in self.starts.items():
            for at in _places(joined, b" " + word + b" "):
                for k in which:
                    label, auto = self.automata[k]
                    end = auto.match(words, at)
                    if end is not None:
                        labels.add(label)
                        spans.append((at, end))
        covered, reach = 0, 0
        for a, b in sorted(spans):
            covered += max(0, b - max(a, reach))
            reach = max(reach, b)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | labels)),
                covered / len(words) if words else 0.0)


_SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES,
                 templates=TEMPLATES) -> DataFrame:
    """Per document: words, phrase places and labels, the templates' labels too, and a score.

    ``score`` is the share of words that stand in a phrase or a matched template.
    Words are runs of digits, small letters (A-Z lowered) and characters beyond
    ASCII.  A null or empty text has no words, no labels and score 0.  Repeated
    rows are scanned each for itself; no row meets another.
    """
    names = ["doc_id", *(c.split()[0] for c in _SCHEMA.split(", "))]

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(phrases, templates)
        for pdf in pdfs:
            out = pd.DataFrame([(i, *scanner.scan(t)) for i, t in zip(pdf["id"], pdf["text"])],
                               columns=names)
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out

    return docs.select(quoted(id_col).cast("string").alias("id"), quoted(text_col).alias("text")).mapInPandas(
        run, f"doc_id string, {_SCHEMA}").selectExpr("CAST(doc_id AS BIGINT) AS doc_id", *names[1:])
