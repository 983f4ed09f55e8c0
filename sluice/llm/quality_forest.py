"""Quality rules: an isolation forest over rule statistics, cut off by labelled rows."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import materialise, quoted

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words
#: The forest: trees, and documents each tree is grown from.
TREES, SAMPLE = 100, 256
#: Labelled documents the trees draw from, at most; all labelled ones set the threshold.
POOL = 4096
#: Share of labelled good documents that may be rejected.
TOLERANCE = 0.002
#: Steps in which thresholds are compared.
STEPS = 1000

_SYMBOLS = b"#*$%&|<>"
_DROP = bytes(range(0x09, 0x0E)) + b" "
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FEATURES = ("symbols_per_char", "chars_per_word", "repeat_words", "bars_per_word")


def rule_statistics(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """The five counts, and the features the forest sees: ratios, so length does not matter."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    solid = raw.translate(None, _DROP)
    chars = len(solid.decode())
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line.strip():
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = 0
    if n > 2 and len(windows) < n - 2:
        reach = 0
        for i, w in enumerate(zip(words, words[1:], words[2:])):
            if windows[w] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    bars = raw.count(b"|")
    per_word, per_char = 1 / max(n, 1), 1 / max(chars, 1)
    features = [symbols * per_char, chars * per_word, repeated * per_word, bars * per_word]
    return (n, chars, symbols, dup, repeated), features


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, the counts and ``x``, the features: texts stay where they are read."""
    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            found = [rule_statistics(t) for t in pdf["text"]]
            out = pd.DataFrame([f[0] for f in found], columns=[c.split()[0] for c in STATS.split(", ")])
            out.insert(0, "id", pdf["id"].to_numpy())
            out["x"] = [f[1] for f in found]
            yield out

    return docs.select(quoted(id_col).cast("string").alias("id"), quoted(text_col).alias("text")).mapInPandas(
        run, f"id string, {STATS}, x array<double>").withColumn("id", F.col("id").cast("long"))


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    return 0.0 if n <= 1 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


class Forest:
    """Random splits; rows that are soon alone are anomalous.

    Splits are drawn a little beyond the range of the rows in a node, by
    ``margin`` per feature.  A value that no row has, of a feature that hardly
    varies among them, is thereby soon alone; rows within the range are not.
    """

    def __init__(self, rows: np.ndarray, margin: np.ndarray | None = None, trees: int = TREES,
                 sample: int = SAMPLE, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.margin = np.zeros(rows.shape[1]) if margin is None else margin
        self.sample = min(sample, len(rows))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.sample, replace=False)], rng)
                      for _ in range(trees)] if len(rows) else []

    def _grow(self, rows: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []
        limit = math.ceil(math.log2(max(2, len(rows))))
        todo = [(rows, 0, -1, 0)]
        while todo:
            part, depth, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = me
            alone = len(part) <= 1
            low, high = (part[:1].sum(axis=0),) * 2 if alone else (part.min(axis=0) - self.margin,
                                                                   part.max(axis=0) + self.margin)
            able = np.flatnonzero(high > low)
            if depth >= limit or alone or not len(able):
                nodes.append([-1, 0.0, me, me, depth + _expected(len(part))])
                continue
            f = rng.choice(able)
            at = rng.uniform(low[f], high[f])
            nodes.append([f, at, me, me, 0.0])
            right = part[:, f] > at
            todo += [(part[right], depth + 1, me, 1), (part[~right], depth + 1, me, 0)]
        table = np.array(nodes)
        return table[:, 0].astype(int), table[:, 1], table[:, 2:4].astype(int), table[:, 4]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; above a half is more isolated than average."""
        if not self.trees:
            return np.zeros(len(rows))
        paths = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, at, child, depth in self.trees:
            node = np.zeros(len(rows), dtype=int)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[every, np.maximum(f, 0)] > at[node]
                node = np.where(inner, child[node, right.astype(int)], node)
            paths += depth[node]
        return 2.0 ** (-paths / len(self.trees) / max(_expected(self.sample), 1e-9))


def with_score(stats: DataFrame, forest: Forest) -> DataFrame:
    """Adds ``score``; the forest is of fixed size and goes along with the code."""
    schema = T.StructType(stats.schema.fields + [T.StructField("score", T.DoubleType())])

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            rows = np.array(pdf["x"].tolist(), dtype=float).reshape(len(pdf), len(FEATURES))
            yield pdf.assign(score=forest.scores(rows))

    return stats.mapInPandas(run, schema)


def best_threshold(scored: DataFrame, tolerance: float = TOLERANCE) -> float:
    """The cut-off that catches most bad rows and at most ``tolerance`` of the good ones.

    Of several it is the middle one.
    ``scored`` has ``score`` and ``quality`` of all labelled rows; they are
    counted per step, so the driver sees at most ``STEPS`` rows.  Without
    labelled rows of both kinds nothing is cut off.
    """
    rows = (scored.groupBy(F.floor(F.col("score") * STEPS).alias("step"))
            .agg(F.count_if(F.col("quality") == 1).alias("good"),
                 F.count_if(F.col("quality") == 0).alias("bad")).collect())
    good, bad = sum(r.good for r in rows), sum(r.bad for r in rows)
    if not good or not bad:
        return math.inf
    best, least, lost = math.inf, math.inf, 0
    for r in sorted(rows, key=lambda r: -r.step):
        lost += r.good
        if lost > tolerance * good:
            break
        least = r.step / STEPS
        if r.bad:
            best = least
    return (best + least) / 2


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tolerance: float = TOLERANCE) -> DataFrame:
    """Per row: ``id``, the five counts, ``base_failed``, ``score`` and ``kept``.

    The base rule rejects below 50 words or with more than half of them in
    repeated 3-word windows.  The forest is grown from the good ones of at most
    ``POOL`` labelled documents that pass it, chosen by a hash of their id, with
    the deviations of all of those as margins; ``labels`` has ``doc_id``
    and ``quality`` (1 good, 0 bad).  The threshold is set on all labelled
    documents.  Labels that are null, or contradict each other, count as bad only
    if all of the document's are.  A null text has no words and fails.  Repeated
    rows are judged each for itself.
    """
    stats = materialise(with_base_rule(with_statistics(docs, id_col, text_col)), "statistics")
    forest, cut = fit(stats, labels, tolerance)
    return with_score(stats, forest).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") < F.lit(cut))).drop("x")


def with_base_rule(stats: DataFrame) -> DataFrame:
    return stats.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def fit(stats: DataFrame, labels: DataFrame, tolerance: float = TOLERANCE) -> tuple[Forest, float]:
    """The forest and the score from which a document is rejected."""
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").alias("id")).agg(F.max("quality").alias("quality"))
    known = stats.where("NOT base_failed").join(marks, "id")
    pool = known.orderBy(F.xxhash64("id"), "id", "n_words", "word_chars").limit(POOL).select(
        "x", "quality").collect()
    rows = np.array([r.x for r in pool], dtype=float).reshape(-1, len(FEATURES))
    good = np.array([r.quality == 1 for r in pool], dtype=bool)
    forest = Forest(rows[good], rows.std(axis=0) if len(rows) else None)
    return forest, best_threshold(with_score(known.select("x", "quality"), forest), tolerance)


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tolerance: float = TOLERANCE) -> DataFrame:
    """The documents that are kept, all columns.

    The statistics are taken twice, once to fit and once to filter, so that no
    text is shuffled and repeated ids do no harm.
    """
    stats = materialise(with_base_rule(with_statistics(docs, id_col, text_col)), "statistics")
    forest, cut = fit(stats, labels, tolerance)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rule_statistics(t.as_py()) for t in batch.column(place)]
            score = forest.scores(np.array([f[1] for f in found], dtype=float).reshape(-1, len(FEATURES)))
            keep = [n >= MIN_WORDS and 100 * again <= MAX_REPEATED * n and s < cut
                    for ((n, _, _, _, again), _), s in zip(found, score)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
