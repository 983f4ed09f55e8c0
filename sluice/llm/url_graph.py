"""URL filters: rules first, then trust and distrust spread over links between hosts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import free_name, materialise, quoted

DAMPING = 0.85
#: Rounds end when no host's trust or distrust moves by more than this.
SETTLED = 1e-6
#: A host is blocked where distrust less trust reaches this share of a full seed's own mass.
THRESHOLD = 0.5

_BIG, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       _BIG, _SMALL)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _first_rule(rules: Sequence[Rule], host: Column, path: Column, what) -> Column:
    """The longest rule that fits; a rule list is written by hand, so it is short."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
            path, F.lit(rule.path))
        out = F.when(fits, F.lit(what(rule))).otherwise(out)
    return out


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Links between different hosts, ``src, dst, n``, from the pages' hyperlinks."""
    target = F.explode(F.regexp_extract_all(
        F.col("html"), F.lit(r"(?i)href\s*=\s*[\"']?\s*((?:https?:)?//[^\"'\s>]*)"), F.lit(1)))
    found = (pages.select(host_of(quoted(url)).alias("src"), quoted(html).alias("html"))
             .where("html IS NOT NULL").select("src", target.alias("to"))
             .select("src", F.translate(F.regexp_extract("to", r"//([^/?#]*)", 1), _BIG, _SMALL).alias("dst")))
    return (found.where("src <> dst AND src <> '' AND dst <> ''")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING,
           settled: float = SETTLED) -> DataFrame:
    """``host, trust, distrust`` from seeds ``host, trust, distrust``.

    Personalised PageRank of both at once: trust runs along links, shared out
    over a host's links; distrust runs against them, to the hosts that link to
    a distrusted one.  Hosts that are only linked to take part with empty seeds.
    A round is one aggregation per host, written to the shared folder, so a lost
    executor costs a round at most.  Rounds go on until no host moves by more
    than ``settled``.  Each shrinks all moves together by ``damping``, so they do
    end; what is left then is at most ``damping / (1 - damping)`` times the last
    round's moves.
    """
    if not 0 <= damping < 1 or settled <= 0:
        raise ValueError("damping has to be in [0, 1) and settled above 0")
    links = materialise(links, "links")
    if links.isEmpty():
        return seeds.select("host", (F.col("trust") * (1 - damping)).alias("trust"),
                            (F.col("distrust") * (1 - damping)).alias("distrust"))
    out_n = links.groupBy("src").agg(F.sum("n").alias("out_n"))
    in_n = links.groupBy("dst").agg(F.sum("n").alias("in_n"))
    edges = links.join(out_n, "src").join(in_n, "dst")
    edges = materialise(edges.select(
        F.col("src").alias("a"), F.col("dst").alias("b"), (F.col("n") / F.col("out_n")).alias("t"), F.lit(0.0).alias("d"))
        .unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"), F.lit(0.0).alias("t"),
                                  (F.col("n") / F.col("in_n")).alias("d"))), "edges")
    none = edges.select(F.col("b").alias("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))
    own = materialise(seeds.select("host", "trust", "distrust").unionByName(none).groupBy("host").agg(
        (F.sum("trust") * (1 - damping)).alias("trust"),
        (F.sum("distrust") * (1 - damping)).alias("distrust")), "seeds")
    state = own
    moved = settled + 1
    while moved > settled:
        sent = edges.join(state, edges.a == state.host).select(
            F.col("b").alias("host"), (F.col("trust") * F.col("t") * damping).alias("trust"),
            (F.col("distrust") * F.col("d") * damping).alias("distrust"))
        after = materialise(own.unionByName(sent).groupBy("host").agg(
            F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "ranks")
        moved = (after.alias("x").join(state.alias("y"), "host").agg(F.max(F.greatest(
            F.abs(F.col("x.trust") - F.col("y.trust")),
            F.abs(F.col("x.distrust") - F.col("y.distrust"))))).first()[0]) or 0.0
        state = after
    return state


def url_filter(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", html_col: str = "html",
               threshold: float = THRESHOLD, damping: float = DAMPING) -> DataFrame:
    """The pages without their html, plus ``host, path, rule, verdict``.

    The longest rule that fits decides.  Where none does, the host does: its
    allowed and blocked shares of pages seed trust and distrust, and it is
    blocked where distrust less trust reaches the threshold.  A null url, or one
    without ``://``, has an empty host and path and is allowed unless a rule
    says otherwise.  Pages without html have no links.  Repeated rows count each.
    Existing columns of the names added are replaced.
    """
    names = [c for c in pages.columns if c != html_col]
    host, path, rule = host_of(quoted(url_col)), path_of(quoted(url_col)), None
    judged = pages.select(*map(quoted, [c for c in names if c.lower() not in
                                        ("host", "path", "rule", "verdict")]),
                          host.alias("host"), path.alias("path"))
    rule = _first_rule(rules, F.col("host"), F.col("path"), lambda r: r.name)
    said = _first_rule(rules, F.col("host"), F.col("path"), lambda r: r.verdict)
    judged = judged.withColumn("rule", rule).withColumn("verdict", said)
    share = lambda v: F.avg(F.when(F.col("verdict") == v, 1.0).otherwise(0.0))
    seeds = judged.where("host <> ''").groupBy("host").agg(
        share("allow").alias("trust"), share("block").alias("distrust"))
    ranks = spread(seeds, host_links(pages, url_col, html_col), damping)
    bad = free_name(judged.columns, "bad")
    blocked = ranks.where(F.col("distrust") - F.col("trust") >= threshold * (1 - damping)).select(
        "host", F.lit(True).alias(bad))
    return (judged.join(blocked, "host", "left")
            .withColumn("verdict", F.coalesce("verdict", F.when(F.col(bad), "block").otherwise("allow")))
            .drop(bad))
