import re

import pytest

from sluice.llm import url_graph as U
from sluice.llm.queries import PAGE_RULES, QUERIES


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def rule_of(host, path):
    fits = [r for r in PAGE_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def brute(pages):
    """Verdicts with the ranks iterated in plain Python."""
    judged = [(*split(u), html) for _, u, html in pages]
    rules = [rule_of(h, p) for h, p, _ in judged]
    share, links = {}, {}
    for (h, _, html), r in zip(judged, rules):
        if h:
            share.setdefault(h, []).append(r.verdict if r else None)
        for to in re.findall(r"(?i)href\s*=\s*[\"']?\s*((?:https?:)?//[^\"'\s>]*)", html or ""):
            t = re.search(r"//([^/?#]*)", to)[1].lower()
            if h and t and t != h:
                links[h, t] = links.get((h, t), 0) + 1
    hosts = set(share) | {b for _, b in links}
    seed = {v: {h: share.get(h, []).count(v) / max(1, len(share.get(h, []))) for h in hosts}
            for v in ("allow", "block")}
    rank = {}
    for v, edges in (("allow", links), ("block", {(b, a): n for (a, b), n in links.items()})):
        out = {}
        for (a, _), n in edges.items():
            out[a] = out.get(a, 0) + n
        x = {h: 0.15 * s for h, s in seed[v].items()}
        own = dict(x)
        for _ in range(200):
            y = dict(own)
            for (a, b), n in edges.items():
                y[b] += 0.85 * x[a] * n / out[a]
            x = y
        rank[v] = x
    bad = {h for h in hosts if rank["block"][h] - rank["allow"][h] >= 0.5 * 0.15}
    return sorted((i, h, p, r.name if r else None, r.verdict if r else "block" if h in bad else "allow")
                  for (i, _, _), (h, p, _), r in zip(pages, judged, rules))


PAGES = [
    (1, "http://A.Example.com/en/x", None), (2, "https://www.example.com/en/", ""), (3, "http://x.net/es/1?y", "z"),
    (4, "http://x.net/fr/1", None), (5, "http://x.net/de/1", None), (6, None, None), (7, "no scheme", "<a href='//x.net/'>"),
    (8, "http://example.com", None), (9, "http://notexample.com/en/", None), (10, "ftp://h.org?q=a://b/c", None),
    (11, "http://linker.org/a", '<a href="http://x.net/es/9">a</a> <a href=//X.NET/fr/2>b</a>'),
    (12, "http://mixed.org/a", '<a href="http://good.com/1"><a href="http://x.net/">'),
    (13, "http://good.com/", '<a HREF = "https://liked.org/b">'), (14, "http://liked.org/c", '<a href="/rel">'),
    (11, "http://linker.org/a", '<a href="http://x.net/es/9">a</a>'), (None, "http://\n.org/a\nb", None),
]


def test_like_brute_force(spark):
    df = spark.createDataFrame([(*p, "clash", k) for k, p in enumerate(PAGES)],
                               "page_id long, url string, html string, verdict string, bad int")
    out = U.url_filter(df, PAGE_RULES)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted((tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict").collect()), key=key)
    pages = [(-1 if i is None else i, u, h) for i, u, h in PAGES]
    want = sorted(((None if r[0] == -1 else r[0], *r[1:]) for r in brute(pages)), key=key)
    assert got == want
    assert out.columns.count("bad") == 1
    verdicts = {r[0]: r[4] for r in got}
    assert verdicts[5] == "block" and verdicts[14] == "allow" and {r[0]: r[3] for r in got}[5] is None
    assert U.url_filter(df.where("false"), PAGE_RULES).count() == 0


def test_ranks_reach_the_tolerance(spark):
    """Two hosts that only link to each other pass trust on far longer than a few rounds."""
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 0.0), ("c", 0.0, 1.0)],
                                  "host string, trust double, distrust double")
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 3), ("c", "a", 2)], "src string, dst string, n long")
    got = {r.host: (r.trust, r.distrust) for r in U.spread(seeds, links).collect()}
    exact = {"a": 0.15 / (1 - 0.85 ** 2), "b": 0.15 * 0.85 / (1 - 0.85 ** 2), "c": 0.0}
    for host, trust in exact.items():
        assert abs(got[host][0] - trust) < U.SETTLED * 0.85 / 0.15
        assert abs(got[host][1] - (0.15 if host == "c" else 0.0)) < 1e-9
    with pytest.raises(ValueError, match="damping"):
        U.spread(seeds, links, damping=1.0)


def test_query(spark, small):
    pages = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted(map(tuple, QUERIES["op9_url_filters"](spark, small).collect()))
    assert got == brute(pages)
