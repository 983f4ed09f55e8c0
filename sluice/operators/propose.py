"""Proposals for a search: draws where good trials are dense and bad ones are not.

The trials so far, best first, are split into good and bad ones.  Per parameter
both parts give a density: a kernel around each value for ranges, smoothed shares
for choices.  Of the candidates drawn from the good density, the one with the highest
ratio of good to bad is proposed.  All of it is about as many numbers as there are
trials.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

#: The share of trials that counts as good.
GOOD_SHARE = 0.25
#: Candidates drawn per proposal.
CANDIDATES = 24


class _Shares:
    """Smoothed shares of a choice's values."""

    def __init__(self, values: Sequence, seen: Sequence):
        self.values = list(values)
        self.weights = [1.0 + seen.count(v) for v in self.values]

    def draw(self, rng: random.Random):
        return rng.choices(self.values, self.weights)[0]

    def log_density(self, value) -> float:
        return math.log(self.weights[self.values.index(value)] / sum(self.weights))


class _Kernels:
    """A normal kernel per value seen, cut at the range's ends, and a flat one for the whole range."""

    def __init__(self, low: float, high: float, seen: Sequence[float]):
        self.low, self.high, self.seen = low, high, [float(x) for x in seen]
        self.width = (high - low) / max(1.0, math.sqrt(len(self.seen)) * 2) or 1.0

    def _mass(self, x: float) -> float:
        cdf = lambda t: 0.5 * (1 + math.erf((t - x) / (self.width * math.sqrt(2))))
        return max(cdf(self.high) - cdf(self.low), 1e-12)

    def draw(self, rng: random.Random) -> float:
        at = rng.randrange(len(self.seen) + 1)
        if at == len(self.seen) or self.low == self.high:
            return rng.uniform(self.low, self.high)
        while True:
            value = rng.gauss(self.seen[at], self.width)
            if self.low <= value <= self.high:
                return value

    def log_density(self, value: float) -> float:
        total = 1.0 / ((self.high - self.low) or 1.0)
        for x in self.seen:
            bump = math.exp(-0.5 * ((value - x) / self.width) ** 2) / (self.width * math.sqrt(2 * math.pi))
            total += bump / self._mass(x)
        return math.log(total / (len(self.seen) + 1))


def propose(params: Mapping[str, object], history: Sequence[tuple[Mapping[str, object], float]], n: int,
            startup: int, seed: int = 42) -> list[dict]:
    """The next ``n`` trials, to be run side by side.

    ``history`` holds trials and their scores, higher is better; while it has
    fewer than ``startup``, trials are drawn at random.  A trial just proposed
    counts as bad until its score is known, which spreads a batch out.  The
    same history and seed give the same proposals.
    """
    rng = random.Random(f"{seed}-{len(history)}")
    ranked = [t for t, _ in sorted(history, key=lambda h: -h[1])]
    cut = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    good, bad, out = ranked[:cut], ranked[cut:], []
    for _ in range(n):
        if len(history) + len(out) < startup or not history:
            out.append({name: p.draw(rng) for name, p in params.items()})
            continue
        trial = {}
        for name, p in params.items():
            likely = _density(p, [t[name] for t in good])
            unlikely = _density(p, [t[name] for t in (*bad, *out)])
            drawn = [likely.draw(rng) for _ in range(CANDIDATES)]
            trial[name] = p.settle(max(drawn, key=lambda v: likely.log_density(v) - unlikely.log_density(v)))
        out.append(trial)
    return out


def _density(param, seen: Sequence):
    return _Shares(param.values, seen) if hasattr(param, "values") else _Kernels(param.low, param.high, seen)
