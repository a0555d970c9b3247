"""Parameter search by a tree-structured Parzen estimator.

The first trials are drawn at random. After that, the trials so far are cut
into a good part and the rest; each parameter gets a density of each part (a
mixture of bumps on the tried values and of the whole range), candidates are
drawn from the good density, and the one with the greatest ratio of good to
rest is tried next. Trials run a few at a time; values under trial count as
part of the rest, so that a batch does not try one point twice.

Only drawn parameters and their scores are held here; each trial is a
distributed job of its own.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

Value = float | int
Bounds = Mapping[str, tuple[Value, Value]]


def _normal_between(mean: float, width: float, low: float, high: float) -> float:
    """Mass of a normal distribution between two bounds."""
    at = lambda x: 0.5 * (1 + math.erf((x - mean) / (width * math.sqrt(2))))
    return max(at(high) - at(low), 1e-12)


@dataclass
class Parzen:
    """Density of one parameter: equal bumps on the values tried, one more as
    wide as the range. Whole-numbered parameters have bounds of integers."""

    low: Value
    high: Value
    values: list[Value]
    bumps: list[tuple[float, float]] = field(init=False)

    def __post_init__(self) -> None:
        span = float(self.high - self.low) or 1.0
        inside = sorted(map(float, self.values))
        bumps = [((self.low + self.high) / 2, span)]
        for k, v in enumerate(inside):
            left = v - (inside[k - 1] if k else self.low)
            right = (inside[k + 1] if k + 1 < len(inside) else self.high) - v
            width = min(span, max(left, right, span / min(100, len(inside) + 2)))
            bumps.append((v, width))
        self.bumps = bumps

    @property
    def whole(self) -> bool:
        return isinstance(self.low, int) and isinstance(self.high, int)

    def draw(self, rng: random.Random) -> Value:
        edge = 0.5 if self.whole else 0.0
        while True:
            mean, width = rng.choice(self.bumps)
            x = rng.gauss(mean, width)
            if self.low - edge <= x <= self.high + edge:
                return min(max(round(x), self.low), self.high) if self.whole else x

    def log_density(self, x: Value) -> float:
        edge = 0.5 if self.whole else 0.0
        low, high = self.low - edge, self.high + edge
        total = 0.0
        for mean, width in self.bumps:
            inside = _normal_between(mean, width, low, high)
            if self.whole:
                total += _normal_between(mean, width, x - 0.5, x + 0.5) / inside
            else:
                total += math.exp(-0.5 * ((x - mean) / width) ** 2) / (width * math.sqrt(2 * math.pi)) / inside
        return math.log(max(total / len(self.bumps), 1e-300))


def random_draw(space: Bounds, rng: random.Random) -> dict[str, Value]:
    return {name: rng.randint(a, b) if isinstance(a, int) and isinstance(b, int) else rng.uniform(a, b) for name, (a, b) in space.items()}


def propose(space: Bounds, done: list[tuple[dict[str, Value], float]], pending: list[dict[str, Value]], rng: random.Random,
            candidates: int = 24) -> dict[str, Value]:
    """The next point, from trials with scores (larger is better)."""
    ranked = [p for p, _ in sorted(done, key=lambda t: -t[1])]
    n_good = min(25, max(2, math.ceil(0.15 * len(ranked))))
    good, rest = ranked[:n_good], ranked[n_good:] + pending
    out = {}
    for name, (low, high) in space.items():
        better, other = Parzen(low, high, [p[name] for p in good]), Parzen(low, high, [p[name] for p in rest])
        drawn = [better.draw(rng) for _ in range(candidates)]
        out[name] = max(drawn, key=lambda x: better.log_density(x) - other.log_density(x))
    return out


def maximise(score: Callable[[dict[str, Value]], float], space: Bounds, *, max_evals: int, seed: int = 42, startup: int = 8,
             parallelism: int = 1) -> tuple[dict[str, Value], float, list[tuple[dict[str, Value], float]]]:
    """The best point, its score, and all trials in their order. The same seed
    and ``parallelism`` give the same trials."""
    rng = random.Random(seed)
    done: list[tuple[dict[str, Value], float]] = []
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        while len(done) < max_evals:
            batch: list[dict[str, Value]] = []
            while len(batch) < min(parallelism, max_evals - len(done)):
                first = len(done) + len(batch) < min(startup, max_evals)
                batch.append(random_draw(space, rng) if first else propose(space, done, batch, rng))
            done += list(zip(batch, pool.map(score, batch)))
    best, value = max(done, key=lambda t: t[1])
    return best, value, done
