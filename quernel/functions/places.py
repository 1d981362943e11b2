"""Texts compared place by place, on arrays of code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Elements that one step of ``close_pairs`` compares at most (one text more); how much longer than its first the
#: last text of a slab is.
ELEMENTS = 1 << 22
SLAB = 1.25


def run_size(threshold: float) -> int:
    """Places of a run, so few that some runs of close texts are equal."""
    return max(1, int(0.8 / max(1 - threshold, 0.1) + 1e-9))


class Texts:
    """Texts as code points, each beginning at a multiple of ``size``, and a byte for each run of ``size`` places. Must be sorted by
    length."""

    def __init__(self, texts: list[str], size: int) -> None:
        self.size = size
        self.n = np.fromiter(map(len, texts), np.int64, len(texts))
        runs = -(-self.n // size)
        self.first = np.cumsum(runs) - runs
        self.points = np.frombuffer("".join([t.ljust(r * size, "\0") for t, r in zip(texts, runs.tolist())]).encode("utf-32-le", "surrogatepass"), np.uint32)
        digest = np.zeros(len(self.points) // size, np.uint32)
        for k in range(size):
            digest = digest * np.uint32(16777619) + self.points[k::size]
        self.runs = ((digest * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)

    def digests(self, lo: int, hi: int, width: int) -> np.ndarray:
        """The bytes of the first ``width`` runs of texts ``lo`` to ``hi``, a column for each text; beyond its end anything."""
        at = self.first[lo:hi][None, :] + np.arange(width)[:, None]
        return np.take(self.runs, at, mode="clip")


def close_pairs(left: Texts, right: Texts, least: float, within: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, js, equal): texts ``js`` of ``right`` that agree with text ``i`` of ``left`` in ``equal`` places, a share of at least
    ``least`` of the longer one's. ``within``: both are the same texts, and each pair comes once.

    No pair is missed: each place that differs spoils one run of places at most, so close texts have a known number of equal
    runs. Those that have as many equal bytes are compared place by place.
    """
    size, spared = left.size, lambda n: np.floor((1 - least) * n + 1e-9).astype(np.int64)
    begin = np.searchsorted(right.n, np.ceil(left.n * least - 1e-6), "left")
    end = np.searchsorted(right.n, np.floor(left.n / least + 1e-6), "right")
    if within:
        begin = np.maximum(begin, np.arange(len(left.n)) + 1)
    a = 0
    while a < len(left.n):
        b = int(np.searchsorted(left.n, left.n[a] * SLAB, "right"))
        lo, hi = int(begin[a]), int(end[b - 1])
        known, need = -1, None
        columns = right.digests(lo, hi, int(left.n[b - 1]) // size) if lo < hi else None
        for i in range(a, b):
            f, g, n = int(begin[i]), int(end[i]), int(left.n[i])
            if f >= g:
                continue
            s = n // size
            kind = np.uint8 if s < 256 else np.uint32
            if n != known:
                known, shorter, longer = n, np.minimum(n, right.n[lo:hi]), np.maximum(n, right.n[lo:hi])
                need = np.clip(shorter // size - spared(longer) + longer - shorter, 0, s).astype(kind)
            own = left.runs[left.first[i] : left.first[i] + s]
            same = columns[:s, f - lo : g - lo] == own[:, None]
            js = np.flatnonzero(np.add.reduce(same.view(np.uint8), axis=0, dtype=kind) >= need[f - lo : g - lo]) + f
            step = max(1, ELEMENTS // max(n, 1))
            for k in range(0, len(js), step):
                some = js[k : k + step]
                equal = _equal(left.points[left.first[i] * size : left.first[i] * size + n], right, some)
                close = equal >= least * np.maximum(n, right.n[some]) - 1e-6
                if close.any():
                    yield i, some[close], equal[close]
        a = b


def _equal(own: np.ndarray, right: Texts, js: np.ndarray) -> np.ndarray:
    """In how many places ``own`` and texts ``js`` agree."""
    places = np.arange(len(own))
    same = np.take(right.points, (right.first[js] * right.size)[:, None] + places, mode="clip") == own
    return np.count_nonzero(same & (places < right.n[js][:, None]), axis=1)


@F.pandas_udf(DoubleType())
def share_equal(x: pd.Series, y: pd.Series) -> pd.Series:
    """Share of equal places over the longer of two texts; null if both are empty or one is null."""

    def share(a: str | None, b: str | None) -> float | None:
        if a is None or b is None or not (a or b):
            return None
        p, q = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
        n = min(len(p), len(q))
        return float(np.count_nonzero(p[:n] == q[:n])) / max(len(p), len(q))

    return pd.Series([share(a, b) for a, b in zip(x, y)], dtype="float64")
