"""Problem 5: splitting oversized texts at natural boundaries, with overlap, by content-defined landmarks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Width of the rolling hash in characters, and its multiplier.
WINDOW, BASE = 24, np.uint64(0x9E3779B97F4A7C15)
#: A landmark every so many characters on average, and how far a stronger boundary may lie from it.
LANDMARK_EVERY, REACH = 128, 48
# Unicode's white space, and sentence ends of scripts written without spaces.
WHITE = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], dtype=np.uint32)
WIDE_ENDS = np.array([ord(c) for c in "。！？"], dtype=np.uint32)
ENDS = np.array([ord(c) for c in ".!?。！？"], dtype=np.uint32)
LINES = np.array([10, 13, 0x85, 0x2028, 0x2029], dtype=np.uint32)


class Piece(NamedTuple):
    """[start, end) of a piece, where its new characters begin, and whether its end was forced."""

    start: int
    fresh: int
    end: int
    forced: bool


def boundaries(points: np.ndarray) -> np.ndarray:
    """Strength of a cut before each position (and at the end): 0 none, 1 beside white space or before 。！？,
    2 after white space or 。！？, 3 after a sentence's end, 4 after a line's end."""
    white = np.isin(points, WHITE)
    wide = np.isin(points, WIDE_ENDS)
    level = np.zeros(len(points) + 1, dtype=np.int8)
    level[:-1][white | wide] = 1
    after = level[1:]
    after[white | wide] = 2
    ended = np.isin(points, ENDS)
    sentence = wide.copy()
    sentence[1:] |= white[1:] & ended[:-1]
    after[sentence] = 3
    after[np.isin(points, LINES)] = 4
    level[0] = level[-1] = 4
    return level


def landmarks(points: np.ndarray) -> np.ndarray:
    """Positions after which a cut is suggested: where the hash of the last ``WINDOW`` characters is small."""
    if len(points) < WINDOW:
        return np.zeros(0, dtype=np.int64)
    wide = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    total = np.zeros(len(points) - WINDOW + 1, dtype=np.uint64)
    for k in range(WINDOW):
        total = total * BASE + wide[k : k + len(total)]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0x94D049BB133111EB)
    return np.flatnonzero((total >> np.uint64(40)) % np.uint64(LANDMARK_EVERY) == 0) + WINDOW


def split(text: str, size: int, overlap: int, least: int) -> list[Piece]:
    """Pieces of at most ``size`` characters that cover ``text``; the whole text as one piece if it fits.

    A piece's end is the last landmark that leaves it at least ``least`` new characters, moved to the nearest
    natural boundary (a stronger one within ``REACH`` is preferred); without landmark the last boundary. If
    there is no boundary within reach the cut is forced at ``size``. The next piece repeats ``overlap`` characters
    or a little less, to begin at a boundary, and fewer where that is needed to end at one.
    """
    n = len(text)
    if n <= size:
        return [Piece(0, 0, n, False)] if n else []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    level = boundaries(points)
    natural = np.flatnonzero(level)
    marks = landmarks(points)
    pieces: list[Piece] = []
    fresh = 0
    while fresh < n:
        start = fresh
        if fresh:
            start = max(0, fresh - overlap)
            i = np.searchsorted(natural, start)
            start = int(natural[i]) if i < len(natural) and natural[i] < fresh else start
        if n - start <= size:
            pieces.append(Piece(start, fresh, n, False))
            break
        ahead = natural[np.searchsorted(natural, fresh, "right") : np.searchsorted(natural, start + size, "right")]
        if len(ahead):
            low = min(fresh + least, start + size)
            near = marks[np.searchsorted(marks, low) : np.searchsorted(marks, start + size, "right")]
            cut = _snap(ahead, level, int(near[-1])) if len(near) else _snap(ahead, level, start + size)
            pieces.append(Piece(start, fresh, cut, False))
        else:
            i = np.searchsorted(natural, fresh, "right")
            cut = int(natural[i])  # the end of the text is always one
            if cut - fresh <= size:  # only a shorter overlap lets the piece end at a boundary
                start = cut - size
                j = np.searchsorted(natural, start)
                start = int(natural[j]) if natural[j] < fresh else min(start, fresh)
                pieces.append(Piece(start, fresh, cut, False))
            else:
                cut = start + size
                pieces.append(Piece(start, fresh, cut, True))
        fresh = cut
    return pieces


def _snap(ahead: np.ndarray, level: np.ndarray, mark: int) -> int:
    """The boundary in ``ahead`` nearest to ``mark``; a stronger one within ``REACH`` of it comes first."""
    within = ahead[np.searchsorted(ahead, mark - REACH) : np.searchsorted(ahead, mark + REACH, "right")]
    if not len(within):
        i = int(np.searchsorted(ahead, mark))
        around = ahead[max(0, i - 1) : i + 1]
        return int(around[np.argmin(np.abs(around - mark))])
    strength = level[within]
    best = within[strength == strength.max()]
    return int(best[np.argmin(np.abs(best - mark))])


def pieces(chunks: DataFrame, size: int, overlap: int, least: int | None = None, with_text: bool = True) -> DataFrame:
    """(source, idx, piece_no, text, start_char, fresh_char, end_char, forced) of every text over ``size`` characters.

    ``text`` is missing if not ``with_text``. Pieces number from 0 within a text; joining each piece's characters
    from ``fresh_char`` on gives the text back. Texts that are null, empty or fit give no rows; copies of a row
    count once; different texts under one (source, idx) are split each. Null keys are kept. Characters are code points.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    least = size // 3 if least is None else least
    rows = chunks.select("source", "idx", "text").where(F.length("text") > size).distinct()
    schema = "source string, idx int, piece_no int, start_char int, fresh_char int, end_char int, forced boolean" + ", text string" * with_text

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            out = []
            for source, idx, text in zip(batch["source"], batch["idx"], batch["text"]):
                idx = None if pd.isna(idx) else int(idx)
                for k, p in enumerate(split(text, size, overlap, least)):
                    out.append((source, idx, k, p.start, p.fresh, p.end, p.forced, *([text[p.start : p.end]] if with_text else [])))
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({"idx": "Int32"})

    return rows.mapInPandas(cut, schema)


def kinds(chunks: DataFrame, size: int, overlap: int) -> DataFrame:
    """(source, idx, kind) of every text over ``size`` characters: ``forced`` if a piece had to end inside a run
    without boundary, else ``natural``."""
    cut = pieces(chunks, size, overlap, with_text=False)
    return cut.groupBy("source", "idx").agg(F.when(F.bool_or("forced"), "forced").otherwise("natural").alias("kind"))
