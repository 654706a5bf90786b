"""Runs of words in texts, and a mark in each that equal runs share, vectorised over a block of texts.

The mark of a run is the least hash of the ``MARK_WORDS`` consecutive words in it. Neighbouring runs mostly have one
mark, so a text has few marks, and a run occurs in two texts only if its mark does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from sales_engine.llm.phrases import RangeHash, mixed

MARK_WORDS = 20
BLOCK_WORDS = 1 << 16


def word_runs(texts: list[bytes], words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, mark and hash of every run of ``words`` words (parted by blanks), a block of texts at a time."""
    many, at, parts = [], [], []
    for i, text in enumerate(texts):
        found = text.split()
        if len(found) >= words:
            many.append(len(found))
            at.append(i)
            parts += map(xxhash.xxh3_64_intdigest, found)
        if len(parts) >= BLOCK_WORDS:
            yield _block(np.array(parts, np.uint64), np.repeat(at, many), words)
            many, at, parts = [], [], []
    if parts:
        yield _block(np.array(parts, np.uint64), np.repeat(at, many), words)


def _block(parts: np.ndarray, text: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, base = len(parts), 0x5851F42D4C957F2D
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(parts * RangeHash.progression(base, n)[:n], out=running[1:])
    back = RangeHash.progression(pow(base, -1, 2**64), n)

    def of(size: int) -> np.ndarray:
        return mixed((running[size:] - running[: n - size + 1]) * back[: n - size + 1])

    least, step, reach = of(MARK_WORDS), 1, words - MARK_WORDS + 1
    while 2 * step <= reach:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < reach:
        least = np.minimum(least[: step - reach], least[reach - step :])
    inside = np.flatnonzero(text[: n - words + 1] == text[words - 1 :])
    return text[inside], least[inside].view(np.int64), of(words)[inside].view(np.int64)


def once(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once a text."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]
