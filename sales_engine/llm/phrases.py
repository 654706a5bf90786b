"""Content-defined phrases of byte strings and hashes of any of their ranges, vectorised over a block of texts.

A *start* is a place where a string of ``length`` bytes begins. Its *trigger* is the place of the least rolling
hash (the last one of equals) among the ``REACH`` places from the start on. The trigger depends on the first
bytes of the string only, so equal strings have their triggers at equal distances, wherever they stand. Starts
that share a trigger are neighbours; the bytes from the first of them to the trigger are a *phrase*, shorter
than ``REACH``. What follows the trigger is the context, that is the parse from there on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

TRIGGER_BYTES = 16
REACH = 128
BLOCK = 192 * 1024


class Phrases(NamedTuple):
    """One row a phrase: text, trigger, first and last start (places within the text), hashes."""

    text: np.ndarray
    trigger: np.ndarray
    first: np.ndarray
    last: np.ndarray
    context: np.ndarray  # of the bytes after the trigger that all strings of the phrase share
    whole: np.ndarray  # of all bytes that these strings cover, and of their number and distances


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class RangeHash:
    """Polynomial hash modulo 2^64 over random values of the bytes; any range costs one product."""

    def __init__(self, size: int):
        rng = np.random.default_rng(20_231)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x5851F42D4C957F2D
        self.powers = self.progression(base, size)
        self.back = self.progression(pow(base, -1, 2**64), size)

    @staticmethod
    def progression(base: int, size: int) -> np.ndarray:
        out = np.full(size + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    def running(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((running[end] - running[start]) * self.back[start])


def context_bytes(length: int) -> int:
    """Bytes after a trigger that every string of its phrase covers."""
    return length - REACH + 1


def _block(hashes: RangeHash, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, own: int, length: int):
    """Phrases of the starts before ``own``; ``begins`` and ``ends`` of the texts in ``data``."""
    starts = np.concatenate([np.arange(b, min(e - length + 1, own)) for b, e in zip(begins, ends, strict=True)] or [[]])
    if not len(starts):
        return None
    starts = starts.astype(np.int64)
    n = len(data) - TRIGGER_BYTES + 1
    running = hashes.running(data)
    rolling = mixed((running[TRIGGER_BYTES:] - running[:n]) * hashes.back[:n])
    low = np.uint64(0xFFFFFFFF)
    least = (rolling & ~low) | (low - np.arange(n, dtype=np.uint64))
    step = 1
    while step < REACH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    trigger = (low - (least[starts] & low)).astype(np.int64)
    text = np.searchsorted(ends, starts, side="right")
    new = np.ones(len(starts), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    first, last, trigger, text = starts[at], starts[np.append(at[1:], len(starts)) - 1], trigger[at], text[at]
    context = hashes.of(running, trigger, trigger + context_bytes(length))
    shape = (trigger - first) * REACH + (trigger - last)
    whole = mixed(hashes.of(running, first, last + length) + shape.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return Phrases(text, trigger, first, last, context, whole)


def phrases(texts: list[bytes], length: int, hashes: RangeHash) -> Iterator[Phrases]:
    """Phrases of all texts, a block at a time; a long text is cut into overlapping blocks.

    A phrase that a block's border splits comes as two rows with fewer starts each; no start is lost or doubled.
    """
    waiting: list[int] = []
    size = 0

    def together() -> Iterator[Phrases]:
        ends = np.cumsum([len(texts[i]) for i in waiting])
        begins = ends - [len(texts[i]) for i in waiting]
        data = np.frombuffer(b"".join([texts[i] for i in waiting]), np.uint8)
        found = _block(hashes, data, begins, ends, len(data), length)
        if found is not None:
            at = begins[found.text]
            yield found._replace(
                text=np.array(waiting)[found.text], trigger=found.trigger - at, first=found.first - at, last=found.last - at
            )

    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        if len(text) > BLOCK:
            for at in range(0, len(text) - length + 1, BLOCK):
                data = np.frombuffer(text[at : at + BLOCK + length + REACH + TRIGGER_BYTES], np.uint8)
                found = _block(hashes, data, np.array([0]), np.array([len(data)]), BLOCK, length)
                if found is not None:
                    yield found._replace(
                        text=np.full(len(found.text), i), trigger=found.trigger + at, first=found.first + at, last=found.last + at
                    )
            continue
        waiting.append(i)
        size += len(text)
        if size >= BLOCK:
            yield from together()
            waiting, size = [], 0
    if waiting:
        yield from together()


def range_hash() -> RangeHash:
    return RangeHash(3 * BLOCK + 4096)
