"""Words of whole texts as numbers, a bounded block at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 4 * 1024 * 1024
SPACE, BREAK = 0x20, 0x0A


class Words(NamedTuple):
    """One entry a word, in order; ``words`` are the different ones that ``codes`` number."""

    codes: np.ndarray
    words: list[bytes]
    text: np.ndarray  # which text the word is of
    piece: np.ndarray  # words of one piece have one number, so a run of words within a piece begins and ends with it
    fresh: np.ndarray  # False for words that only lead up to a block's first own word; an earlier block has counted them


def byte_table(spaces: bytes, breaks: bytes = b"") -> bytes:
    """For ``bytes.translate``: A-Z lower-cased, bytes between words and bytes between pieces each as one byte."""
    table = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        table[upper] = upper + 32
    for byte in spaces:
        table[byte] = SPACE
    for byte in breaks:
        table[byte] = BREAK
    return bytes(table)


#: Words of the contract's class [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower-cased.
ALPHANUMERIC = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))


def _parts(text: bytes, context: int, size: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts that end between words, each led up to by the ``context`` words before it."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > size:
            cut = max(text.rfind(b" ", at + 1, at + size), text.rfind(b"\n", at + 1, at + size))
            if cut < 0:
                cut = min((c for c in (text.find(b" ", at + size), text.find(b"\n", at + size)) if c >= 0), default=end)
            end = cut
        before = at
        for _ in range(context if at else 0):
            while before and text[before - 1] in b" \n":
                before -= 1
            before = max(text.rfind(b" ", 0, before), text.rfind(b"\n", 0, before)) + 1
        yield text[before:end], at - before
        at = end


def _block(parts: list[bytes], owners: list[int], leads: list[int]) -> Words:
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    inside = (data != SPACE) & (data != BREAK)
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = pa.py_buffer(data[inside].tobytes())
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), letters]).dictionary_encode()
    begins = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
    part = np.searchsorted(begins, starts, side="right") - 1
    return Words(
        coded.indices.to_numpy().astype(np.int64),
        coded.dictionary.to_pylist(),
        np.array(owners)[part],
        np.searchsorted(np.flatnonzero(data == BREAK), starts),
        starts - begins[part] >= np.array(leads)[part],
    )


def blocks(texts: list[bytes], table: bytes, context: int, size: int = BLOCK) -> Iterator[Words]:
    """All words of the texts, some megabytes at a time, however long a text is.

    A run of up to ``context + 1`` words lies wholly in the block whose fresh word it ends with.
    """
    parts, owners, leads, held = [], [], [], 0
    for i, text in enumerate(texts):
        for part, lead in _parts(text.translate(table), context, size):
            parts.append(part)
            owners.append(i)
            leads.append(lead)
            held += len(part)
            if held >= size:
                yield _block(parts, owners, leads)
                parts, owners, leads, held = [], [], [], 0
    if parts:
        yield _block(parts, owners, leads)
