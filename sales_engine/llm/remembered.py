"""What a worker has worked out for the strings it has met, up to a bound."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import repeat

import numpy as np

FREQUENT = 3


class Remembered:
    """A row of numbers for each string, worked out once by ``learn``, which gets lists of new strings.

    Beyond ``most`` strings only those in frequent use are kept, a tenth of them at most, so memory is bounded and
    common strings stay. If rows depend on what else is known, ``rebuild`` makes those of the strings that stay.
    """

    def __init__(self, most: int, learn: Callable[[list], np.ndarray], rebuild: Callable[[list], np.ndarray] | None = None):
        self.most, self.learn, self.rebuild = most, learn, rebuild
        self.codes: dict = {}
        self.uses = np.zeros(1024, np.int64)
        self.all_rows: np.ndarray | None = None

    def codes_of(self, items: Sequence) -> np.ndarray:
        """Numbers of the strings, valid until the next call."""
        if len(self.codes) > self.most:
            self._shrink()
        found = np.fromiter(map(self.codes.get, items, repeat(-1)), np.int64, len(items))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            unknown = [items[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unknown))
            self._append(self.learn(new), len(self.codes))
            self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new)), strict=True))
            found[missing] = np.fromiter(map(self.codes.__getitem__, unknown), np.int64, len(unknown))
        np.add.at(self.uses, found, 1)
        return found

    def rows_of(self, items: Sequence) -> np.ndarray:
        """The strings' rows."""
        codes = self.codes_of(items)
        return self.all_rows[codes] if self.all_rows is not None else np.zeros((0,), np.int64)

    def _append(self, rows: np.ndarray, first: int) -> None:
        if self.all_rows is None:
            self.all_rows = np.zeros((1024, *rows.shape[1:]), rows.dtype)
        while len(self.all_rows) < first + len(rows):
            self.all_rows = np.concatenate([self.all_rows, np.zeros_like(self.all_rows)])
        while len(self.uses) < first + len(rows):
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.all_rows[first : first + len(rows)] = rows

    def _shrink(self) -> None:
        uses = self.uses[: len(self.codes)]
        stay = np.flatnonzero(uses >= FREQUENT)
        stay = np.sort(stay[np.argsort(-uses[stay], kind="stable")[: self.most // 10]])
        names = list(self.codes)
        names = [names[i] for i in stay.tolist()]
        rows = self.all_rows[stay] if self.rebuild is None else self.rebuild(names)
        self.codes = dict(zip(names, range(len(names)), strict=True))
        self.uses[:] = 0
        self._append(rows, 0)
