"""Text quality: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

N-grams are those of the words and of their shapes (``Word***`` is ``Aa***``), so that words never seen still say
something. A family of n-grams (single words, pairs, single shapes, pairs, triples) gives each hash the share of
the text's n-grams it has; the score is the logistic function of one sparse dot product with the weights.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, byte_texts, per_worker, quoted, streamed, text_of
from sales_engine.llm.labelled import is_held_out, training_texts
from sales_engine.llm.remembered import Remembered

SLOTS = 1 << 18
TRAIN_ROWS = 10_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
#: Shares are multiplied by this, so that a whole text of one n-gram weighs as much as the bias does.
SCALE = 4.0
KNOWN_WORDS = 400_000
_KINDS = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Grams:
    """Hashes of words and shapes, remembered up to a bound."""

    def __init__(self):
        self.known = Remembered(KNOWN_WORDS, self._learn)

    @staticmethod
    def _learn(new: list[bytes]) -> np.ndarray:
        words = [xxhash.xxh3_64_intdigest(w, 1) for w in new]
        shapes = [xxhash.xxh3_64_intdigest(_RUNS.sub(rb"\1+", w.translate(_KINDS)), 2) for w in new]
        return np.array([words, shapes], np.uint64).T

    def families(self, text: bytes) -> list[np.ndarray]:
        """Slots of all n-grams of a text, a list for each family; slot 0 is the bias."""
        words = text.split()
        if not words:
            return []
        word, shape = self.known.rows_of(words).T
        out = []
        for salt, hashes, longest in ((1, word, 2), (2, shape, 3)):
            gram = hashes
            for n in range(1, longest + 1):
                if n > 1:
                    if len(words) < n:
                        break
                    gram = _mixed(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[n - 1 :])
                out.append((1 + (_mixed(gram + np.uint64(salt * 16 + n)) % np.uint64(SLOTS - 1))).astype(np.int64))
        return out


def sparse(families: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's vector, the bias first."""
    slots, values = [np.zeros(1, np.int64)], [np.ones(1)]
    for family in families:
        slot, many = np.unique(family, return_counts=True)
        slots.append(slot)
        values.append(SCALE * many / len(family))
    return np.concatenate(slots), np.concatenate(values)


def train(vectors: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal updates over the vectors in their order; the bias has no L1 penalty."""
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)
    l1 = np.full(SLOTS, L1)
    l1[0] = 0

    def weights(slots) -> np.ndarray:
        here = z[slots]
        free = np.abs(here) > l1[slots]
        return np.where(free, -(here - np.sign(here) * l1[slots]) / ((BETA + np.sqrt(n[slots])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for slots, values, label in vectors:
            # A slot that several families hit is updated once, by its sum.
            w = weights(slots)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / ALPHA
            z[slots] += g - sigma * w
            n[slots] += g * g
    return weights(np.arange(SLOTS)).astype(np.float32)


def _trainer(batches: Iterator[Arrays]) -> Iterator[Arrays]:
    grams, vectors = Grams(), []
    for texts, labels in batches:
        for text, label in zip(byte_texts(texts), labels.to_pylist(), strict=True):
            slots, values = sparse(grams.families(text))
            slots, place = np.unique(slots, return_inverse=True)
            vectors.append((slots.astype(np.int32), np.bincount(place, values).astype(np.float32), label))
    yield [[base64.b64encode(train(vectors).tobytes()).decode()]]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Weights learned from at most ``rows`` labelled rows that aren't held out, by one task, streaming.

    Without a labelled row all weights are 0 and every score one half.
    """
    sample = training_texts(docs, labels, label, rows, key, text)
    made = streamed(sample, [F.col("text"), F.col("label")], "weights string", _trainer).collect()
    return np.frombuffer(base64.b64decode(made[0].weights), np.float32) if made else np.zeros(SLOTS, np.float32)


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on).

    A null or wordless text has the bias alone. Equal texts have equal scores, whatever their other columns.
    ``weights`` has a fixed number of slots and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        grams = per_worker("quality-grams", Grams)
        w = shared.value.astype(np.float64)

        def work(columns: Arrays) -> Arrays:
            sums = [w[0] + SCALE * sum(w[f].sum() / len(f) for f in grams.families(t)) for t in byte_texts(columns[0])]
            return [(1 / (1 + np.exp(-np.clip(sums, -35, 35)))).tolist()]

        return work

    held = docs.withColumn("held_out", is_held_out(quoted(key)))
    scored = append(held, [text_of(held, text)], "score double", make)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
