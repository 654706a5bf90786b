"""Toxicity: a lexicon in a trie, intersected with Levenshtein automata, and scores of the words around each hit.

The lexicon is learned: words and word beginnings that labelled toxic texts have and others do not. Words are run
through the product of the trie and the automata of its terms, a deterministic automaton whose states are made
as words need them, so a term with a letter changed, added or left out is found in one pass over the word. A
hit counts in full, more when someone is addressed, less inside quotation marks or after a word of reporting;
a small logistic regression weighs exact and misspelled, plain and quoted hits. What a quotation takes off is set by hand,
and so are the weights of quoted hits where the labelled texts have none (``PRIOR``).
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, quoted, streamed, text_of
from sales_engine.llm.labelled import is_held_out, training_texts

TRAIN_ROWS = 10_000
#: A term's texts must be toxic to this share, and as many.
CLEAN, LEAST_TEXTS, LEAST_SHARE = 0.95, 6, 0.01
#: A longer beginning stands for a shorter one if it has this share of its texts.
SAME = 0.95
#: Near copies share of all their words, and of all their runs of three words, at least so much.
SAME_WORDS, SAME_RUNS = 0.8, 0.4
#: Texts are compared if so many of the least hashes of their runs are equal: near copies are missed once in 50,000.
HASHES, LEAST_VOTES = 32, 3
_ODD = np.random.default_rng(8).integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
SHORTEST, LONGEST = 3, 8
#: Letters a term must have for one and for two errors.
ONE_ERROR, TWO_ERRORS = 5, 9
WINDOW = 6
KNOWN_WORDS = 300_000
_WORD = re.compile(r"[^\W_]+")
_OPEN, _CLOSE = "\"“„«‹‘", "\"”“»›’"
REPORTING = frozenset(
    "said says say wrote writes called calls quote quoted quotes reported word words term terms dit écrit mot mots "
    "sagte schrieb wort wörter dijo escribió palabra palabras".split()
)
ADDRESS = frozenset("you your youre yourself u tu toi vous votre du dich dir ihr sie tú te usted ustedes".split())
QUOTED, PLAIN, ADDRESSED = 0.25, 1.0, 1.5
#: Weights before anything is learned: bias, then plain exact, plain misspelled, quoted exact, quoted misspelled
#: hits (logarithms of one plus their context scores), then hits per hundred words. Learning starts from these.
PRIOR = np.array([-3.0, 4.0, 2.0, 1.0, 0.5, 0.5])
PRIOR_STRENGTH = 0.05


class Automaton:
    """Trie of terms times Levenshtein automata: the least number of errors with which a word is some term.

    A term ending in ``*`` is a word's beginning. A state is the set of (trie node, errors so far) that a word's
    first letters can reach; ``steps`` holds those transitions that some word has needed.
    """

    def __init__(self, terms: Sequence[str]):
        self.children: list[dict[str, int]] = [{}]
        self.limit, self.word, self.start = [-1], [-1], [-1]
        for term in terms:
            letters, kinds = term.rstrip("*"), self.start if term.endswith("*") else self.word
            errors = (len(letters) >= ONE_ERROR) + (len(letters) >= TWO_ERRORS)
            node = 0
            for letter in letters:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    for column in (self.limit, self.word, self.start):
                        column.append(-1)
                self.limit[node] = max(self.limit[node], errors)
                node = self.children[node][letter]
            self.limit[node], kinds[node] = max(self.limit[node], errors), max(kinds[node], errors)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.at_end: list[int] = []
        self.so_far: list[int] = []
        self.first = self._state({(0, 0)})

    def _state(self, reached: set[tuple[int, int]]) -> int:
        queue = list(reached)
        for node, errors in queue:  # a letter of the term may be missing
            for child in self.children[node].values():
                if errors < self.limit[child] and (child, errors + 1) not in reached:
                    reached.add((child, errors + 1))
                    queue.append((child, errors + 1))
        least: dict[int, int] = {}
        for node, errors in reached:
            least[node] = min(errors, least.get(node, 99))
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.at_end.append(min([e for n, e in key if e <= self.word[n]], default=99))
            self.so_far.append(min([e for n, e in key if e <= self.start[n]], default=99))
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        reached = set()
        for node, errors in self.sets[state]:
            for own, child in self.children[node].items():
                if own == letter:
                    reached.add((child, errors))
                elif errors < self.limit[child]:
                    reached.add((child, errors + 1))  # another letter instead
            if errors < self.limit[node]:
                reached.add((node, errors + 1))  # a letter too many
        new = self.steps[state][letter] = self._state(reached)
        return new

    def errors(self, word: str) -> int:
        """Errors with which the word is a term, 99 if it is none."""
        state, best = self.first, 99
        for letter in word:
            step = self.steps[state].get(letter)
            state = self._step(state, letter) if step is None else step
            if self.so_far[state] < best:
                best = self.so_far[state]
            if not self.sets[state]:
                return best
        return min(best, self.at_end[state])


class Reader:
    """Finds and weighs the hits of a text."""

    def __init__(self, terms: Sequence[str]):
        self.automaton = Automaton(terms)
        self.known: dict[str, int] = {}

    def kind(self, word: str) -> int:
        """0: no term, 1: a term, 2: a misspelled one."""
        kind = self.known.get(word)
        if kind is None:
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            errors = self.automaton.errors(word)
            kind = self.known[word] = 0 if errors == 99 else 1 + (errors > 0)
        return kind

    def kinds(self, words: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.known.__getitem__, words), np.int8, len(words))
        except KeyError:
            return np.fromiter(map(self.kind, words), np.int8, len(words))

    def features(self, text: str) -> np.ndarray:
        """Figures for the regression."""
        text = text.lower()
        words = _WORD.findall(text)
        kinds = self.kinds(words)
        hits = np.flatnonzero(kinds)
        out = np.zeros(len(PRIOR))
        out[0] = 1
        if not len(hits):
            return out
        spans = [m.span() for m in _WORD.finditer(text)]
        for at in hits.tolist():
            quoted_hit, weight = self._context(text, words, spans, at)
            out[1 + (kinds[at] == 2) + 2 * quoted_hit] += weight
        rate = out[1:5].sum() / len(words) * 100
        out[1:5] = np.log1p(out[1:5])
        out[5] = min(rate, 5.0)
        return out

    @staticmethod
    def _context(text: str, words: list[str], spans: list[tuple[int, int]], at: int) -> tuple[bool, float]:
        first, last = max(0, at - WINDOW), min(len(words) - 1, at + WINDOW)
        before, after = text[spans[first][0] : spans[at][0]], text[spans[at][1] : spans[last][1] + 1]
        near = words[first:at] + words[at + 1 : last + 1]
        opened = max(before.rfind(c) for c in _OPEN)
        inside = opened >= 0 and before[opened + 1 :].count("\n") == 0 and any(c in after for c in _CLOSE)
        if inside or not REPORTING.isdisjoint(words[first:at]):
            return True, QUOTED
        return False, PLAIN if ADDRESS.isdisjoint(near) else ADDRESSED


def _forms(word: str) -> list[str]:
    """A word and its beginnings, the shortest first."""
    starts = [word[:n] + "*" for n in range(SHORTEST, min(len(word), LONGEST) + 1)]
    return [*starts, word] if len(word) >= SHORTEST else []


def _runs(words: Sequence[str]) -> np.ndarray:
    """Hashes of the distinct runs of three words, of all words if they are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = [" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2))]
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, joined), np.uint64, len(joined)))


def _alike(one: int, other: int, both: int) -> float:
    return both / (one + other - both)


def grouped(texts: Iterable[tuple[Sequence[str], int]]) -> list[tuple[set[str], int]]:
    """Distinct words and label of each text, where near copies of one label are one with the words of all.

    A term must occur in texts that are unlike, or a copied text's every word would be one. A text is a near copy of
    an earlier one if at least ``SAME_WORDS`` of the words and ``SAME_RUNS`` of the runs of three words of both are
    the same: texts with one vocabulary share words, not runs. Least hashes of the runs only say which to compare.
    """
    groups: list[tuple[set[str], int]] = []
    firsts: list[tuple[frozenset[str], np.ndarray]] = []
    buckets: dict[tuple[int, int, int], list[int]] = {}
    for words, label in texts:
        own, runs = frozenset(words), _runs(words)
        least = [(label, i, int((runs * odd).min())) for i, odd in enumerate(_ODD)] if len(runs) else []
        votes = Counter(at for bucket in least for at in buckets.get(bucket, ()))
        for at in sorted(at for at, many in votes.items() if many >= LEAST_VOTES):
            first, first_runs = firsts[at]
            if min(len(own), len(first)) < SAME_WORDS * max(len(own), len(first)):
                continue
            if _alike(len(own), len(first), len(own & first)) < SAME_WORDS:
                continue
            if _alike(len(runs), len(first_runs), len(np.intersect1d(runs, first_runs, assume_unique=True))) >= SAME_RUNS:
                groups[at][0].update(own)
                break
        else:
            for bucket in least:
                buckets.setdefault(bucket, []).append(len(groups))
            groups.append((set(own), label))
            firsts.append((own, runs))
    return groups


def learn_terms(texts: Iterable[tuple[Sequence[str], int]]) -> list[str]:
    """Words and beginnings (``term*``) whose texts are toxic; ``texts`` has each text's words in order and its label.
    Every text counts, near copies of one label as one text.

    Of the clean beginnings of one word the shortest counts, made longer as long as it covers the same texts. Those
    of a hundredth of all toxic texts are taken, then those that cover most of the toxic texts without a term.
    """
    texts = grouped(texts)
    per_text = [{t for w in words for t in _forms(w)} for words, label in texts if label]
    counts = Counter(t for terms in per_text for t in terms)
    hits = {t: n for t, n in counts.items() if n >= LEAST_TEXTS}
    of_word = {w: [t for t in _forms(w) if t in hits] for w in {w for words, label in texts if not label for w in words}}
    misses = Counter(t for words, label in texts if not label for t in {t for w in words for t in of_word[w]})
    clean = {t for t, n in hits.items() if n >= CLEAN * (n + misses[t])}
    longer: dict[str, str] = {}
    for term in sorted(clean, key=len):
        first = next(t for t in [*_forms(term.rstrip("*")), term] if t in clean)
        if hits[term] >= SAME * hits[first]:
            longer[first] = term  # the longest comes last
    for term in list(longer.values()):  # a whole word rather than its beginning
        word = term.rstrip("*")
        if word in clean and hits[word] >= SAME * hits[term]:
            longer[next(t for t, own in longer.items() if own == term)] = word
    heads = set(longer.values())
    enough = max(LEAST_TEXTS, LEAST_SHARE * len(per_text))
    terms = {t for t in heads if hits[t] >= enough}
    left = [c for c in (own & heads for own in per_text) if c and not c & terms]
    while left:  # a term covers some texts more each time, so there are fewer terms than toxic texts
        gains = Counter(t for c in left for t in c)
        best = min(gains, key=lambda t: (-gains[t], len(t), t))
        if gains[best] < LEAST_TEXTS:
            break
        terms.add(best)
        left = [c for c in left if best not in c]
    return sorted(terms, key=lambda t: (-hits[t], t))


def _regress(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards ``PRIOR`` where the texts say little."""
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + PRIOR_STRENGTH * len(PRIOR) * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * len(PRIOR) * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w - np.clip(step, -2, 2)
    w[1:] = np.maximum(w[1:], 0)  # a hit never speaks for a text
    return w


def _trainer(batches: Iterator[Arrays]) -> Iterator[Arrays]:
    names: dict[str, str] = {}
    texts = []
    kept = []
    for column, labels in batches:
        for text, label in zip(column.to_pylist(), labels.to_pylist(), strict=True):
            texts.append(([names.setdefault(w, w) for w in _WORD.findall(text.lower())], label))
            kept.append(text)
    terms = learn_terms(texts)
    reader = Reader(terms)
    x = np.array([reader.features(t) for t in kept])
    y = np.array([label for _, label in texts], float)
    weights = _regress(x, y) if terms else PRIOR
    yield [[json.dumps({"terms": terms, "weights": list(weights)})]]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text") -> dict:
    """Lexicon and weights learned from at most ``rows`` labelled rows that aren't held out, by one task.

    Without labelled rows the lexicon is empty and every score the prior's.
    """
    sample = training_texts(docs, labels, label, rows, key, text)
    made = streamed(sample, [F.col("text"), F.col("label")], "model string", _trainer).collect()
    return json.loads(made[0].model) if made else {"terms": [], "weights": list(PRIOR)}


def score(docs: DataFrame, model: dict, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``held_out``, ``score``, ``hits`` and ``predicted`` (1 from ``threshold`` on).

    ``hits`` is the context-weighted number of terms per hundred words, at most 5. A null or empty text has no
    hits. Equal texts have equal scores, whatever their other columns. The model's size is bounded by the rows it
    was learned from.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        reader = Reader(shared.value["terms"])
        weights = np.array(shared.value["weights"])

        def work(columns: Arrays) -> Arrays:
            x = np.array([reader.features(t or "") for t in columns[0].to_pylist()])
            scores = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            return [scores.tolist(), x[:, 5].tolist()]

        return work

    held = docs.withColumn("held_out", is_held_out(quoted(key)))
    scored = append(held, [text_of(held, text)], "score double, hits double", make)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
