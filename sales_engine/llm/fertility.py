"""Quality rules on how well public vocabularies fit a text: tokeniser fertility, with bands per language or script.

A byte-level BPE vocabulary gives characters per token, the share of tokens that are not whole characters, and
the entropy of the text's tokens. A SentencePiece vocabulary with byte fallback gives characters per piece of
the text's words and the share of pieces that are single bytes. Typical values differ by language, so each figure
is held against a band around the median of the texts of its language and script, as wide as these texts spread. Medians
and deviations come from exact histograms over all texts that pass the basic rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, append, byte_texts, per_worker, quoted
from sales_engine.llm.remembered import Remembered
from sales_engine.llm.tables import written

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
LEAST_WORDS = 50
MOST_REPEATED = 0.5
#: Distinct words whose piece counts a worker remembers.
KNOWN_WORDS = 400_000
#: Bytes of text whose words are looked up together.
BLOCK = 1 << 20
#: First code points of scripts; what lies before them, or between two, belongs to the one before.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"),
]

#: Figure: steps of its histogram to one unit; whether it may be too low, too high; half the width that a band has at
#: least (shares of which most texts have none have no deviation either).
BANDS = {
    "chars_per_token": (256, True, True, 0.0),
    "chars_per_piece": (256, True, True, 0.0),
    "broken_share": (4096, False, True, 0.1),
    "byte_share": (4096, False, True, 0.05),
    "token_entropy": (256, True, False, 0.0),
}
#: Half a band in median deviations: about four standard deviations of a normal figure.
WIDTH = 6.0
#: A group is a language and script. Its median and deviation are drawn towards those of the script, and these towards
#: those of all texts, and these towards ``PRIOR``, as if the wider group had so many texts. So a small group has a wide band,
#: and nothing changes at any one size.
LEVELS = [("spoken", "script"), ("script",), ()]
DRAWN_TEXTS = 50
#: Median and deviation before any text is seen: about what public vocabularies reach on prose of alphabetic scripts.
PRIOR = {
    "chars_per_token": (4.2, 0.4),
    "chars_per_piece": (4.0, 0.4),
    "broken_share": (0.0, 0.04),
    "byte_share": (0.0, 0.02),
    "token_entropy": (6.5, 0.5),
}

BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
FIGURES = "script string, " + ", ".join(f"{name} double" for name in BANDS)


class Words:
    """Known words, each with the numbers of its pieces and of its byte pieces."""

    def __init__(self, model: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.known = Remembered(KNOWN_WORDS, self._learn)

    def _learn(self, new: list[bytes]) -> np.ndarray:
        lists = self.pieces.encode([w.decode("utf-8", "replace") for w in new])
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        single = np.concatenate([[0], np.cumsum(self.is_byte[ids])])
        ends = np.cumsum(sizes)
        return np.stack([sizes, single[ends] - single[ends - sizes]], axis=1)


def repeated_words(codes: np.ndarray) -> int:
    """Words in windows of three that occur twice or more."""
    if len(codes) < 4:
        return 0
    many = int(codes.max()) + 1
    if many < 2**20:
        windows = (codes[:-2] * many + codes[1:-1]) * many + codes[2:]
    else:  # a text of over a million words: number the pairs first
        pairs = np.unique(codes[:-1] * many + codes[1:], return_inverse=True)[1]
        windows = pairs[:-1] * many + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(len(codes), bool)
    hit = np.concatenate([order[1:][same], order[:-1][same]])
    for i in range(3):
        again[hit + i] = True
    return int(again.sum())


def entropy(ids: np.ndarray) -> float:
    """Bits per token of the tokens' own distribution."""
    counts = np.bincount(ids) if len(ids) > 4096 else np.unique(ids, return_counts=True)[1]
    share = counts[counts > 0] / len(ids)
    return float(-(share * np.log2(share)).sum())


def script_of(text: str, ascii_letters: int) -> str:
    """The script of most letters."""
    if 2 * ascii_letters >= len(text) - text.count(" ") or not text:
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    kinds = np.searchsorted([s for s, _ in SCRIPTS], points[(points > 0x7F) & (points < 0xFFF0)], side="right") - 1
    votes: dict[str, int] = {"latin": ascii_letters}
    for kind, many in zip(*np.unique(kinds, return_counts=True), strict=True):
        votes[SCRIPTS[kind][1]] = votes.get(SCRIPTS[kind][1], 0) + int(many)
    return max(sorted(votes), key=votes.get)


_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_NOT_LETTERS = bytes(sorted(set(range(256)) - set(_LETTERS)))


def _figures(encoder: Callable[[], object], model: str):
    def make():
        bpe = per_worker("byte_bpe_50k", encoder)
        words_of = per_worker(model, lambda: Words(model))
        if not hasattr(bpe, "broken"):
            bpe.broken = np.array([_broken(bpe.fast.decode_single_token_bytes(i)) for i in range(bpe.fast.n_vocab)])

        def figures(raws: list[bytes]) -> Iterator[tuple]:
            lists = [raw.split() for raw in raws]
            codes = words_of.known.codes_of([w for words in lists for w in words])
            counts = words_of.known.all_rows[codes] if len(codes) else np.zeros((0, 2), np.int64)
            end = 0
            for raw, words in zip(raws, lists, strict=True):
                text = raw.decode("utf-8", "replace")
                lines = [line for line in raw.split(b"\n") if line.strip()]
                begin, end = end, end + len(words)
                word_chars = len(text) - (len(raw) - len(raw.translate(None, SPACE)))
                letters = len(raw.translate(None, _NOT_LETTERS))
                found = [None] * len(BANDS)
                if words:
                    ids = bpe.ids(text)
                    pieces, single = counts[begin:end].sum(axis=0).tolist()
                    found = [len(text) / len(ids), word_chars / pieces, float(bpe.broken[ids].mean()), single / pieces, entropy(ids)]
                yield (
                    len(words), word_chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
                    repeated_words(codes[begin:end]), script_of(text, letters), *found,
                )

        def work(columns: Arrays) -> Arrays:
            rows, waiting, size = [], [], 0
            for raw in byte_texts(columns[0]):
                waiting.append(raw)
                size += len(raw)
                if size >= BLOCK:
                    rows += figures(waiting)
                    waiting, size = [], 0
            rows += figures(waiting)
            return list(map(list, zip(*rows, strict=True)))

        return work

    return make


def _broken(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return True
    return False


def at_levels(groups: DataFrame) -> DataFrame:
    """Each row once a level, with the columns that the level goes by as ``by_spoken, by_script`` and the others null."""
    none = F.lit(None).cast("string")
    keys = [
        F.struct(F.lit(i).alias("level"), *[(F.col(c) if c in level else none).alias(f"by_{c}") for c in LEVELS[0]])
        for i, level in enumerate(LEVELS)
    ]
    return groups.withColumn("at", F.explode(F.array(*keys))).select("*", "at.*").drop("at")


def bands(measured: DataFrame) -> DataFrame:
    """``spoken, script, figure, low, high`` of each language and script of ``measured``.

    What is grouped after the first sum are histograms: one row per group, figure and step.
    """
    by = ["level", "by_spoken", "by_script"]
    figure = F.explode(
        F.array(*[F.struct(F.lit(n).alias("figure"), F.round(F.col(n) * b[0]).cast("bigint").alias("step")) for n, b in BANDS.items()])
    )
    own = measured.select("spoken", "script", figure.alias("f")).groupBy("spoken", "script", "f.figure", "f.step")
    own = written(own.agg(F.count("*").alias("many")), "figure-steps")
    steps = written(at_levels(own).groupBy(*by, "figure", "step").agg(F.sum("many").alias("many")), "level-steps")
    keys = [*by, "figure"]

    def middle(rows: DataFrame, value: str, name: str) -> DataFrame:
        up_to, whole = Window.partitionBy(*keys).orderBy(value), Window.partitionBy(*keys)
        rows = rows.groupBy(*keys, value).agg(F.sum("many").alias("many"))
        rows = rows.select(*keys, value, F.sum("many").over(up_to).alias("reached"), F.sum("many").over(whole).alias("texts"))
        return rows.where(2 * F.col("reached") >= F.col("texts")).groupBy(*keys).agg(F.min(value).alias(name), F.max("texts").alias("texts"))

    medians = written(middle(steps, "step", "median"), "figure-medians")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    apart = steps.alias("s").join(medians.alias("m"), same).select(
        *[f"s.{k}" for k in keys], F.abs(F.col("step") - F.col("median")).alias("apart"), "many"
    )
    off = middle(apart, "apart", "deviation").drop("texts")
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    both = medians.alias("m").join(off.alias("d"), same).select(*[F.col(f"m.{k}") for k in keys], "median", "deviation", "texts")

    groups = at_levels(own.select("spoken", "script").distinct())
    same = [F.col(f"g.{k}").eqNullSafe(F.col(f"l.{k}")) for k in by]
    at = F.col("g.level")
    chain = groups.alias("g").join(both.alias("l"), same).groupBy("spoken", "script", "figure").agg(
        *[F.max(F.when(at == i, F.col(c))).alias(f"{c}{i}") for i in range(len(LEVELS)) for c in ("median", "deviation", "texts")]
    )

    def of(values: dict[str, float]) -> Column:
        return F.element_at(F.create_map(*[x for n, v in values.items() for x in (F.lit(n), F.lit(float(v)))]), F.col("figure"))

    unit = of({n: b[0] for n, b in BANDS.items()})
    drawn = {}
    for place, name in enumerate(("median", "deviation")):
        value = of({n: p[place] for n, p in PRIOR.items()})
        for i in reversed(range(len(LEVELS))):
            value = (F.col(f"texts{i}") * F.col(f"{name}{i}") / unit + DRAWN_TEXTS * value) / (F.col(f"texts{i}") + DRAWN_TEXTS)
        drawn[name] = value
    found = chain.select("spoken", "script", "figure", drawn["median"].alias("median"), drawn["deviation"].alias("deviation"))
    width = F.greatest(of({n: b[3] for n, b in BANDS.items()}), F.col("deviation") * WIDTH)
    infinite = F.lit(float("inf"))
    return found.select(
        "spoken",
        "script",
        "figure",
        F.when(of({n: b[1] for n, b in BANDS.items()}) > 0, F.col("median") - width).otherwise(-infinite).alias("low"),
        F.when(of({n: b[2] for n, b in BANDS.items()}) > 0, F.col("median") + width).otherwise(infinite).alias("high"),
    )


def judge_fertility(
    docs: DataFrame, encoder: Callable[[], object], model: str, text: str = "text", language: str | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` with the basic counts, the figures, ``script``, ``base_failed``, ``kept``.

    Words are runs without ASCII white space. ``base_failed``: under 50 words, or over half of the words in three-word
    windows that the text repeats. ``kept``: not that, and every figure within the band of the text's ``language``
    column (if one is named, and whatever it is named) and script. A null or wordless text fails the basic rules; its figures
    are null. A null language is one of its own. The given columns go through a table in between, without ``text``, which the
    result leaves out; columns named like a result's are replaced. An empty table gives an empty result.
    """
    result = [f.split()[0] for f in f"{BASE}, {FIGURES}".split(", ")]
    others = [c for c in docs.columns if c != text and c.lower() not in (*result, "base_failed", "kept")]
    spoken = F.lit(None).cast("string") if language is None else quoted(language).cast("string")
    measured = append(
        docs.select(
            *[quoted(c).alias(f"c{i}") for i, c in enumerate(others)], spoken.alias("spoken"), quoted(text).cast("string").alias("text")
        ),
        ["text"],
        f"{BASE}, {FIGURES}",
        _figures(encoder, model),
    ).drop("text")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    measured = written(measured.withColumn("base_failed", failed), "fertility")
    limits = bands(measured.where("not base_failed"))
    limits = limits.groupBy("spoken", "script").agg(
        F.map_from_entries(F.collect_list(F.struct("figure", F.struct("low", "high")))).alias("limits")
    )
    limits = written(limits, "bands")
    inside = F.lit(True)
    for name in BANDS:
        limit = F.col("limits").getItem(name)
        inside = inside & F.coalesce(F.col(name).between(limit["low"], limit["high"]), F.lit(False))
    m, b = measured.alias("m"), limits.alias("b")
    joined = m.join(b, F.col("m.spoken").eqNullSafe(F.col("b.spoken")) & (F.col("m.script") == F.col("b.script")), "left")
    return joined.select(
        *[F.col(f"m.c{i}").alias(c) for i, c in enumerate(others)],
        *[F.col(f"m.{c}") for c in result],
        "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
    )
