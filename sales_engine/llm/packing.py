"""Hierarchical packing of tokenised documents into sequences of several lengths.

A document's tokens are cut into windows of the longest tier; what is left after the last full window is routed
to the shortest tier that holds it. Each tier is packed on its own, the longest first: a rest gets a window, and the gap
behind it is filled from shorter tiers with whole rests of the longest tier that surely fits, at its end with one that is cut.
A tier gives half of its tokens to gaps; the other half fills windows of its own length.

A task packs the documents of its own input split, a bounded number of waiting tokens at a time. What it cannot lay into
full windows, less than one long window, is packed with that of 1023 other tasks, and what is left of these with that of
all other such groups: these few tokens are the only ones that are shuffled. The last sequence of all is the only one that
may not be full. Sequences are numbered, and dealt to training steps, from counts per task.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sales_engine.llm.arrow import Arrays, per_worker, quoted, streamed, type_of
from sales_engine.llm.tables import written

TIERS = (256, 512, 1024, 2048)
END = 1
#: Rests that may wait for a gap in a task, in tokens; then the tiers are emptied.
WAITING = 1 << 21
#: Share of a tier's tokens that may fill gaps of longer windows. Beyond it a gap gets the next rest of the window's own tier,
#: so that windows of every length are made however many gaps there are.
GIVEN = 0.5
#: Tasks whose last rests are packed together, as a power of two; then as many such groups.
TOGETHER_BITS = 10
#: Tokens of a training step.
STEP_TOKENS = 64 * 2048
#: A text is tokenised in pieces of about this many characters.
PIECE = 1 << 16
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of the public byte-level BPE vocabulary, as its ``tokenizers`` file gives them.

    The same vocabulary as ranks encodes several times faster; texts that hold the string of the special token
    go through the file itself. Long texts are cut before a single space between two letters, where a token
    always begins.
    """

    def __init__(self, file: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.file, self.whole = file, None

    def pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > 2 * PIECE:
            cut = text.find(" ", at + PIECE)
            while cut > 0 and not (text[cut - 1].isalpha() and text[cut + 1 : cut + 2].isalpha()):
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def encode(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            from tokenizers import Tokenizer

            self.whole = self.whole or Tokenizer.from_file(self.file)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return self.ids(text)

    def ids(self, text: str) -> np.ndarray:
        """Ids with the special token's string taken as ordinary text."""
        return np.concatenate([self.fast.encode_to_numpy(p, disallowed_special=()) for p in self.pieces(text)]).astype("<u4")


class Packer:
    """Cuts documents into pieces and puts these into sequences.

    ``out`` gets (document, its tokens, start, length, crc32, sequence, number within its size, size, offset).
    """

    def __init__(self, tiers: Sequence[int]):
        self.tiers = sorted(tiers)
        self.rests: dict[int, deque] = {t: deque() for t in self.tiers}
        self.waiting = 0
        self.routed, self.given = dict.fromkeys(self.tiers, 0), dict.fromkeys(self.tiers, 0)
        self.placed: dict[int, int] = {}
        self.out: list[tuple] = []

    def add(self, doc: object, ids: np.ndarray) -> None:
        long, doc = self.tiers[-1], (doc, len(ids))
        full = len(ids) // long * long
        for at in range(0, full, long):
            self._place([(doc, at, ids[at : at + long])], long)
        if full < len(ids):
            self.wait(doc, full, ids[full:])

    def wait(self, doc: tuple, start: int, rest: np.ndarray) -> None:
        """Route a rest to its tier."""
        tier = next(t for t in self.tiers if t >= len(rest))
        self.rests[tier].append((doc, start, rest))
        self.waiting += len(rest)
        self.routed[tier] += len(rest)

    def _place(self, pieces: list[tuple], size: int) -> None:
        offset, sequence, number = 0, sum(self.placed.values()), self.placed.get(size, 0)
        for doc, start, ids in pieces:
            self.out.append((*doc, start, len(ids), zlib.crc32(ids.tobytes()), sequence, number, size, offset, None))
            offset += len(ids)
        self.placed[size] = number + 1

    def _take(self, tier: int, most: int) -> tuple:
        """The first rest of a tier, up to ``most`` tokens of it; what is cut off waits in its own tier."""
        doc, start, ids = self.rests[tier].popleft()
        self.waiting -= len(ids)
        if len(ids) > most:
            self.wait(doc, start + most, ids[most:])
            ids = ids[:most]
        return doc, start, ids

    def _room(self, tiers: Sequence[int]) -> int:
        return sum(len(ids) for t in tiers for _, _, ids in self.rests[t])

    def pack(self) -> None:
        """Pack each tier, the longest first, as long as its rests and the shorter ones fill a window."""
        for i, tier in reversed(list(enumerate(self.tiers))):
            usable = self.tiers[: i + 1]
            room = self._room(usable)
            while self.rests[tier] and room >= tier:
                window = [self._take(tier, tier)]
                gap = tier - len(window[0][2])
                while gap:
                    there = [t for t in usable if self.rests[t]]
                    free = [t for t in there if t < tier and self.given[t] < GIVEN * self.routed[t]]
                    fits = [t for t in free if t <= gap]
                    of = fits[-1] if fits else free[0] if free else there[-1]
                    window.append(self._take(of, gap))
                    gap -= len(window[-1][2])
                    if of < tier:
                        self.given[of] += len(window[-1][2])
                self._place(window, tier)
                room -= tier

    def leave(self) -> None:
        """Pack, and give out what then waits, less than a long window, as rests without a sequence."""
        self.pack()
        for tier in self.tiers:
            for doc, start, ids in self.rests[tier]:
                self.out.append((*doc, start, len(ids), 0, 0, 0, 0, 0, ids.tobytes()))
            self.rests[tier].clear()
        self.waiting = 0

    def close(self) -> None:
        """Empty all tiers, the longest windows first; only the very last sequence may not be full."""
        self.pack()
        for size in reversed(self.tiers):
            while self.waiting >= size:
                self._place(self._laid_out(size), size)
        if self.waiting:
            self._place(self._laid_out(self.waiting), self.tiers[0])

    def _laid_out(self, many: int) -> list[tuple]:
        """So many tokens of the rests, end to end, the longest first."""
        got = []
        while many:
            got.append(self._take(next(t for t in reversed(self.tiers) if self.rests[t]), many))
            many -= len(got[-1][2])
        return got


_COLUMNS = (
    "task bigint, doc {kind}, doc_tokens bigint, start bigint, length bigint, ids_crc32 bigint, sequence bigint, "
    "number bigint, tier bigint, offset bigint, rest binary"
)


def _rows(packer: Packer, task: int) -> Arrays:
    taken, packer.out = packer.out, []
    return [[task] * len(taken), *map(list, zip(*taken, strict=True))]


def _packed(encoder: Callable[[], object], tiers: tuple[int, ...], waiting: int):
    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        encode = per_worker("byte_bpe_50k", encoder).encode
        packer, task = Packer(tiers), TaskContext.get().partitionId()
        for keys, texts in batches:
            for key, text in zip(keys, texts, strict=True):
                packer.add(key.as_py(), np.append(encode(text.as_py() or ""), np.array([END], "<u4")))
                if packer.waiting >= waiting:
                    packer.pack()
                if len(packer.out) >= 10_000:
                    yield _rows(packer, task)
        packer.leave()
        if packer.out:
            yield _rows(packer, task)

    return work


def _packed_rests(tiers: tuple[int, ...], level: int, last: bool):
    """Rests of several tasks, a group of them after the other, packed as one task's."""

    def work(batches: Iterator[Arrays]) -> Iterator[Arrays]:
        packer, group = Packer(tiers), None

        def ended() -> Iterator[Arrays]:
            packer.close() if last else packer.leave()
            if packer.out:
                yield _rows(packer, (level << 40) + group)

        for columns in batches:
            for of, doc, doc_tokens, start, rest in zip(*columns, strict=True):
                if of.as_py() != group:
                    if group is not None:
                        yield from ended()
                    packer, group = Packer(tiers), of.as_py()
                packer.wait((doc.as_py(), doc_tokens.as_py()), start.as_py(), np.frombuffer(rest.as_py(), "<u4"))
        if group is not None:
            yield from ended()

    return work


def pack(
    docs: DataFrame,
    encoder: Callable[[], object],
    key: str = "doc_id",
    text: str = "text",
    tiers: Sequence[int] = TIERS,
    step_tokens: int = STEP_TOKENS,
    waiting: int = WAITING,
) -> DataFrame:
    """Pieces of all documents: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step``.

    A document is its text's ids and the end id; a null text counts as empty, so it is one token. Every id lies in
    one piece. ``tier`` is the length of the sequence's window; all sequences are full but the last one of the table, which
    may be shorter than the shortest tier. A training ``step`` holds sequences of one length and, but for
    the last of a length, ``step_tokens`` tokens; steps of all lengths take turns in proportion to their number.
    Keys may be null or repeat; every row is packed as a document of its own. A result's column that is named like ``key``
    gets an underscore. An empty table gives no rows.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    columns = _COLUMNS.format(kind=type_of(docs, quoted(key)))
    tiers = tuple(sorted(tiers))
    names = [F.col(c) for c in ("group", "doc", "doc_tokens", "start", "rest")]
    packed = written(
        streamed(docs, [quoted(key), quoted(text).cast("string")], columns, _packed(encoder, tiers, waiting)), "pieces"
    )
    pieces = packed.where("rest is null")
    for level, last in ((1, False), (2, True)):
        of = F.lit(0).cast("bigint") if last else F.shiftright("task", TOGETHER_BITS)
        left = packed.where("rest is not null").withColumn("group", of)
        many = 1 if last else int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        in_order = left.repartition(many, "group").sortWithinPartitions("group", "task", "start", "length", "rest")
        packed = written(streamed(in_order, names, columns, _packed_rests(tiers, level, last)), "rests")
        pieces = pieces.unionAll(packed.where("rest is null"))
    pieces = pieces.drop("rest")
    # One row for each task and length: the only thing that is ever in one place.
    sizes = pieces.groupBy("task", "tier").agg((F.max("number") + 1).alias("many"))
    before = F.coalesce(F.sum("many").over(Window.orderBy("task", "tier").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_tier = F.coalesce(
        F.sum("many").over(Window.partitionBy("tier").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    sizes = written(sizes.select("task", "tier", "many", before.alias("before"), in_tier.alias("in_tier")), "sizes")
    base = sizes.groupBy("task").agg(F.min("before").alias("base"))
    at = sizes.select("task", "tier", "in_tier").join(base, "task")
    total = {r.tier: r.many for r in sizes.groupBy("tier").agg(F.sum("many").alias("many")).collect()}
    steps = {t: -(-n * t // step_tokens) for t, n in total.items()}
    own = F.floor((F.col("in_tier") + F.col("number")) * F.col("tier") / F.lit(step_tokens))
    mine = F.coalesce(*[F.when(F.col("tier") == t, F.lit(n)) for t, n in sorted(steps.items())], F.lit(1))
    # Step j of n stands at (j + 1/2) / n of the run; its number is that of all steps before that place.
    place = (2 * own + 1) / (2 * mine)
    step = F.lit(0).cast("bigint")
    for t, n in sorted(steps.items()):
        ahead = F.when(F.col("tier") > t, F.floor(place * n + F.lit(0.5))).otherwise(F.ceil(place * n - F.lit(0.5)))
        step = step + F.when(F.col("tier") == t, own).otherwise(F.least(F.greatest(ahead, F.lit(0)), F.lit(n)))
    made = {
        "start": F.col("start"), "length": F.col("length"), "ids_crc32": F.col("ids_crc32"), "doc_tokens": F.col("doc_tokens"),
        "sequence_id": F.col("base") + F.col("sequence"), "offset": F.col("offset"), "tier": F.col("tier"), "step": step.cast("bigint"),
    }
    return pieces.join(at, ["task", "tier"]).select(
        F.col("doc").alias(key), *[c.alias(n + "_" if n == key.lower() else n) for n, c in made.items()]
    )
