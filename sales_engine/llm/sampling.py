"""Sampled SentencePiece segmentations: forward filtering, backward sampling over the lattice of pieces.

The lattice of a text falls apart at places no piece crosses (before a space that follows another character, and
around line ends), so the filter runs once for each distinct unit between them and every occurrence samples
backwards from it. Draws are counter-based hashes of (seed, row key, unit, step) and probabilities whole
numbers, so a row's segmentation is the same in any batch, task or cluster. Characters without a piece, the
space mark itself among them, become byte pieces, so decoding gives every text back.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from sales_engine.llm.arrow import Arrays, append, beside, flat, per_worker, quoted, text_of, type_of
from sales_engine.llm.remembered import Remembered

MARK = "▁"
#: Weight of a byte piece beside those of pieces.
BYTE_WEIGHT = -20.0
BITS = 30
#: First bits of a piece's hash by which it is looked up.
SLOT_BITS = 20
#: Distinct units whose lattices a worker remembers.
KNOWN_UNITS = 600_000
#: Characters of text that are segmented together.
BLOCK = 1 << 19
#: Rows that a round trip takes at a time.
ROWS = 1024
_UNITS = re.compile(r" *[^ \n]+| +|\n")
_NORMAL, _BYTE = 1, 6


def units_of(text: str) -> list[str]:
    """The parts of a text, with the space that the model puts in front, whose lattices are independent."""
    return _UNITS.findall(" " + text) if text else []


def _hash(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Pieces:
    """The model's pieces with weights: log probabilities of a unigram model; a BPE model's ranks as Zipf's law has
    them. ``sharpness`` multiplies the weights: 0 makes all segmentations equally likely, large values the best."""

    def __init__(self, model: str, sharpness: float):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model, "rb") as file:
            proto.ParseFromString(file.read())
        ranked = proto.trainer_spec.model_type == 2
        self.bytes_of = [p.piece.replace(MARK, " ").encode() for p in proto.pieces]
        self.byte_ids = {}
        self.ids, self.weights = {}, {}
        for i, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif p.type == _NORMAL and MARK not in p.piece.lstrip(MARK) and "\n" not in p.piece:
                self.ids[p.piece.replace(MARK, " ")] = i
                self.weights[i] = sharpness * (-np.log(2.0 - p.score) if ranked else p.score)
            elif p.type != _NORMAL:
                self.bytes_of[i] = b""
        self.longest = max(map(len, self.ids))
        self.fallback = sharpness * BYTE_WEIGHT


class Lattices:
    """Lattices of known units in flat arrays. A node is a place in a unit; its edges are the pieces that end there."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        names = list(pieces.ids)
        sizes = np.fromiter(map(len, names), np.int64, len(names))
        ends = np.cumsum(sizes)
        hashes = self._ranges("".join(names))(ends - sizes, ends)
        order = np.argsort(hashes)
        self.hashes, ids = hashes[order], np.array([pieces.ids[n] for n in names])[order]
        self.tokens, self.token_weights = ids, np.array([pieces.weights[i] for i in ids])
        # Where the hashes with the same first bits begin.
        self.begin = np.searchsorted(self.hashes >> np.uint64(64 - SLOT_BITS), np.arange(2**SLOT_BITS + 1, dtype=np.uint64))
        self.most = int(np.diff(self.begin).max())
        self.known = Remembered(KNOWN_UNITS, self.learn, self.rebuild)
        self.forget()

    def rebuild(self, units: list[str]) -> np.ndarray:
        self.forget()
        return self.learn(units)

    def forget(self) -> None:
        self.nodes = 0
        self.edges = 0
        self.upper, self.source, self.token = (np.zeros(1 << 16, np.int32) for _ in range(3))
        self.first, self.edge = np.zeros(1 << 16, bool), np.zeros((1 << 16) + 1, np.int64)

    @staticmethod
    def _ranges(text: str):
        """Hashes of ranges of code points: differences of running sums, brought to a common power."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        base = 0x5851F42D4C957F2D
        powers, back = np.full(len(points) + 1, base, np.uint64), np.full(len(points) + 1, pow(base, -1, 2**64), np.uint64)
        powers[0] = back[0] = 1
        powers, back = np.cumprod(powers), np.cumprod(back)
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_hash(points + np.uint64(0x9E3779B97F4A7C15)) * powers[:-1])])
        return lambda start, end: _hash((running[end] - running[start]) * back[start])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pieces with these hashes, and which of them there are."""
        first = self.begin[hashes >> np.uint64(64 - SLOT_BITS)]
        place = np.minimum(first, len(self.hashes) - 1)
        hit = self.hashes[place] == hashes
        for more in range(1, self.most):
            other = np.minimum(first + more, len(self.hashes) - 1)
            same = self.hashes[other] == hashes
            place, hit = np.where(same, other, place), hit | same
        return place, hit

    def learn(self, units: list[str]) -> np.ndarray:
        """Forward filtering of new units, all at once; the nodes of their ends."""
        if not units:
            return np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(sizes)
        text = "".join(units)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        unit = np.repeat(np.arange(len(units)), sizes)
        ranges = self._ranges(text)
        at = np.arange(len(points))
        starts, stops, tokens, weights = [], [], [], []
        for length in range(1, self.pieces.longest + 1):
            here = at[at + length <= ends[unit]]
            if not len(here):
                break
            hashes = ranges(here, here + length)
            place, hit = self._find(hashes)
            starts.append(here[hit])
            stops.append(here[hit] + length)
            tokens.append(self.tokens[place[hit]])
            weights.append(self.token_weights[place[hit]])
            if length == 1:  # characters without a piece: one byte piece, or the code point for several
                rest = here[~hit]
                ascii_ids = np.array([self.pieces.byte_ids[b] for b in range(128)])
                starts.append(rest)
                stops.append(rest + 1)
                tokens.append(np.where(points[rest] < 128, ascii_ids[np.minimum(points[rest], 127)], -points[rest]))
                weights.append(np.full(len(rest), self.pieces.fallback))
        start, stop, token, weight = map(np.concatenate, (starts, stops, tokens, weights))
        owner = unit[start]
        begin = ends[owner] - sizes[owner]
        source, target = start + owner, stop + owner  # a unit has one node more than characters
        depth = stop - begin
        order = np.argsort(target, kind="stable")  # edges of a node stay in the order of their lengths
        source, target, token, weight, depth = (x[order] for x in (source, target, token, weight, depth))
        alpha = np.full(len(points) + len(units), -np.inf)
        alpha[ends - sizes + np.arange(len(units))] = 0.0
        value = np.empty(len(source))
        cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        count = np.diff(np.append(cuts, len(target)))
        by_depth = np.argsort(depth[cuts], kind="stable")
        levels = np.searchsorted(depth[cuts[by_depth]], np.arange(1, depth.max() + 2))
        for low, high in zip(levels[:-1].tolist(), levels[1:].tolist(), strict=True):
            if low == high:
                continue
            nodes = by_depth[low:high]
            many = count[nodes]
            group = np.cumsum(many) - many
            edge = np.repeat(cuts[nodes] - group, many) + np.arange(int(many.sum()))
            here = alpha[source[edge]] + weight[edge]
            value[edge] = here
            most = np.maximum.reduceat(here, group)
            total = np.add.reduceat(np.exp(here - np.repeat(most, many)), group)
            alpha[target[cuts[nodes]]] = most + np.log(total)
        share = np.exp(value - alpha[target])
        reached = np.zeros(len(cuts))
        upper = np.empty(len(share), np.int64)
        for k in range(int(count.max())):
            more = np.flatnonzero(count > k)
            edge = cuts[more] + k
            reached[more] += share[edge]
            upper[edge] = np.minimum(np.floor(reached[more] * 2**BITS + 0.5), 2**BITS)
        upper[cuts + count - 1] = 2**BITS
        self._grow(len(target), len(alpha))
        new = slice(self.edges, self.edges + len(target))
        self.upper[new], self.source[new], self.token[new] = upper, source + self.nodes, token
        degree = np.zeros(len(alpha), np.int64)
        degree[target[cuts]] = count
        self.edge[self.nodes + 1 : self.nodes + 1 + len(alpha)] = self.edges + np.cumsum(degree)
        self.first[self.nodes : self.nodes + len(alpha)] = False
        self.first[self.nodes + ends - sizes + np.arange(len(units))] = True
        last = self.nodes + ends + np.arange(len(units))
        self.edges += len(target)
        self.nodes += len(alpha)
        return last

    def _grow(self, edges: int, nodes: int) -> None:
        while len(self.upper) < self.edges + edges:
            self.upper, self.source, self.token = (np.concatenate([x, np.zeros_like(x)]) for x in (self.upper, self.source, self.token))
        while len(self.edge) <= self.nodes + nodes:
            self.first, self.edge = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.edge))

    def sample(self, units: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling: the tokens of all units in order, and how many each has. ``seeds``: one a unit."""
        node = self.known.rows_of(units)
        open_units, steps = np.arange(len(units)), []
        taken = np.zeros(len(units), np.int64)
        while len(open_units):
            mixed = _hash(seeds[open_units] + np.uint64((len(steps) + 1) * 0x9E3779B97F4A7C15 % 2**64))
            draw = (mixed >> np.uint64(64 - BITS)).astype(np.int32)
            edge, end = self.edge[node], self.edge[node + 1]
            while (wide := edge < end).any():  # the first edge whose upper limit is above the draw
                middle = (edge + end) >> 1
                above = self.upper[np.minimum(middle, self.edges - 1)] > draw
                end = np.where(wide & above, middle, end)
                edge = np.where(wide & ~above, middle + 1, edge)
            steps.append((open_units, self.token[edge]))
            taken[open_units] += 1
            node = self.source[edge].astype(np.int64)
            more = ~self.first[node]
            node, open_units = node[more], open_units[more]
        last = np.cumsum(taken)
        tokens = np.empty(int(taken.sum()), np.int64)
        for step, (which, token) in enumerate(steps):
            tokens[last[which] - 1 - step] = token
        return tokens, taken

    def expanded(self, tokens: np.ndarray) -> np.ndarray:
        """Tokens with code points that have no piece as their byte pieces."""
        at = np.flatnonzero(tokens < 0)
        if not len(at):
            return tokens
        parts, begin = [], 0
        for place in at.tolist():
            parts += [tokens[begin:place], [self.pieces.byte_ids[b] for b in chr(-tokens[place]).encode()]]
            begin = place + 1
        return np.concatenate([*parts, tokens[begin:]]).astype(np.int64)


def _encoding(model: str, seed: int, sharpness: float):
    def make():
        lattices = per_worker(f"{model} {sharpness}", lambda: Lattices(Pieces(model, sharpness)))

        def work(columns: Arrays) -> Arrays:
            parts, sizes = [], []

            def segment(rows: list[tuple[list[str], int]]) -> None:
                units = [u for own, _ in rows for u in own]
                if not units:
                    sizes.extend([0] * len(rows))
                    return
                counts = np.array([len(own) for own, _ in rows])
                number = np.arange(len(units)) - np.repeat(np.cumsum(counts) - counts, counts)
                row_seed = np.repeat(np.array([s for _, s in rows], np.uint64), counts)
                seeds = _hash(row_seed + number.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
                tokens, taken = lattices.sample(units, seeds)
                ends = np.cumsum(counts)
                reached = np.concatenate([[0], np.cumsum(taken)])
                for a, b in zip(reached[ends - counts].tolist(), reached[ends].tolist(), strict=True):
                    own = lattices.expanded(tokens[a:b]).astype(np.int32)
                    parts.append(own)
                    sizes.append(len(own))

            waiting, size = [], 0
            for key, text in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True):
                text = text or ""
                waiting.append((units_of(text), xxhash.xxh3_64_intdigest(f"{seed}/{key}")))
                size += len(text)
                if size >= BLOCK:
                    segment(waiting)
                    waiting, size = [], 0
            segment(waiting)
            flat = np.concatenate([*parts, np.zeros(0, np.int32)])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

        return work

    return make


def _decoding(model: str):
    def make():
        table = per_worker(f"{model} bytes", lambda: Pieces(model, 1.0).bytes_of)

        def work(columns: Arrays) -> Arrays:
            offsets, valid = columns[0].offsets.to_pylist(), columns[0].is_valid().to_pylist()
            begin = offsets[0] if offsets else 0
            parts = list(map(table.__getitem__, columns[0].values[begin : offsets[-1]].to_numpy().tolist()))
            out = []
            for a, b, known in zip(offsets, offsets[1:], valid, strict=False):
                raw = b"".join(parts[a - begin : b - begin])
                out.append((raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace") if known else None)
            return [out]

        return work

    return make


def encode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 0, sharpness: float = 1.0, name: str = "ids"
) -> DataFrame:
    """All rows and columns of ``docs`` with ``name``: the ids of a sampled segmentation of the whole text.

    A segmentation is drawn with the probability that the lattice gives it, from ``seed`` and the row's ``key``
    alone: rows with the same key and text get the same ids, rows without a key share one seed. A null or empty
    text has no ids. An empty table gives an empty result.
    """
    inputs = [quoted(key).cast("string"), text_of(docs, text)]
    return append(docs, inputs, f"`{name}` array<int>", _encoding(model, seed, sharpness))


def decode(rows: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All rows and columns with ``name``: the text of ``ids``. Null ids give null; ids that aren't a text's (bytes
    that are no UTF-8) give replacement characters, unknown and control ids nothing."""
    return append(rows, [ids], f"`{name}` string", _decoding(model))


ROUND_TRIP = "n_tokens bigint, ids_crc32 bigint, decoded_sha256 string, lossless boolean"


def round_trip(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 0, sharpness: float = 1.0) -> DataFrame:
    """Per row ``key, n_tokens, ids_crc32`` (of the ids as ``encode`` gives them, little-endian), ``decoded_sha256``
    (of the text that ``decode`` makes of them) and ``lossless``: whether that is the row's text, null as empty.

    A task encodes and decodes some rows at a time, so neither ids nor texts leave it. A result's column that is named like
    ``key`` gets an underscore.
    """

    def make():
        encoded, decoded = _encoding(model, seed, sharpness)(), _decoding(model)()

        def work(columns: Arrays) -> Iterator[Arrays]:
            for at in range(0, len(columns[0]), ROWS):
                keys, texts = (c.slice(at, ROWS) for c in columns[:2])
                ids = encoded([keys.cast(pa.string()), texts])[0]
                back = decoded([ids])[0]
                flat_ids, ends = ids.values.to_numpy().astype("<i4"), ids.offsets.to_pylist()
                yield [
                    columns[2].slice(at, ROWS),
                    np.diff(ends).tolist(),
                    [zlib.crc32(flat_ids[a:b].tobytes()) for a, b in zip(ends, ends[1:], strict=False)],
                    [hashlib.sha256(t.encode()).hexdigest() for t in back],
                    [t == (own or "") for t, own in zip(back, texts.to_pylist(), strict=True)],
                ]

        return work

    inputs = [quoted(key).cast("string"), quoted(text).cast("string"), quoted(key)]
    return flat(docs, inputs, f"`{key}` {type_of(docs, quoted(key))}, {beside(key, ROUND_TRIP)}", make)
