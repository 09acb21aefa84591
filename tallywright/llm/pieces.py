"""Sampled segmentations of texts into the pieces of a SentencePiece model, and back."""

from __future__ import annotations

import functools
import math
import re
from array import array
from collections import defaultdict
from collections.abc import Sequence
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
SPACE = 0x2581  # how the vocabulary writes a space
NO_PIECE = 0x110000  # stands for that letter itself where a text holds it
# Bytes of the texts that one lattice covers; a longer text has one of its own.
CHARS = 1 << 19
# Letters of a part beyond which it goes letter by letter, alone: rounds over all parts at once
# would have few letters each. And letters whose arcs such a part has at a time.
LONG, STRETCH = 1 << 12, 1 << 15
SLOT_BITS = 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# No piece holds a line feed, or a space behind another letter.
_PARTS = re.compile(r"\n| +[^ \n]*|[^ \n]+")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draws(seeds: np.ndarray, part: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) that depend on the seed of a row, the part and the step only."""
    steps = np.atleast_1d(step).astype(np.uint64) + np.uint64(1)
    x = _mix(seeds + part.astype(np.uint64) * _FACTOR) + steps * _FACTOR
    return (_mix(x) >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Model:
    """Pieces of a model file with their log-probabilities, and lattices over them.

    A unigram model has log-probabilities. The scores of a BPE model are only the
    ranks of its merges, to which Zipf's law gives probabilities. A letter that is no
    piece is written as the pieces of its bytes, each as unlikely as the last rank.
    """

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes: list[bytes] = [b""] * size
        normal: dict[str, int] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal[piece] = i
                self.bytes[i] = piece.replace(chr(SPACE), " ").encode()
        scores = np.array([model.get_score(i) for i in range(size)], np.float64)
        self.log = scores
        if (scores == np.round(scores)).all():
            ranks = np.clip(-scores, 0, len(normal))
            self.log = -np.log(ranks + 2.7) - np.log(np.log(len(normal)))
        self.byte_log = float(self.log[list(normal.values())].min())
        self.letters = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.sizes = np.fromiter(map(len, self.bytes), np.int64, size)
        self.begins = np.cumsum(self.sizes) - self.sizes
        prefixes: dict[int, int] = {}
        for piece, i in normal.items():
            value = 0
            for k, c in enumerate(map(ord, piece), 1):
                value = (value * int(_FACTOR) + c + 1) & 0xFFFFFFFFFFFFFFFF
                prefixes[value] = i if k == len(piece) else prefixes.get(value, -1)
        if len(prefixes) != len({p[:k] for p in normal for k in range(1, len(p) + 1)}):
            raise ValueError("two beginnings of pieces have one hash")
        self.keys = np.array(sorted(prefixes), np.uint64)
        self.ids = np.array([prefixes[int(k)] for k in self.keys], np.int32)
        self.longest = max(map(len, normal))
        # Most beginnings are found by one look at a table; those whose slot another holds, by search.
        slots = (self.keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.slot = np.zeros(1 << SLOT_BITS, np.int32)
        self.slot[slots] = np.arange(len(slots))
        self.shared = np.bincount(slots, minlength=1 << SLOT_BITS) > 1

    def _find(self, value: np.ndarray) -> np.ndarray:
        """The place of each hash among the keys, or any place if it is not among them."""
        slot = (value >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
        at = self.slot[slot]
        again = np.flatnonzero(self.shared[slot] & (self.keys[at] != value))
        at[again] = np.minimum(np.searchsorted(self.keys, value[again]), len(self.keys) - 1)
        return at

    def arcs(self, codes: np.ndarray, part: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, length, id) of each piece in the parts of a text; ``part`` and ``end`` are
        the part of each letter and the end of it. The id of a letter that goes by its
        bytes is -1 minus its code."""
        start = np.arange(len(codes), dtype=np.int32)
        room = end - start
        value = np.zeros(len(codes), np.uint64)
        found = []
        for length in range(1, self.longest + 1):
            value = value * _FACTOR + (codes if length == 1 else codes[start + (length - 1)]).astype(np.uint64) + np.uint64(1)
            at = self._find(value)
            known = self.keys[at] == value
            ids = np.where(known, self.ids[at], -1)
            whole = np.flatnonzero(ids >= 0)
            found.append((start[whole], np.full(len(whole), length, np.int32), ids[whole]))
            if length == 1:
                letters = np.flatnonzero(ids < 0).astype(np.int32)
                found.append((letters, np.ones(len(letters), np.int32), -1 - codes[letters]))
            on = np.flatnonzero(known & (room > length))
            start, value, room = start[on], value[on], room[on]
        starts, lengths, ids = (np.concatenate(x) for x in zip(*found))
        return starts + part[starts], lengths, ids  # each part has one node more than letters

    def _weights(self, ids: np.ndarray) -> np.ndarray:
        weights = self.log.take(ids, mode="clip")
        letters = np.flatnonzero(ids < 0)
        codes = -1 - ids[letters]
        widths = 1 + (codes >= 0x80) + (codes >= 0x800) + ((codes >= 0x10000) & (codes != NO_PIECE))
        weights[letters] = widths * self.byte_log
        return weights

    def sample(self, texts: Sequence[str], seeds: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the pieces of all texts in order, and where those of each text end.

        Forward filtering sums the weights of all ways to each node of the lattices of
        the distinct parts; backward sampling then draws, for every occurrence of a
        part, the last piece by its share of the sum, the one before it, and so on.
        """
        number: defaultdict[str, int] = defaultdict(count().__next__)
        parts = [list(map(number.__getitem__, _PARTS.findall(" " + t))) if t else [] for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        occurrence = np.fromiter((p for x in parts for p in x), np.int64, int(sizes.sum()))
        if not len(occurrence):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        rows = np.repeat(np.arange(len(texts)), sizes)
        within = np.arange(len(occurrence)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        distinct = list(number)
        is_long = np.fromiter((len(p) > LONG for p in distinct), bool, len(distinct))
        steps, chosen = np.zeros(len(occurrence), np.int64), {}
        for at in np.flatnonzero(is_long[occurrence]):
            chosen[at] = self._sampled_alone(distinct[occurrence[at]], seeds[rows[at]], within[at], alpha)
            steps[at] = len(chosen[at])
        short = np.flatnonzero(~is_long[occurrence])
        place = np.cumsum(~is_long) - 1
        taken = self._sampled_together(
            [p for p, far in zip(distinct, is_long) if not far], place[occurrence[short]], seeds[rows[short]], within[short], alpha
        )
        for live, _ in taken:
            steps[short[live]] += 1
        offset = np.cumsum(steps) - steps
        out = np.zeros(int(steps.sum()), np.int64)
        for at, ids in chosen.items():
            out[offset[at] : offset[at] + len(ids)] = ids
        for back, (live, ids) in enumerate(taken):
            out[offset[short[live]] + steps[short[live]] - 1 - back] = ids
        spelled, widths = self._spelled(out)
        ends = np.concatenate(([0], np.cumsum(widths)))[np.concatenate((offset, [len(out)]))]
        upto = np.concatenate(([0], np.cumsum(sizes)))[1:]
        return spelled, ends[upto]

    def _codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<i4")
        return np.where(codes == SPACE, np.int32(NO_PIECE), np.where(codes == 0x20, np.int32(SPACE), codes))

    def _stretch(self, codes: np.ndarray, a: int, b: int, alpha: float) -> tuple[list[int], list[int], list[float], list[int]]:
        """(bounds, lengths, weights, ids) of the arcs to the nodes a + 1 to b of one part, by node
        and then by length; those of node a + 1 + i lie between bounds[i] and bounds[i + 1]."""
        first = max(0, a - self.longest + 1)
        some = codes[first:b]
        source, length, ids = self.arcs(some, np.zeros(len(some), np.int32), np.full(len(some), len(some), np.int32))
        target = source + length + first
        here = np.flatnonzero(target > a)
        here = here[np.argsort(target[here].astype(np.int64) * (self.longest + 1) + length[here])]
        bounds = np.searchsorted(target[here], np.arange(a + 1, b + 2))
        return bounds.tolist(), length[here].tolist(), (alpha * self._weights(ids[here])).tolist(), ids[here].tolist()

    def _sampled_alone(self, part: str, seed: np.uint64, within: int, alpha: float) -> np.ndarray:
        """Pieces of one long part in order: the same filtering and sampling letter by letter.
        Only the sums of its nodes are kept, and the arcs of some stretches at a time."""
        codes = self._codes(part)
        n, exp = len(codes), math.exp
        totals = array("d", [0.0]) * (n + 1)
        stretches = [(a, min(a + STRETCH, n)) for a in range(0, n, STRETCH)]
        held: dict[int, tuple] = {}
        for a, b in stretches:
            arcs = bounds, lengths, weights, _ = self._stretch(codes, a, b, alpha)
            if len(held) < 16:
                held[a] = arcs
            lo = 0
            for node in range(a + 1, b + 1):
                hi = bounds[node - a]
                if hi - lo == 1:
                    totals[node] = totals[node - lengths[lo]] + weights[lo]
                else:
                    ways = [totals[node - lengths[i]] + weights[i] for i in range(lo, hi)]
                    most = max(ways)
                    totals[node] = most + math.log(sum([exp(x - most) for x in ways]))
                lo = hi
        out, step, node = [], 0, n
        draws: list[float] = []
        for a, b in reversed(stretches):
            bounds, lengths, weights, ids = held.pop(a, None) or self._stretch(codes, a, b, alpha)
            while node > a:
                if step % STRETCH == 0:
                    draws = _draws(np.array([seed]), np.array([within]), np.arange(step, step + STRETCH)).tolist()
                left = draws[step % STRETCH]
                lo, hi = bounds[node - a - 1], bounds[node - a]
                arc = lo
                if hi - lo > 1:
                    ways = [totals[node - lengths[i]] + weights[i] for i in range(lo, hi)]
                    most = max(ways)
                    ways = [exp(x - most) for x in ways]
                    left *= sum(ways)
                    while arc < hi - 1:
                        left -= ways[arc - lo]
                        if left < 0:
                            break
                        arc += 1
                out.append(ids[arc])
                node -= lengths[arc]
                step += 1
        return np.array(out[::-1], np.int64)

    def _sampled_together(
        self, distinct: Sequence[str], occurrence: np.ndarray, seed: np.ndarray, within: np.ndarray, alpha: float
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """[(occurrences, ids)]: the last pieces of all occurrences of some parts, the ones
        before these, and so on."""
        if not len(occurrence):
            return []
        width = np.fromiter(map(len, distinct), np.int64, len(distinct))
        codes = self._codes("".join(distinct))
        stop = np.cumsum(width)
        part = np.repeat(np.arange(len(width), dtype=np.int32), width)
        base = stop - width + np.arange(len(width))  # the first node of each part
        source, length, ids = self.arcs(codes, part, np.repeat(stop.astype(np.int32), width))
        target = source + length
        nodes = len(codes) + len(width)
        place = (np.arange(nodes) - np.repeat(base, width + 1)).astype(np.int32)
        # By place in the part, then by node, then by length: all keys differ.
        order = np.argsort((place[target].astype(np.int64) * nodes + target) * (self.longest + 1) + length)
        del length
        source, target, ids = source[order], target[order], ids[order]
        weight = alpha * self._weights(ids)
        heads = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
        members = np.diff(np.concatenate((heads, [len(target)])))
        first, fan = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        first[target[heads]], fan[target[heads]] = heads, members
        total, share = np.zeros(nodes), np.zeros(len(target))
        depth = place[target[heads]]
        rounds = np.flatnonzero(np.concatenate(([True], depth[1:] != depth[:-1], [True])))
        for a, b in zip(rounds[:-1], rounds[1:]):
            lo = heads[a]
            hi = heads[b] if b < len(heads) else len(target)
            cuts, repeats = heads[a:b] - lo, members[a:b]
            ways = total[source[lo:hi]] + weight[lo:hi]
            most = np.maximum.reduceat(ways, cuts)
            ways = np.exp(ways - np.repeat(most, repeats))
            sums = np.add.reduceat(ways, cuts)
            total[target[heads[a:b]]] = most + np.log(sums)
            share[lo:hi] = ways / np.repeat(sums, repeats)
        live, node, root = np.arange(len(occurrence)), base[occurrence] + width[occurrence], base[occurrence]
        taken, step = [], 0
        while len(live):
            left = _draws(seed[live], within[live], step)
            arc, last = first[node].copy(), first[node] + fan[node] - 1
            open_ = np.arange(len(live))
            while True:  # the first arc at which the shares so far exceed the draw
                left[open_] -= share[arc[open_]]
                open_ = open_[(left[open_] >= 0) & (arc[open_] < last[open_])]
                if not len(open_):
                    break
                arc[open_] += 1
            taken.append((live, ids[arc]))
            node = source[arc]
            on = node != root[live]
            live, node = live[on], node[on]
            step += 1
        return taken

    def _spelled(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with each letter that is no piece as those of its UTF-8 bytes, and their numbers."""
        letters = np.flatnonzero(chosen < 0)
        widths = np.ones(len(chosen), np.int64)
        code = -1 - chosen[letters]
        code = np.where(code == NO_PIECE, SPACE, code)
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        widths[letters] = size
        out = np.repeat(np.maximum(chosen, 0), widths).astype(np.int32)
        at = (np.cumsum(widths) - widths)[letters]
        lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])[size]
        for k in range(4):
            has = size > k
            rest = code[has] >> (6 * (size[has] - 1 - k))
            value = (lead[has] | rest) if k == 0 else 0x80 | rest & 0x3F
            out[at[has] + k] = self.byte_ids[value]
        return out, widths

    def spell(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, ends) of the texts whose pieces end at ``ends``, without the space that was
        put before each."""
        sizes = self.sizes[ids]
        last = np.cumsum(sizes)
        from_ = np.repeat(self.begins[ids] - last + sizes, sizes)
        data = self.letters[from_ + np.arange(len(from_))]
        stops = np.concatenate(([0], last))[ends]
        starts = np.concatenate(([0], stops[:-1]))
        led = starts[stops > starts]
        led = led[data[led] == 0x20]
        kept = np.delete(data, led)
        return kept, stops - np.searchsorted(led, stops)

    def text(self, ids: Sequence[int]) -> str:
        """What the pieces of one text spell."""
        data, _ = self.spell(np.asarray(ids, np.int64), np.array([len(ids)]))
        return data.tobytes().decode("utf-8", "surrogatepass")


@functools.lru_cache(maxsize=2)
def model(path: str | None = None) -> Model:
    """One model for each worker process."""
    return Model(path or public_tokenizers.path(MODEL))


def encode(text: Column, *keys: str | Column, seed: int = 0, alpha: float = 1.0, path: str | None = None) -> Column:
    """Ids (array<int>) of a sampled segmentation of a text column.

    Draws follow from the key columns and the seed, so a row has the same pieces in
    whatever batch, task or attempt it is. ``alpha`` is the power of the probabilities: a
    large one gives the likeliest pieces nearly always. An empty text has no pieces,
    a null text null. Rows with equal keys and texts, or null keys, are drawn alike.
    """

    @F.arrow_udf("array<int>")
    def sampled(texts: pa.Array, seeds: pa.Array) -> pa.Array:
        numbers = seeds.to_numpy().view(np.uint64)
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        values, ends, at = [], [np.zeros(1, np.int64)], 0
        while at < len(texts):
            stop = max(int(np.searchsorted(np.cumsum(lengths[at:]), CHARS)), 1) + at
            words = [w or "" for w in texts.slice(at, stop - at).to_pylist()]
            ids, last = model(path).sample(words, numbers[at:stop], alpha)
            values.append(ids)
            ends.append(ends[-1][-1] + last)
            at = stop
        flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int32))
        offsets = np.concatenate(ends).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=texts.is_null())

    # Declared so that a plan which uses the ids in several places draws them once.
    return sampled.asNondeterministic()(text, F.xxhash64(*keys, F.lit(seed)))


def decode(ids: Column, path: str | None = None) -> Column:
    """The text that was encoded, whole and unchanged; null of a null."""

    @F.arrow_udf("string")
    def joined(rows: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
        out, at = [], 0
        while at < len(rows):
            stop = max(int(np.searchsorted(np.cumsum(lengths[at:]), CHARS)), 1) + at
            ids = rows.slice(at, stop - at).flatten().to_numpy()
            data, ends = model(path).spell(ids, np.cumsum(lengths[at:stop]))
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            valid = rows.slice(at, stop - at).is_valid().to_numpy(zero_copy_only=False)
            mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
            out.append(pa.Array.from_buffers(pa.string(), stop - at, [mask, offsets.buffers()[1], pa.py_buffer(data)]))
            at = stop
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return joined(ids)
