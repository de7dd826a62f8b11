"""Sampled segmentations into SentencePiece pieces: Gumbel top-k without replacement by A* search.

A text is the chain of its units (white space signs and the word after them), each a lattice of pieces.
Backward sums over the lattice give every edge its probability after the edges before it, so a
segmentation's log probability is a sum over its edges. The space of all segmentations is one region
whose greatest perturbed log probability is a Gumbel draw. Taking the region with the greatest bound,
its best segmentation is sampled edge by edge; what is left splits into regions that leave that path at
one edge, whose bounds are Gumbel draws at their mass, truncated at the region's own bound. The k
segmentations that come off the queue are a sample of size k without replacement, and the next bound
is the threshold of their inclusion scores. Draws are seeded by the row's key.

The tokenizer's scores are merge ranks, no log probabilities: a piece of rank r has the weight
1 / (r + 2), a byte 1 / (number of pieces). Characters without a piece are UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import bounded_batches, named, text_of
from tidemart.llm.text import SLICE_BYTES, find, list_array, mix, number_hash, release, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 17

SPACE = 0x2581          # stands for a space
LITERAL = 0x110000      # stands for the character SPACE itself, which is written as bytes
NO_MASS = 760.0         # exp(-NO_MASS) is 0
BUCKET_BITS = 18
KEPT_UNITS = 40_000     # lattices of units kept for the next slices of a task
BUILT = 8_000           # units whose lattices are built at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD1B54A32D192ED03)


@dataclass
class Vocabulary:
    """Beginnings of pieces as hashes of their code points, with ids (-1: no whole piece), log weights and whether
    longer pieces begin so, and which code points have a piece."""
    hashes: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    longer: np.ndarray
    single: np.ndarray
    longest: int
    first_byte: int
    byte_weight: float
    written: list[bytes]    # what each id stands for, spaces as such
    bucket: np.ndarray      # where hashes with the same first bits begin

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 if it is not there."""
        first = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        at, end = self.bucket[first], self.bucket[first + 1]
        out = np.where(self.hashes[np.minimum(at, len(self.hashes) - 1)] == h, at, -1)
        left = np.flatnonzero((out < 0) & (at + 1 < end))
        at, end, h = at[left] + 1, end[left], h[left]
        while len(left):
            hit = self.hashes[at] == h
            out[left[hit]] = at[hit]
            on = ~hit & (at + 1 < end)
            left, at, end, h = left[on], at[on] + 1, end[on], h[on]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation."""
        return b"".join(map(self.written.__getitem__, ids)).decode("utf-8")[1:]

    def decode_all(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The UTF-8 texts of segmentations laid end to end, each with the space in front."""
        done = pa.array(self.written, pa.large_binary()).take(pa.array(ids))
        data = done.buffers()[2] or b""
        at = np.frombuffer(done.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        ends = at[np.cumsum(sizes)]
        return [bytes(memoryview(data)[a:b]) for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]


def load(path: str = MODEL) -> Vocabulary:
    """Read the pieces of a BPE model with byte fallback; done once, by the driver."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    if not (model.normalizer_spec.name == "identity" and model.normalizer_spec.add_dummy_prefix
            and not model.normalizer_spec.remove_extra_whitespaces and model.trainer_spec.byte_fallback):
        raise ValueError("only identity models with a prefix space and byte fallback are supported")
    codes, ids, weights = [], [], []
    for i, p in enumerate(model.pieces):
        if p.type == 1:
            codes.append(np.array([ord(c) for c in p.piece], np.int64))
            ids.append(i)
            weights.append(-np.log(2.0 - p.score))
    hashes, piece, weight, longer = _beginnings(codes, ids, weights)
    single = np.zeros(LITERAL + 1, bool)
    single[[c[0] for c in codes if len(c) == 1]] = True
    first_byte = next(i for i, p in enumerate(model.pieces) if p.piece == "<0x00>")
    written = [bytes([i - first_byte]) if 0 <= i - first_byte < 256 else p.piece.replace(chr(SPACE), " ").encode() for i, p in enumerate(model.pieces)]
    edges = np.arange(1 << BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    bucket = np.append(np.searchsorted(hashes, edges), len(hashes)).astype(np.int32)
    return Vocabulary(hashes, piece, weight, longer, single, max(map(len, codes)), first_byte,
                      -float(np.log(len(model.pieces))), written, bucket)


def _beginnings(codes: list[np.ndarray], ids: list[int], weights: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct beginnings of the pieces by their hash, the whole pieces with id and weight; whether longer pieces begin so."""
    size = np.array([len(c) for c in codes])
    padded = np.zeros((len(codes), size.max()), np.uint64)
    for row, c in zip(padded, codes, strict=True):
        row[: len(c)] = c
    found: dict[int, tuple[int, float]] = {}
    longer: set[int] = set()
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, int(size.max()) + 1):
        h = mix(h * _STEP + padded[:, n - 1])
        for i in np.flatnonzero(size >= n).tolist():
            whole = (ids[i], weights[i]) if size[i] == n else (-1, 0.0)
            if whole[0] >= 0 or int(h[i]) not in found:
                found[int(h[i])] = whole
        longer.update(h[size > n].tolist())
    keys = sorted(found)
    return (np.array(keys, np.uint64), np.array([found[k][0] for k in keys]), np.array([found[k][1] for k in keys]),
            np.array([k in longer for k in keys]))


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin .. begin + n - 1 of each, one after another."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def symbols(text: str) -> np.ndarray:
    """Code points with spaces as SPACE and one in front."""
    code = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(code == SPACE, LITERAL, np.where(code == 0x20, SPACE, code))


class Lattices:
    """The lattices of the distinct units of a task's texts, kept for its next slices. Beyond KEPT_UNITS only those
    that several slices had are kept on, half as many at most.

    Places number the units' characters one after another. Edges are ordered by place, likeliest first; `upto` is
    the probability of a place's edges up to this one: a draw takes the first edge that reaches it. `rest` is the
    probability of a place's other edges, 0 if it has none.
    """

    PER_EDGE = ("place", "size", "piece", "logp", "p", "upto", "rest")
    SMALL = ("place", "size", "piece")
    PER_PLACE = ("first", "options", "top")

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known = np.zeros(0, np.uint64)        # hashes of the units, ascending, and which unit each is
        self.number = np.zeros(0, np.int64)
        self.start = self.end = np.zeros(0, np.int64)
        self.slices = np.zeros(0, np.int64)        # how many slices had the unit, halved whenever some are dropped
        self.room: dict[str, np.ndarray] = {}      # arrays that the ones below are the beginnings of
        for name in (*self.PER_EDGE, *self.PER_PLACE):
            setattr(self, name, np.zeros(0, np.int32 if name in self.SMALL else np.int64 if name in ("first", "options") else np.float64))

    def _put(self, name: str, kept: int, parts: list[np.ndarray]) -> None:
        """Lay parts behind the first values of an array."""
        old, n = getattr(self, name), kept + sum(map(len, parts))
        room = self.room.get(name)
        if room is None or n > len(room):
            room = self.room[name] = np.empty(n + n // 4, old.dtype)
            room[:kept] = old[:kept]
        for part in parts:
            room[kept: kept + len(part)] = part
            kept += len(part)
        setattr(self, name, room[:n])

    def _drop(self) -> None:
        """Keep the units that two slices or more had, of these the most frequent ones."""
        kept = np.flatnonzero(self.slices > 1)
        kept = np.sort(kept[np.argsort(-self.slices[kept], kind="stable")[: KEPT_UNITS // 2]])
        rank = np.full(len(self.start), -1)
        rank[kept] = np.arange(len(kept))
        left = rank[self.number] >= 0
        self.known, self.number = self.known[left], rank[self.number[left]]
        n = self.end[kept] - self.start[kept]
        places = _ranges(self.start[kept], n)
        edges = _ranges(self.first[places], self.options[places])
        self.end = np.cumsum(n)
        self.start = self.end - n
        self.slices = self.slices[kept] // 2
        for name in self.PER_EDGE[1:]:
            self._put(name, 0, [getattr(self, name)[edges]])
        for name in ("options", "top"):
            self._put(name, 0, [getattr(self, name)[places]])
        self._put("first", 0, [np.concatenate([[0], np.cumsum(self.options)])])
        self._put("place", 0, [np.repeat(np.arange(len(places), dtype=np.int32), self.options)])

    def add(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The unit numbers of some texts in order, and where each text's begin (one more at the end)."""
        v = self.vocabulary
        sizes = np.array([len(t) for t in texts])
        code = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        loose = ~v.single[code]
        starts = np.zeros(len(code), bool)
        starts[np.cumsum(sizes)[:-1]] = True
        starts[:1] = True
        starts[1:] |= (code[1:] == SPACE) & (code[:-1] != SPACE) | loose[1:] | loose[:-1]
        begin = np.flatnonzero(starts)
        length = np.diff(np.append(begin, len(code)))
        # few different signs are hashed once
        sign = number_hash(np.arange(code.max() + 1))[code] if len(code) and code.max() < len(code) // 2 else number_hash(code)
        power = number_hash(np.arange(length.max() if len(length) else 0)) | np.uint64(1)
        upto = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(sign * power[np.arange(len(code)) - np.repeat(begin, length)], out=upto[1:])
        h = mix((upto[begin + length] - upto[begin]) ^ number_hash(length))
        order = np.argsort(h)
        distinct = h[order]
        changes = np.ones(len(h), bool)
        changes[1:] = distinct[1:] != distinct[:-1]
        distinct, first = distinct[changes], order[changes]
        kind = np.empty(len(h), np.int64)
        kind[order] = np.cumsum(changes) - 1
        if len(self.start) > KEPT_UNITS:
            self._drop()
        at = find(self.known, distinct)
        new = np.flatnonzero(at < 0)
        number = np.where(at >= 0, self.number[np.maximum(at, 0)] if len(self.number) else 0, 0)
        if len(new):
            number[new] = len(self.start) + np.arange(len(new))
            parts = []
            for some in (new[i: i + BUILT] for i in range(0, len(new), BUILT)):
                n = length[first[some]]
                begin_new = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
                chars = np.repeat(begin[first[some]] - begin_new, n) + np.arange(n.sum())
                parts.append((begin_new, n, self._edges(v, code[chars], np.repeat(begin_new + n, n))))
            self._append(parts)
            at = np.searchsorted(self.known, distinct[new])
            self.known, self.number = np.insert(self.known, at, distinct[new]), np.insert(self.number, at, number[new])
        self.slices[number] += 1
        return number[kind], np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes)]))

    def _append(self, parts: list[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]) -> None:
        places, edges = len(self.options), len(self.place)
        known = {"first": places}      # its last value is where the new ones begin
        starts, ends = [self.start], [self.end]
        for begin, n, made in parts:
            made["place"] += places
            made["first"] = (made["first"] + edges)[: None if made is parts[-1][2] else -1]
            starts.append(begin + places)
            ends.append(begin + places + n)
            places, edges = places + len(made["options"]), edges + len(made["place"])
        self.start, self.end = np.concatenate(starts), np.concatenate(ends)
        self.slices = np.concatenate([self.slices, np.zeros(len(self.start) - len(self.slices), np.int64)])
        for name in (*self.PER_EDGE, *self.PER_PLACE):
            self._put(name, known.get(name, len(getattr(self, name))), [made.pop(name) for _, _, made in parts])

    @staticmethod
    def _edges(v: Vocabulary, code: np.ndarray, end: np.ndarray) -> dict[str, np.ndarray]:
        """All edges and places of some units laid end to end."""
        where, sizes, ids, weights, ranks = [], [], [], [], []
        signs, live, count = code.astype(np.uint64), np.arange(len(code)), np.zeros(len(code), np.int64)
        h = np.zeros(len(code), np.uint64)
        for size in range(1, v.longest + 1):
            inside = live + size <= end[live]
            live, h = live[inside], h[inside]
            if not len(live):
                break
            h = mix(h * _STEP + signs[live + size - 1])
            hit = v.find(h)
            begun = hit >= 0
            piece = np.where(begun, v.ids[hit], -1)
            got = np.flatnonzero(piece >= 0)
            here = live[got]
            where.append(here)
            sizes.append(np.full(len(here), size, np.int32))
            ids.append(piece[got])
            weights.append(v.weights[hit[got]])
            ranks.append(count[here])
            count[here] += 1
            on = np.flatnonzero(begun & v.longer[hit])     # no longer piece begins like the others
            live, h = live[on], h[on]
        loose = np.flatnonzero(~v.single[code])
        n_bytes = 1 + (code[loose] > 0x7F) + (code[loose] > 0x7FF) + (code[loose] > 0xFFFF)
        n_bytes[code[loose] == LITERAL] = 3
        where.append(loose)
        sizes.append(np.ones(len(loose), np.int32))
        ids.append(-1 - code[loose])
        weights.append(n_bytes * v.byte_weight)
        ranks.append(count[loose])
        count[loose] += 1
        first = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        place = np.repeat(np.arange(len(code)), count)
        at = first[np.concatenate(where)] + np.concatenate(ranks)     # by place, and there by size
        size, piece, weight = np.empty(len(place), np.int32), np.empty(len(place), np.int32), np.empty(len(place))
        size[at], piece[at], weight[at] = (np.concatenate(x) for x in (sizes, ids, weights))
        beta = np.zeros(len(code) + 1)
        distance = end - np.arange(len(code))
        longest = int(distance.max()) if len(code) else 0
        by_distance = np.argsort(distance.astype(np.uint16) if longest < 1 << 16 else distance, kind="stable")
        cut = np.searchsorted(distance[by_distance], np.arange(1, longest + 2))
        target = place + size
        target[target == end[place]] = len(code)     # where beta stays 0
        n = count[by_distance]
        edges = _ranges(first[by_distance], n)
        weights_by, target_by = weight[edges], target[edges]
        begin = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            some = slice(begin[a], begin[b])
            beta[by_distance[a:b]] = np.logaddexp.reduceat(weights_by[some] + beta[target_by[some]], begin[a:b] - begin[a])
        logp = np.minimum(weight + beta[target] - beta[place], 0.0)
        p = np.exp(logp)
        # each place's edges from the likeliest on, as most draws end with the first two
        key = place - 0.5 * p
        order = np.arange(len(place))
        two = first[:-1][count == 2]
        two = two[key[two + 1] < key[two]]
        order[two], order[two + 1] = two + 1, two
        several = np.flatnonzero(count > 2)
        several = _ranges(first[several], count[several])
        order[several] = several[np.argsort(key[several], kind="stable")]
        size, piece, logp, p = size[order], piece[order], logp[order], p[order]
        total = np.concatenate([[0.0], np.cumsum(p)])
        upto = np.minimum(total[1:] - total[first[place]], 1.0)
        upto[first[1:] - 1] = 1.0
        options = np.diff(first)
        top = np.where(options > 1, p[first[:-1]], 1.0) if len(code) else p
        rest = np.where(options[place] > 1, np.maximum(1 - p, 1e-300), 0.0)
        return {"place": place.astype(np.int32), "size": size, "piece": piece, "logp": logp, "p": p,
                "upto": upto, "rest": rest, "first": first, "options": options, "top": top}

    def draw(self, place: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge from each place."""
        e = self.first[place]
        other = np.flatnonzero(u >= self.top[place])
        if len(other):
            start = place[other]
            want, at, end = u[other], e[other] + 1, self.first[start + 1] - 1
            on = np.flatnonzero((self.upto[at] <= want) & (at < end))
            while len(on):
                at[on] += 1
                on = on[(self.upto[at[on]] <= want[on]) & (at[on] < end[on])]
            e[other] = at
        return e

    def sample(self, kinds: np.ndarray, places: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges from the given places to the ends of their units, in order, and the unit of each. A draw follows from the
        unit's seed and the number of the step alone."""
        unit, steps, units, count = np.arange(len(kinds)), [], [], np.zeros(len(kinds), np.int64)
        seed = seeds
        place, end = places, self.end[kinds]
        live = place < end
        turn = np.zeros(1, np.uint64)
        while True:
            live = np.flatnonzero(live)
            unit, place, end, seed = unit[live], place[live], end[live], seed[live]
            if not len(unit):
                break
            turn = turn + _TURN
            e = self.draw(place, (mix(seed + turn) >> np.uint64(11)) * 2.0**-53)
            steps.append(e)
            units.append(unit)
            count[unit] += 1
            place = place + self.size[e]
            live = place < end
        begin = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for i, (e, unit) in enumerate(zip(steps, units, strict=True)):     # a unit's steps follow one another
            edges[begin[unit] + i] = e
        return edges, np.repeat(np.arange(len(kinds)), count)


@dataclass
class _Path:
    edges: np.ndarray
    units: np.ndarray
    bound: float
    loss: np.ndarray        # what exp(-bound) of the regions that leave the path at each edge has above the path's; inf without mass
    upto: np.ndarray        # log probability before each edge
    taken: dict[int, list[int]]   # edges besides the path's that a region must avoid, too


class _Search:
    """The search for one text's segmentations; its draws of paths are made together with those of others."""

    def __init__(self, lattices: Lattices, kinds: np.ndarray, k: int, rng: np.random.Generator) -> None:
        self.lattices, self.kinds, self.k, self.rng = lattices, kinds, k, rng
        self.paths: list[_Path] = []
        self.queue: list[tuple[float, int, int]] = []
        self.seed = rng.integers(0, 1 << 63, dtype=np.uint64)

    def seeds(self, unit: int) -> np.ndarray:
        """The seeds of the next path's units from `unit` on."""
        turn = number_hash(np.array([len(self.paths)])) ^ self.seed
        return mix(turn) + np.arange(unit, len(self.kinds), dtype=np.uint64) * _STEP

    def first(self, edges: np.ndarray, units: np.ndarray) -> None:
        self._add(edges, units, float(-np.log(self.rng.standard_exponential() + 1e-300)), 0, [])

    def leave(self) -> tuple[int, np.ndarray] | None:
        """Take the region with the greatest bound: the unit at which its paths leave a known one, and from where the units
        from there on are to be drawn. None when all are found."""
        if not self.queue or len(self.paths) >= self.k:
            return None
        bound, i, j = heapq.heappop(self.queue)
        lattices, path = self.lattices, self.paths[i]
        avoid = [*path.taken.get(j, []), int(path.edges[j])]
        place, unit = lattices.place[path.edges[j]], int(path.units[j])
        options = np.arange(lattices.first[place], lattices.first[place + 1])
        options = np.delete(options, np.array(avoid) - options[0])
        p = lattices.p[options]
        e = int(options[min(np.searchsorted(np.cumsum(p), self.rng.random() * p.sum()), len(options) - 1)])
        begin = lattices.start[self.kinds[unit:]]
        begin[0] = place + lattices.size[e]
        path.loss[j] = np.inf
        self._push(i)
        self.leaving = (-bound, path, j, unit, e, avoid)
        return unit, begin

    def onwards(self, edges: np.ndarray, units: np.ndarray) -> None:
        """The path of the region taken, given what was drawn for its units."""
        bound, path, j, unit, e, avoid = self.leaving
        self._add(np.concatenate([path.edges[:j], [e], edges]).astype(np.int64),
                  np.concatenate([path.units[:j], [unit], units + unit]).astype(np.int64), bound, j, avoid)

    def _add(self, edges: np.ndarray, units: np.ndarray, bound: float, since: int, taken: list[int]) -> None:
        lattices = self.lattices
        upto = np.zeros(len(edges) + 1)
        np.cumsum(lattices.logp[edges], out=upto[1:])
        rest = lattices.rest[edges[since:]]
        room = np.flatnonzero(rest)
        rest, room = rest[room], room + since
        # regions beyond have no mass a double holds; cut only where k others come before them
        if len(edges) and upto[-2] <= -NO_MASS:
            n = int(np.searchsorted(-upto[:-1], NO_MASS))
            inside = int(np.searchsorted(room, n))
            if n > since and inside - np.searchsorted(room, since, side="right") >= self.k:
                room, rest = room[:inside], rest[:inside]
        if taken and len(room) and room[0] == since:
            rest[0] -= lattices.p[taken].sum()
            if lattices.options[lattices.place[edges[since]]] <= 1 + len(taken):
                room, rest = room[1:], rest[1:]
        # a Gumbel draw at mass m is -ln(e / m) for an exponential e; cut at the bound b it is -ln(exp(-b) + e / m)
        loss = np.full(len(edges), np.inf)
        with np.errstate(over="ignore"):
            loss[room] = (self.rng.standard_exponential(len(room)) + 1e-300) * np.exp(-upto[room]) / np.maximum(rest, 1e-300)
        self.paths.append(_Path(edges, units, bound, loss, upto, {since: taken} if taken else {}))
        self._push(len(self.paths) - 1)

    def _push(self, i: int) -> None:
        path = self.paths[i]
        if len(path.loss):
            j = int(path.loss.argmin())
            if path.loss[j] < np.inf:
                heapq.heappush(self.queue, (float(np.log(np.exp(-path.bound) + path.loss[j])), i, j))

    def found(self) -> list[tuple[np.ndarray, float, float, float]]:
        threshold = -self.queue[0][0] if self.queue else -np.inf
        out = []
        for path in self.paths:
            logp = float(path.upto[-1])
            kept = 1.0 if threshold == -np.inf else float(-np.expm1(-np.exp(min(logp - threshold, 50.0))))
            out.append((path.edges, logp, path.bound, kept))
        return out


def _drawn(lattices: Lattices, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each (kinds, places, seeds) its edges and units, all drawn at once."""
    if not parts:
        return
    ends = np.cumsum([len(p[0]) for p in parts])
    edges, units = lattices.sample(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
    cut = np.searchsorted(units, np.concatenate([[0], ends]))
    for a, b, end, part in zip(cut[:-1], cut[1:], ends, parts, strict=True):
        yield edges[a:b], units[a:b] - (end - len(part[0]))


def segmentations(lattices: Lattices, texts: list[np.ndarray], k: int, rngs: list[np.random.Generator]) -> list[list[tuple]]:
    """For each chain of units up to k distinct segmentations: edges, log probability, perturbed one, inclusion."""
    searches = [_Search(lattices, kinds, k, rng) for kinds, rng in zip(texts, rngs, strict=True)]
    firsts = _drawn(lattices, [(s.kinds, lattices.start[s.kinds], s.seeds(0)) for s in searches])
    for search, (edges, units) in zip(searches, firsts, strict=True):
        search.first(edges, units)
    open_ = searches
    while open_:
        leaving = [(s, way) for s in open_ if (way := s.leave())]
        parts = [(s.kinds[unit:], begin, s.seeds(unit)) for s, (unit, begin) in leaving]
        for (search, _), (edges, units) in zip(leaving, _drawn(lattices, parts), strict=True):
            search.onwards(edges, units)
        open_ = [s for s, _ in leaving]
    return [s.found() for s in searches]


def _ids(v: Vocabulary, piece: np.ndarray) -> np.ndarray:
    """Piece ids, characters without a piece as bytes."""
    loose = np.flatnonzero(piece < 0)
    if not len(loose):
        return piece
    code = -1 - piece[loose]
    code[code == LITERAL] = SPACE
    if (code < 0x80).all():
        out = piece.copy()
        out[loose] = v.first_byte + code
        return out
    parts, at = [], 0
    for i, c in zip(loose, code, strict=True):
        parts += [piece[at:i], np.frombuffer(chr(c).encode(), np.uint8).astype(np.int64) + v.first_byte]
        at = i + 1
    return np.concatenate([*parts, piece[at:]])


def encode(lattices: Lattices, keys: list, texts: list[str], k: int, seed: int) -> Iterator[tuple[int, list]]:
    """For each text its place and [(ids, log probability, perturbed, inclusion)], best first."""
    v = lattices.vocabulary
    code = [symbols(t) if t else np.zeros(0, np.int64) for t in texts]
    full = [i for i, c in enumerate(code) if len(c)]
    if full:
        kinds, edge = lattices.add([code[i] for i in full])
        rngs = [np.random.Generator(np.random.Philox(key=[seed, zlib.crc32(repr(keys[i]).encode())])) for i in full]
        found = dict(zip(full, segmentations(lattices, [kinds[a:b] for a, b in zip(edge[:-1], edge[1:])], k, rngs), strict=True))
    for i in range(len(code)):
        if not len(code[i]):
            yield i, [(np.zeros(0, np.int64), 0.0, 0.0, 1.0)]
        else:
            yield i, [(_ids(v, lattices.piece[e]), a, b, q) for e, a, b, q in found[i]]


def sample(df: DataFrame, k: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, seed: int = SEED) -> DataFrame:
    """(doc_id, rank, ids, log_prob, perturbed, inclusion, round_trip): k distinct segmentations of each text.

    Fewer where a text has fewer; null and empty texts have the empty one. Draws depend on seed and id
    alone, so repeated rows agree. round_trip says whether decoding gives the text back.
    """
    v = load(model)
    df = bounded_batches(df)
    kind = df.select(named(id_col)).schema[0].dataType
    schema = f"doc_id {kind.simpleString()}, rank int, ids array<int>, log_prob double, perturbed double, inclusion double, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(v)
        for batch in batches:
            for first, last, _ in slices(batch.column(1), SLICE_BYTES // 2):
                keys, texts = batch.column(0)[first:last], batch.column(1)[first:last].to_pylist()
                rows, ranks, ids, numbers = [], [], [], []
                for i, found in encode(lattices, keys.to_pylist(), texts, k, seed):
                    for rank, (piece_ids, *scores) in enumerate(found, 1):
                        rows.append(i)
                        ranks.append(rank)
                        ids.append(piece_ids.astype(np.int32))
                        numbers.append(scores)
                flat, sizes = np.concatenate(ids), np.array([len(x) for x in ids])
                good = [back == (f" {texts[i]}".encode() if texts[i] else b"") for i, back in zip(rows, v.decode_all(flat, sizes), strict=True)]
                columns = zip(*numbers, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows, pa.int64())), pa.array(ranks, pa.int32()), list_array(flat, sizes, pa.int32())]
                    + [pa.array(c, pa.float64()) for c in columns] + [pa.array(good, pa.bool_())],
                    ["doc_id", "rank", "ids", "log_prob", "perturbed", "inclusion", "round_trip"])
        del lattices
        release()

    return df.select(named(id_col), text_of(named(text_col))).mapInArrow(run, schema)
