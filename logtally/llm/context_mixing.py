"""Logistic mixing of bit predictors over whole byte arrays.

A text is its UTF-8 bytes and an end byte, 0xFF, which UTF-8 never has. A byte is a row of binary decisions, those of a Huffman
code, so that common bytes take few; all decisions of one depth are made together. Four predictors see
the byte before, hashes of the two and of the three bytes before, and a hash of the word so far; each counts ones and
zeros per slot. Their log odds are added with weights of a set that a gate picks from the decision's depth and from how much the two
longest contexts have seen. A last table refines the result by the byte so far. Weights are learned online, chunk by chunk;
the refinement adapts to what the mixed result was worth. What several tasks have learned is averaged, by how often each has met
a set of weights.

All that bears on a byte is the three bytes before, the word so far and the byte itself, 64 bits; what follows from them is
worked out once for each of the different ones of a chunk. Where the same is asked of chunk after chunk, a table of bounded size
keeps it for the ones that come again.
"""

from __future__ import annotations

import heapq
from functools import lru_cache
from typing import NamedTuple

import numpy as np

#: Slots of each predictor, as powers of two: one byte (exact), two bytes, three bytes, word.
BITS = (16, 18, 19, 19)
SLOTS = [1 << b for b in BITS]
END = 0xFF
_GATES = 8 * 4 * 4
_STEPS = 33
#: Weights are added up in such parts of one.
_WHOLE = 2.0**20
#: Bytes of words, letters in lower case; 0 is what stands between them.
_FOLDED = np.zeros(256, np.uint8)
_FOLDED[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = [b | 32 for b in (*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256))]
#: Contexts that a task keeps, as a power of two; 24 bytes each where they are counted, 16 where they are scored.
KEPT_BITS = 19
#: No context is this: an end byte never follows another.
_FREE = np.uint64(2**64 - 1)


class Code(NamedTuple):
    """Length of each byte's code, and by depth and byte the node (1 to 255) where it decides and its bit there."""

    lengths: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray


def code_of(histogram: np.ndarray) -> Code:
    """A Huffman code of all 256 bytes; each counts once more than it occurs."""
    heap = [(int(n) + 1, b, b) for b, n in enumerate(histogram)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int]] = {}
    while len(heap) > 1:
        (n, _, left), (m, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        name = 256 + len(children)
        children[name] = (left, right)
        heapq.heappush(heap, (n + m, name, name))
    paths: dict[int, list[tuple[int, int]]] = {}
    walk = [(heap[0][2], [])]
    number = 0
    while walk:
        name, path = walk.pop()
        if name < 256:
            paths[name] = path
            continue
        number += 1
        walk += [(child, [*path, (number, bit)]) for bit, child in enumerate(children[name])]
    lengths = np.array([len(paths[b]) for b in range(256)])
    nodes, bits = (np.zeros((lengths.max(), 256), np.uint32) for _ in range(2))
    for b, path in paths.items():
        for depth, (node, bit) in enumerate(path):
            nodes[depth, b], bits[depth, b] = node, bit
    return Code(lengths, nodes, bits)


class Sequence(NamedTuple):
    """Bytes of several texts, longest codes first, with the contexts of each; their place in the texts; the texts' starts."""

    symbols: np.ndarray
    previous: np.ndarray
    hashes: list[np.ndarray]
    order: np.ndarray
    starts: np.ndarray
    code: Code
    at_depth: np.ndarray


def _keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte of all texts and their ends: hash of the word so far, three bytes before, byte; and the texts' starts."""
    pad = b"\0\0\0"
    raw = np.frombuffer(b"".join(pad + t + b"\xff" for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    real = np.ones(len(raw), bool)
    heads = np.cumsum(lengths + 3) - lengths - 3
    for i in range(3):
        real[heads + i] = False
    # Word so far: sums of byte times power, the power taken out again, so that every word starts afresh.
    powers, inverse = _powers(len(raw))
    folded = _FOLDED.take(raw)
    total = np.cumsum(folded * inverse)
    broken = np.maximum.accumulate(np.where(folded == 0, np.arange(len(raw), dtype=np.int32), np.int32(0)))
    word = (total - total.take(broken)) * powers
    word ^= word >> np.uint64(29)
    word *= np.uint64(0xBF58476D1CE4E5B9)
    word &= np.uint64(0xFFFFFFFF00000000)
    # The byte and the three before are four bytes read as one number.
    key = np.zeros(len(raw), np.uint64)
    key[3:] = word[2:-1] | np.ndarray(len(raw) - 3, ">u4", raw, strides=(1,)).astype(np.uint32)
    return key[real], np.cumsum(lengths) - lengths


@lru_cache(1)
def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    factor = 0x5851F42D4C957F2D
    return np.cumprod(np.full(size, factor, np.uint64)), np.cumprod(np.full(size, pow(factor, -1, 2**64), np.uint64))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse; those of the usual sizes are kept."""
    powers, inverse = _power_table(2**20) if size <= 2**20 else _power_table.__wrapped__(size)
    return powers[:size], inverse[:size]


def _of_keys(keys: np.ndarray, starts: np.ndarray, code: Code) -> Sequence:
    symbols, one, two, three = ((keys >> np.uint64(8 * i)).astype(np.uint8) for i in range(4))
    depth = code.lengths[symbols].astype(np.int8)
    order = np.argsort(-depth, kind="stable")
    at_depth = len(order) - np.cumsum(np.bincount(depth, minlength=len(code.nodes) + 1))
    symbols, one, two, three = (x[order].astype(np.uint32) for x in (symbols, one, two, three))
    word = (keys >> np.uint64(32)).astype(np.uint32)[order]
    pair = (one | two << np.uint32(8)) * np.uint32(0x9E3779B1)
    triple = (one | two << np.uint32(8) | three << np.uint32(16)) * np.uint32(0x85EBCA77)
    return Sequence(symbols.astype(np.intp), one, [pair, triple, word ^ one * np.uint32(0xC2B2AE3D)], order, starts, code, at_depth)


def sequence(texts: list[bytes], code: Code) -> Sequence:
    return _of_keys(*_keys(texts), code)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.intp)


def _firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that between them have every key, and of each key's place the number among these.

    Equal keys are found by a table of hashes; those that another key has displaced from it stand for themselves.
    """
    bits = max(1, len(keys).bit_length() + 1)
    slot = _slot(keys, bits)
    table = np.zeros(1 << bits, np.int32)
    at = np.arange(len(keys), dtype=np.int32)
    table[slot] = at
    found = table.take(slot)
    found = np.where(keys.take(found) == keys, found, at)
    stands = np.zeros(len(keys), bool)
    stands[found] = True
    number = np.cumsum(stands, dtype=np.int32) - 1
    return np.flatnonzero(stands), number.take(found)


def different(texts: list[bytes], code: Code) -> tuple[Sequence, np.ndarray]:
    """The different bytes in their contexts as a sequence of their own, and how often each occurs."""
    keys, times = _unique(_keys(texts)[0])
    s = _of_keys(keys, np.zeros(1, np.intp), code)
    return s, times[s.order]


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones, in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])
    return keys[first], np.diff(np.r_[first, len(keys)])


def _slots(s: Sequence, depth: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The node, the slot of each predictor, and the bit, at one depth of all bytes that have it (the first ones)."""
    n = s.at_depth[depth]
    node, bit = s.code.nodes[depth].take(s.symbols[:n], mode="clip"), s.code.bits[depth].take(s.symbols[:n], mode="clip")
    spread = node * np.uint32(0x2545F491)
    slots = [(s.previous[:n] << np.uint32(8) | node).astype(np.intp)]
    for h, bits in zip(s.hashes, BITS[1:], strict=True):
        x = h[:n] + spread
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x >>= np.uint32(32 - bits)
        slots.append(x.astype(np.intp))
    return node, slots, bit


def _count_keys(total: np.ndarray, keys: np.ndarray, times: np.ndarray, code: Code) -> None:
    """Adds zeros and ones of every slot to each row of the total, keys occurring as often as the same row of times says."""
    s = _of_keys(keys, np.zeros(1, np.intp), code)
    times = times[:, s.order]
    for depth in range(len(code.nodes)):
        _, slots, bit = _slots(s, depth)
        at = 0
        for x, size in zip(slots, SLOTS, strict=True):
            place = (x << 1 | bit).astype(np.intp) + at
            for own, n in zip(total, times, strict=True):
                np.add.at(own, place, n[: len(bit)])
            at += 2 * size


def count(texts: list[bytes], code: Code) -> np.ndarray:
    """Zeros and ones of every slot of all predictors, as one array."""
    total = np.zeros((1, 2 * sum(SLOTS)), np.int64)
    if texts:
        keys, times = _unique(_keys(texts)[0])
        _count_keys(total, keys, times[None], code)
    return total[0]


class SlotCounter:
    """``count`` of many chunks, a row for each kind of text. The slots of the contexts that are kept are worked out once, at the end."""

    def __init__(self, code: Code, kinds: int = 2, bits: int = KEPT_BITS) -> None:
        self._code, self._bits = code, bits
        self._total = np.zeros((kinds, 2 * sum(SLOTS)), np.int64)
        self._keys = np.full(1 << bits, _FREE)
        self._times = np.zeros((kinds, 1 << bits), np.int64)

    def add(self, kind: int, texts: list[bytes]) -> None:
        keys = _keys(texts)[0]
        slot = _slot(keys, self._bits)
        kept = self._keys.take(slot) == keys
        np.add.at(self._times[kind], slot[kept], 1)
        keys, times = _unique(keys[~kept])
        slot = _slot(keys, self._bits)
        free = self._keys.take(slot) == _FREE
        self._keys[slot[free]] = keys[free]
        kept = self._keys.take(slot) == keys
        self._times[kind, slot[kept]] += times[kept]
        if not kept.all():
            _count_keys(self._total[kind : kind + 1], keys[~kept], times[None, ~kept], self._code)

    def counts(self, at_once: int = 1 << 17) -> np.ndarray:
        used = np.flatnonzero(self._keys != _FREE)
        for begin in range(0, len(used), at_once):
            own = used[begin : begin + at_once]
            _count_keys(self._total, self._keys[own], self._times[:, own], self._code)
        self._keys[used] = _FREE
        self._times[:] = 0
        return self._total


class Model(NamedTuple):
    code: Code
    odds: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray


def tables(counts: np.ndarray) -> list[np.ndarray]:
    """Log odds of each predictor's slots; their last two bits say how much the slot has seen, in four grades."""
    odds, at = [], 0
    for size in SLOTS:
        part = np.maximum(counts[at : at + 2 * size], 0).reshape(-1, 2)
        own = np.log((part[:, 1] + 0.3) / (part[:, 0] + 0.3)).astype(np.float32)
        grade = np.searchsorted([1, 8, 64], part.sum(1), "right").astype(np.int32)
        odds.append((own.view(np.int32) & ~np.int32(3) | grade).view(np.float32))
        at += 2 * size
    return odds


def start_model(counts: np.ndarray, code: Code) -> Model:
    """Equal weights and no refinement."""
    weights = np.full((len(SLOTS) + 1, _GATES), 0.3, np.float32)
    weights[-1] = 0
    return Model(code, tables(counts), weights, np.tile(_grid(), (256, 1)).ravel())


def _grid() -> np.ndarray:
    return np.linspace(-8, 8, _STEPS).astype(np.float32)


def _inputs(m: Model, s: Sequence, depth: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """The node, the bit, what the predictors say and the gate, at one depth."""
    node, slots, bit = _slots(s, depth)
    inputs = [t.take(x, mode="clip") for t, x in zip(m.odds, slots, strict=True)]
    gate = ((inputs[2].view(np.int32) & 3) << 2 | inputs[3].view(np.int32) & 3).astype(np.intp)
    gate += min(depth, 7) * 16
    return node, bit, inputs, gate


def _mix(weights: np.ndarray, inputs: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
    total = weights[-1].take(gate, mode="clip")
    for w, x in zip(weights, inputs, strict=False):
        total += w.take(gate, mode="clip") * x
    return total


def _mixed(m: Model, s: Sequence, depth: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    node, bit, inputs, gate = _inputs(m, s, depth)
    return node, bit, inputs, gate, _mix(m.weights, inputs, gate)


def _cell(node: np.ndarray, total: np.ndarray) -> np.ndarray:
    step = np.clip(total * np.float32(2) + np.float32(16.5), 0, _STEPS - 0.5).astype(np.int32)
    return node.astype(np.intp) * _STEPS + step


def _lanes(gate: np.ndarray) -> np.ndarray:
    """Gates in turn in one of four lanes: neighbours mostly have the same gate, and a sum need not wait for the one before."""
    return gate + (np.arange(len(gate)) & 3) * _GATES


def _by_gate(lane: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.bincount(lane, values, 4 * _GATES).reshape(4, _GATES).sum(0)


class Learner:
    """Online: weights follow the error chunk by chunk, the refinement counts what each chunk's result was then worth.

    The first chunks are gone over several times. Models may differ from chunk to chunk in their tables.
    """

    def __init__(self, weights: np.ndarray, rate: float = 0.15) -> None:
        self.weights = weights.copy()
        self._rate = rate
        self._chunks = 0
        self._visits = np.zeros(_GATES)
        self._good, self._every = np.zeros(256 * _STEPS), np.zeros(256 * _STEPS)

    def add(self, m: Model, texts: list[bytes]) -> None:
        s, times = different(texts, m.code)
        times = times.astype(np.float32)
        self._chunks += 1
        turns = 4 if self._chunks <= 16 else 1
        for depth in range(len(m.code.nodes)):
            node, bit, inputs, gate = _inputs(m, s, depth)
            own = times[: len(bit)]
            lane = _lanes(gate)
            visits = _by_gate(lane, own)
            self._visits += visits
            n = np.maximum(visits, 32)
            for turn in range(turns):
                step = self._rate / ((1 + turn) * (1 + self._chunks / 64) ** 0.5)
                error = own * (bit - 1 / (1 + np.exp(-np.clip(_mix(self.weights, inputs, gate), -30, 30))))
                for j, x in enumerate(inputs):
                    self.weights[j] += step * np.clip(_by_gate(lane, error * x) / n, -1, 1)
                self.weights[-1] += step * np.clip(_by_gate(lane, error) / n, -1, 1)
            cell = _cell(node, _mix(self.weights, inputs, gate))
            bad, good = np.bincount(cell << 1 | bit.astype(np.intp), own, 2 * len(self._good)).reshape(-1, 2).T
            self._good += good
            self._every += good + bad

    def sums(self) -> np.ndarray:
        """Whole numbers that can be added up over learners: visits, weights by visits, and what the refinement counted."""
        weighted = np.rint(self.weights * self._visits * _WHOLE)
        return np.concatenate([self._visits, weighted.ravel(), self._good, self._every]).astype(np.int64)


def learned(m: Model, sums: np.ndarray) -> Model:
    """The model with the weights and the refinement of all learners; without any, as it is."""
    visits, weighted, good, every = np.split(sums.astype(float), np.cumsum([_GATES, m.weights.size, 256 * _STEPS]))
    mean = weighted.reshape(m.weights.shape) / _WHOLE / np.maximum(visits, 1)
    prior = 1 / (1 + np.exp(-np.tile(_grid(), 256).astype(float)))
    p = (good + 4 * prior) / (every + 4)
    weights = np.where(visits > 0, mean, m.weights).astype(np.float32)
    return m._replace(weights=weights, refined=np.log(p / (1 - p)).astype(np.float32))


def learn(m: Model, texts: list[bytes], chunk: int = 16_384) -> Model:
    """What one learner makes of these texts, chunks of about so many bytes at a time."""
    learner, own = Learner(m.weights), []
    for i, t in enumerate(texts):
        own.append(t)
        if sum(map(len, own)) >= chunk or i == len(texts) - 1:
            learner.add(m, own)
            own = []
    return learned(m, learner.sums())


class Scorer:
    """Natural logarithms of the probabilities of texts. What contexts are worth is kept for the chunks to come."""

    def __init__(self, m: Model, bits: int = KEPT_BITS) -> None:
        self._model, self._bits = m, bits
        self._keys, self._lost = np.full(1 << bits, _FREE), np.zeros(1 << bits)

    def add(self, texts: list[bytes]) -> np.ndarray:
        """Of each text with its end."""
        if not texts:
            return np.zeros(0)
        keys, starts = _keys(texts)
        slot = _slot(keys, self._bits)
        lost = self._lost.take(slot)
        new = np.flatnonzero(self._keys.take(slot) != keys)
        if len(new):
            keys = keys.take(new)
            first, place = _firsts(keys)
            keys = keys.take(first)
            own = _lost(self._model, keys)
            lost[new] = own.take(place)
            # Of several that share a slot, the last one takes it in both.
            slot = slot.take(new).take(first)
            self._keys[slot], self._lost[slot] = keys, own
        return -np.add.reduceat(lost, starts)


def _lost(m: Model, keys: np.ndarray) -> np.ndarray:
    """What each byte in its context costs."""
    s = _of_keys(keys, np.zeros(1, np.intp), m.code)
    # 1 / p of each byte is the product of its decisions'; clipped odds keep it finite.
    inverse = np.ones(len(s.symbols))
    for depth in range(len(m.code.nodes)):
        node, bit, _, _, odds = _mixed(m, s, depth)
        odds = (odds + m.refined.take(_cell(node, odds), mode="clip")) * np.float32(0.5)
        odds *= np.float32(1) - np.float32(2) * bit.astype(np.float32)
        np.clip(odds, -20, 20, out=odds)
        inverse[: len(odds)] *= 1 + np.exp(odds, dtype=np.float64)
    lost = np.empty(len(inverse))
    lost[s.order] = np.log(inverse)
    return lost


def log_probabilities(m: Model, texts: list[bytes]) -> np.ndarray:
    """Natural logarithm of the probability of each text with its end."""
    return Scorer(m).add(texts)
