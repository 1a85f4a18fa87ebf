"""Adaptive range coder for token ids, run over many blocks at once.

Every block starts with an empty model, so blocks are coded independently of one another; a task codes a thousand of them in
lockstep, one id of each at a time, with NumPy over the blocks. All arithmetic is in integers, so that what a block becomes
does not depend on its neighbours.

For each id the model first offers the id that followed the last two ids (order 2), then the one that followed the last id
(order 1). Whether an offer is right is coded with a probability mixed, in the logistic domain and with weights learned on the
way, from the confidence of the order-2 offer, that of the order-1 offer, and how often offers were right lately. An id that
neither order foresees is coded in four digits of four bits with adaptive frequencies (order 0).
"""

from __future__ import annotations

import zlib

import numpy as np

MAGIC = b"TID1"
#: Ids of a block; slots of the order-2 and order-1 tables of a block.
BLOCK, SLOTS = 4096, 1024
#: Contexts of the four digits: none, first digit, first two, a digest of the first three.
_DIGIT_AT = (0, 1, 17, 273)
_CONTEXTS = 273 + 256
_STEP, _TOTAL = 24, 1 << 13
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
_U16, _U64 = np.uint64(16), np.uint64

# logistic tables as in mixing coders: stretch(p) = ln(p / (1 - p)) and its inverse, in fixed point
_X = (np.arange(4096) + 0.5) / 4096
_STRETCH = np.round(np.log(_X / (1 - _X)) * 256).astype(np.int64)
_SQUASH = np.clip(np.round(4096 / (1 + np.exp(-(np.arange(-2047, 2048)) / 256))), 1, 4095).astype(np.int64)


class _Model:
    """Tables of ``lanes`` blocks; lane k is block k."""

    def __init__(self, lanes: int):
        self.offer = [np.zeros((lanes, SLOTS), np.int32) - 1 for _ in range(2)]  # order 2, order 1
        self.trust = [np.zeros((lanes, SLOTS), np.int8) for _ in range(2)]
        self.flags = np.full((2, 40, lanes), 1 << 15, np.int32)  # for each of the two questions: 16 + 16 + 8 contexts
        self.weights = np.full((2, 3, lanes), 1 << 15, np.int32)
        self.lately = np.zeros((2, lanes), np.int64)
        self.digits = np.ones((lanes * _CONTEXTS, 16), np.int16)
        self.last = np.zeros((2, lanes), np.int64)

    def places(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        first, second = self.last[0, :n], self.last[1, :n]
        return (first * 40503 + second * 30011 + (second >> 5)) % SLOTS, (first * 2654435761 >> 7) % SLOTS

    def chance(self, lanes: np.ndarray, question: int, trust2: np.ndarray, trust1: np.ndarray, same: np.ndarray) -> tuple:
        """Chance (of 65536) that the offer is right, and what ``learn`` needs."""
        at = np.stack([trust2 * 2 + same, 16 + trust1 * 2 + same, 32 + self.lately[question, lanes]])
        flags = self.flags[question][at, lanes]
        stretched = _STRETCH[flags >> 4]
        weights = self.weights[question][:, lanes]
        mixed = np.clip((weights.astype(np.int64) * stretched).sum(axis=0) >> 16, -2047, 2047)
        return np.clip(_SQUASH[mixed + 2047] * 16, 32, 65536 - 32), (at, flags, stretched, weights, mixed)

    def learn(self, lanes: np.ndarray, question: int, state: tuple, right: np.ndarray) -> None:
        at, flags, stretched, weights, mixed = state
        self.flags[question][at, lanes] = flags + (((right << 16) - right - flags) >> 4)
        error = ((right << 12) - _SQUASH[mixed + 2047]) * 6
        self.weights[question][:, lanes] = np.clip(weights + ((stretched * error + (1 << 13)) >> 14), -(1 << 18), 1 << 18)
        self.lately[question, lanes] = (self.lately[question, lanes] * 2 + right) & 7

    def take(self, n: int, places: tuple, offers: list, trusts: list, ids: np.ndarray) -> None:
        """Remember what followed the last ids."""
        lanes = np.arange(n)
        for order, (at, offer, trust) in enumerate(zip(places, offers, trusts, strict=True)):
            right = offer == ids
            fresh = ~right & (trust == 0)
            self.offer[order][lanes, at] = np.where(fresh, ids, offer)
            self.trust[order][lanes, at] = np.where(right, np.minimum(trust + 1, 7), np.where(fresh, 1, trust >> 1))
        self.last[1, :n] = self.last[0, :n]
        self.last[0, :n] = ids

    def digit_rows(self, lanes: np.ndarray, digit: int, before: np.ndarray) -> np.ndarray:
        context = before if digit < 3 else (before * 40503 >> 4) & 255
        return lanes * _CONTEXTS + _DIGIT_AT[digit] + context

    def learn_digit(self, rows: np.ndarray, values: np.ndarray, total: np.ndarray) -> None:
        self.digits[rows, values] += _STEP
        full = rows[total + _STEP > _TOTAL]
        if len(full):
            self.digits[full] = (self.digits[full] >> 1) | 1


class _Coder:
    """Range coder states of many blocks: intervals of 64 bits, 16 of them written or read at a time."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)

    def narrow(self, lanes, start: np.ndarray, size: np.ndarray, unit: np.ndarray) -> None:
        self.low[lanes] += unit * start.astype(np.uint64)
        self.range[lanes] = unit * size.astype(np.uint64)
        while True:
            low, wide = self.low[lanes], self.range[lanes]
            same = (low ^ (low + wide)) < _TOP
            short = ~same & (wide < _BOTTOM)
            if short.any():  # give up what lies beyond the next multiple, so that 16 bits are settled
                wide = np.where(short, (~low + _U64(1)) & (_BOTTOM - _U64(1)), wide)
                same |= short
            settled = np.flatnonzero(same)
            if not len(settled):
                return
            lanes = lanes[settled]
            self.shift(lanes, low[settled])
            self.low[lanes] = low[settled] << _U16
            self.range[lanes] = wide[settled] << _U16


class _Writer(_Coder):
    def __init__(self, lanes: int, most: int):
        super().__init__(lanes)
        self.words = np.zeros((lanes, most + 64), np.uint16)
        self.at = np.zeros(lanes, np.int64)

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        if int(self.at[lanes].max()) >= self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
        self.words[lanes, self.at[lanes]] = (low >> np.uint64(48)).astype(np.uint16)
        self.at[lanes] += 1

    def finish(self) -> list[bytes]:
        lanes = np.arange(len(self.low))
        for _ in range(4):
            self.shift(lanes, self.low)
            self.low <<= _U16
        return [self.words[k, : self.at[k]].astype("<u2").tobytes() for k in range(len(lanes))]


class _Reader(_Coder):
    def __init__(self, coded: list[bytes]):
        super().__init__(len(coded))
        longest = max(len(c) for c in coded) // 2
        self.words = np.zeros((len(coded), longest + 8), np.uint16)
        for k, c in enumerate(coded):
            self.words[k, : len(c) // 2] = np.frombuffer(c, "<u2")
        self.at = np.full(len(coded), 4)
        self.code = np.zeros(len(coded), np.uint64)
        for k in range(4):
            self.code = (self.code << _U16) | self.words[:, k].astype(np.uint64)

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        self.code[lanes] = (self.code[lanes] << _U16) | self.words[lanes, np.minimum(self.at[lanes], self.words.shape[1] - 1)].astype(np.uint64)
        self.at[lanes] += 1

    def reach(self, lanes: np.ndarray, unit: np.ndarray) -> np.ndarray:
        return ((self.code[lanes] - self.low[lanes]) // unit).astype(np.int64)


def _run(lengths: np.ndarray, coder: _Coder, ids: np.ndarray | None) -> np.ndarray:
    """Code ``ids`` (positions x lanes), or without them decode; lanes are in the order of falling lengths."""
    lanes, most = len(lengths), int(lengths[0])
    model = _Model(lanes)
    reading = ids is None
    out = np.zeros((most, lanes), np.int32) if reading else ids
    for t in range(most):
        n = int(np.searchsorted(-lengths, -t, "left"))
        all_lanes = np.arange(n)
        places = model.places(n)
        offers = [model.offer[k][all_lanes, places[k]].astype(np.int64) for k in range(2)]
        trusts = [model.trust[k][all_lanes, places[k]].astype(np.int64) for k in range(2)]
        same = (offers[0] == offers[1]).astype(np.int64)
        ask = np.flatnonzero(offers[0] >= 0)
        known = np.full(n, -1, np.int64)
        for question in range(2):
            if len(ask):
                offer = offers[question][ask]
                chance, state = model.chance(ask, question, trusts[0][ask], trusts[1][ask], same[ask])
                unit = coder.range[ask] >> _U16
                if reading:
                    right = (coder.reach(ask, unit) < chance).astype(np.int64)
                else:
                    right = (offer == ids[t, ask]).astype(np.int64)
                coder.narrow(ask, np.where(right, 0, chance), np.where(right, chance, 65536 - chance), unit)
                model.learn(ask, question, state, right)
                hit = ask[right > 0]
                known[hit] = offers[question][hit]
            # the second offer is made only if it is another one
            ask = np.flatnonzero((known < 0) & (offers[1] >= 0) & (same == 0))
        rest = np.flatnonzero(known < 0)
        if len(rest):
            value = np.zeros(len(rest), np.int64)
            for digit in range(4):
                rows = model.digit_rows(rest, digit, value)
                ends = np.cumsum(model.digits[rows], axis=1, dtype=np.int64)
                total = ends[:, -1]
                unit = coder.range[rest] // total.astype(np.uint64)
                if reading:
                    own = (ends <= np.minimum(coder.reach(rest, unit), total - 1)[:, None]).sum(axis=1)
                else:
                    own = ids[t, rest].astype(np.int64) >> (12 - 4 * digit) & 15
                k = np.arange(len(rest))
                stop = ends[k, own]
                size = model.digits[rows, own].astype(np.int64)
                coder.narrow(rest, stop - size, size, unit)
                model.learn_digit(rows, own, total)
                value = value * 16 + own
            known[rest] = value
        model.take(n, places, offers, trusts, known)
        if reading:
            out[t, :n] = known
    return out


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Ids below 65,536 as coded blocks, one after the other: magic, number of ids, coded bytes, checksum of the ids, code."""
    if len(ids) == 0:
        return b""
    if int(ids.max()) > 0xFFFF:
        raise ValueError("ids must be below 65536")
    parts = [ids[s : s + block] for s in range(0, len(ids), block)]
    lengths = np.array([len(p) for p in parts])
    table = np.zeros((int(lengths[0]), len(parts)), np.int32)
    for k, part in enumerate(parts):
        table[: len(part), k] = part
    writer = _Writer(len(parts), int(lengths[0]))
    _run(lengths, writer, table)
    out = []
    for part, code in zip(parts, writer.finish(), strict=True):
        head = np.array([len(part), len(code), zlib.crc32(part.astype("<u4").tobytes())], "<u4").tobytes()
        out += [MAGIC, head, code]
    return b"".join(out)


def decode_blocks(coded: bytes) -> np.ndarray:
    """The ids of ``encode_blocks``; raises ValueError where a block is damaged."""
    heads, codes, at = [], [], 0
    while at < len(coded):
        if coded[at : at + 4] != MAGIC or at + 16 > len(coded):
            raise ValueError(f"no block at byte {at}")
        heads.append(np.frombuffer(coded, "<u4", 3, at + 4))
        codes.append(coded[at + 16 : at + 16 + int(heads[-1][1])])
        at += 16 + int(heads[-1][1])
    if not heads:
        return np.zeros(0, np.uint32)
    lengths = np.array([int(h[0]) for h in heads])
    order = np.argsort(-lengths, kind="stable")
    table = _run(lengths[order], _Reader([codes[k] for k in order]), None)
    parts: list = [None] * len(heads)
    for lane, k in enumerate(order):
        parts[k] = table[: lengths[k], lane].astype("<u4")
        if zlib.crc32(parts[k].tobytes()) != int(heads[k][2]):
            raise ValueError(f"block {k} does not have the ids that were written")
    return np.concatenate(parts)
