"""Adaptive context-mixing range coder for token ids.

A block's ids are numbered among its distinct ids, which are kept beside it. A
number is coded as four-bit digits, the highest first. For each digit three
adaptive distributions predict: by the digits so far alone (order 0), with the
id before (order 1), and with the two ids before (order 2). They are mixed by
weights that follow how well each has predicted lately, and a range coder with
64-bit state spends the mixed probability. All arithmetic is on integers, save
single divisions of exactly known rounding, so every machine decodes alike.

Blocks are coded independently from a fresh model. The blocks of a stretch run
in lockstep, one lane each, so that a step works on all of them at once.
"""

from __future__ import annotations

import numpy as np

ROWS = 128  # distributions a lane keeps for each order
SCALE = 15  # bits of a probability
RATE = 4
WEIGHT = 16  # bits of a weight
ORDERS = 3
DIGIT_BITS = 4
DIGIT = 1 << DIGIT_BITS

_LOW32 = np.uint64(0xFFFFFFFF)
_U32 = np.uint64(32)
_SCALE = np.uint64(SCALE)
_FRESH = (np.arange(DIGIT) << (SCALE - DIGIT_BITS)).astype(np.int16)
_PLACES = np.arange(DIGIT)
# After digit x, the sums below each digit move towards these; every digit keeps at least one unit.
_ROW = np.dtype(f"V{2 * DIGIT}")
_TARGET = np.where(_PLACES[None, :] > _PLACES[:, None], (1 << SCALE) - DIGIT + _PLACES[None, :], _PLACES[None, :]).astype(np.int16)


class _Model:
    """The distributions and weights of all lanes; the three orders lie one after another."""

    def __init__(self, lanes: int) -> None:
        self.table = np.empty((ORDERS * lanes * ROWS, DIGIT), np.int16)
        self.table[:] = _FRESH
        self._whole = self.table.view(_ROW).ravel()  # a distribution as one item, which numpy moves much faster
        order, lane = np.arange(ORDERS)[:, None], np.arange(lanes)[None, :]
        self._first = (order * lanes + lane) * ROWS
        self.weights = np.full((ORDERS, lanes), (1 << WEIGHT) // ORDERS, np.int32)
        self.weights[0] += (1 << WEIGHT) - self.weights.sum(axis=0, dtype=np.int32)
        self.narrow(lanes)

    def narrow(self, lanes: int) -> None:
        """Go on with the first `lanes` only: shorter blocks stand last."""
        self.lanes = lanes
        self._first = self._first[:, :lanes].copy()
        self.weights = self.weights[:, :lanes].copy()
        self._row = np.arange(lanes) * DIGIT
        self._rows = np.arange(ORDERS * lanes).reshape(ORDERS, lanes) * DIGIT

    def contexts(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """What the ids before contribute to the place of a distribution."""
        first = (one + np.uint32(1)) * np.uint32(0x9E3779B1)
        second = (first ^ (first >> np.uint32(15))) * np.uint32(0x85EBCA77) + two * np.uint32(0xC2B2AE3D)
        return np.stack([np.zeros_like(one), first, second])

    def load(self, contexts: np.ndarray, digits: np.ndarray) -> None:
        """Fetch the distributions for the next digit; `digits` are those so far after a leading 1."""
        key = contexts ^ (digits * np.uint32(0x27D4EB2F))
        key = (key ^ (key >> np.uint32(13))) * np.uint32(0x2C1B3C6D)
        self._at = (self._first + (key >> np.uint32(32 - ROWS.bit_length() + 1))).ravel()
        self._found = self._whole.take(self._at).view(np.int16)

    def _below(self, digit: np.ndarray) -> np.ndarray:
        """The sum below `digit` in each order."""
        return self._found.take(self._rows + digit).astype(np.int32)

    def interval(self, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mixed sum below `digit`, and the mixed width of `digit`; then learn it."""
        below = self._below(digit)
        last = digit == DIGIT - 1
        above = np.where(last, 1 << SCALE, self._below(digit + 1 - last))
        weights = self.weights
        mixed_below = (below[0] * weights[0] + below[1] * weights[1] + below[2] * weights[2]) >> WEIGHT
        mixed_above = (above[0] * weights[0] + above[1] * weights[1] + above[2] * weights[2]) >> WEIGHT
        mixed_above = np.where(last, 1 << SCALE, mixed_above)
        self._learn(digit, above - below)
        return mixed_below.astype(np.uint64), (mixed_above - mixed_below).astype(np.uint64)

    def digit_at(self, value: np.ndarray) -> np.ndarray:
        """The digit whose mixed interval holds `value`."""
        found = self._found.reshape(ORDERS, self.lanes, DIGIT)
        weights = self.weights[:, :, None]
        mixed = (found[0] * weights[0] + found[1] * weights[1] + found[2] * weights[2]) >> WEIGHT
        under = mixed <= value[:, None]
        beyond = under.argmin(axis=1)  # the first digit that begins beyond `value`, 0 if there is none
        return np.where(beyond == 0, DIGIT, beyond) - 1

    def _learn(self, digit: np.ndarray, good: np.ndarray) -> None:
        found = self._found.reshape(ORDERS, self.lanes, DIGIT)
        found += (_TARGET.take(digit, axis=0) - found) >> RATE
        self._whole[self._at] = self._found.view(_ROW)
        share = (good[1:] * float(1 << WEIGHT) / (good[0] + good[1] + good[2])).astype(np.int32)
        self.weights[1:] += (share - self.weights[1:]) >> 5
        self.weights[0] = (1 << WEIGHT) - self.weights[1] - self.weights[2]


def digits_for(distinct: int) -> int:
    """Digits of the numbers below `distinct`."""
    return max(1, -(-(distinct - 1).bit_length() // DIGIT_BITS))


def _running(model: _Model, sizes: np.ndarray, step: int, *state: np.ndarray) -> list[np.ndarray]:
    """The state of the lanes that have a number at `step`."""
    lanes = int(np.searchsorted(-sizes, -step, side="left"))
    if lanes < model.lanes:
        model.narrow(lanes)
    return [s[:lanes] for s in state]


def encode_blocks(blocks: list[np.ndarray], digits: int) -> list[bytes]:
    """Code blocks of numbers of at most `digits` digits; no block is longer than the one before."""
    sizes = np.array([len(block) for block in blocks], np.int64)
    longest, lanes = int(sizes.max(initial=0)), len(blocks)
    numbers = np.zeros((longest, lanes), np.uint32)
    for lane, block in enumerate(blocks):
        numbers[: len(block), lane] = block
    model = _Model(lanes)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    words = np.zeros((lanes, longest * digits // 2 + 4), np.uint32)
    filled = np.zeros(lanes, np.int64)
    one = two = np.zeros(lanes, np.uint32)
    for step in range(longest):
        low_now, width_now, one, two = _running(model, sizes, step, low, width, one, two)
        current = numbers[step, : len(one)]
        contexts, sofar = model.contexts(one, two), np.ones_like(one)
        for place in range(digits - 1, -1, -1):
            digit = (current >> np.uint32(DIGIT_BITS * place)) & np.uint32(DIGIT - 1)
            model.load(contexts, sofar)
            below, size = model.interval(digit.astype(np.int64))
            unit = width_now >> _SCALE
            low_now += unit * below
            width_now[:] = unit * size
            tight = np.flatnonzero(width_now <= _LOW32)
            if tight.size:
                _settle(low_now, width_now, tight)
                words[tight, filled[tight]] = (low_now[tight] >> _U32).astype(np.uint32)
                filled[tight] += 1
                low_now[tight] <<= _U32
                width_now[tight] <<= _U32
            sofar = (sofar << np.uint32(DIGIT_BITS)) | digit
        one, two = current, one
    out = []
    for lane in range(lanes):
        tail = np.array([low[lane] >> _U32, low[lane] & _LOW32], np.uint32)
        out.append(np.append(words[lane, : filled[lane]], tail).astype("<u4").tobytes())
    return out


def _settle(low: np.ndarray, width: np.ndarray, tight: np.ndarray) -> None:
    """Where a narrow interval spans two values of the upper half, give up the part beyond the first."""
    a, w = low[tight], width[tight]
    spans = ((a ^ (a + w - np.uint64(1))) >> _U32) != 0
    if spans.any():
        lanes = tight[spans]
        width[lanes] = (_LOW32 + np.uint64(1)) - (low[lanes] & _LOW32)


def decode_blocks(coded: list[bytes], sizes: np.ndarray, digits: int) -> list[np.ndarray]:
    """The numbers of each block; `sizes` never rise."""
    sizes = np.asarray(sizes, np.int64)
    longest, lanes = int(sizes.max(initial=0)), len(coded)
    numbers = np.zeros((longest, lanes), np.uint32)
    model = _Model(lanes)
    lengths = np.array([len(block) // 4 for block in coded], np.int64)
    words = np.zeros((lanes, int(lengths.max(initial=0)) + 2), np.uint64)
    for lane, block in enumerate(coded):
        words[lane, : lengths[lane]] = np.frombuffer(block, "<u4")
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    code = (words[:, 0] << _U32) | words[:, 1]
    used, last = np.full(lanes, 2, np.int64), words.shape[1] - 1
    one = two = np.zeros(lanes, np.uint32)
    for step in range(longest):
        low_now, width_now, code_now, one, two = _running(model, sizes, step, low, width, code, one, two)
        contexts, sofar = model.contexts(one, two), np.ones_like(one)
        for _ in range(digits):
            model.load(contexts, sofar)
            unit = width_now >> _SCALE
            value = np.minimum((code_now - low_now) // unit, np.uint64((1 << SCALE) - 1)).astype(np.int32)
            at = model.digit_at(value)
            below, size = model.interval(at)
            low_now += unit * below
            width_now[:] = unit * size
            tight = np.flatnonzero(width_now <= _LOW32)
            if tight.size:
                _settle(low_now, width_now, tight)
                # A damaged block may ask for more than there is; its checksum tells.
                code_now[tight] = (code_now[tight] << _U32) | words[tight, np.minimum(used[tight], last)]
                used[tight] += 1
                low_now[tight] <<= _U32
                width_now[tight] <<= _U32
            sofar = (sofar << np.uint32(DIGIT_BITS)) | at.astype(np.uint32)
        current = sofar & np.uint32((1 << (DIGIT_BITS * digits)) - 1)
        numbers[step, : len(current)] = current
        one, two = current, one
    return [numbers[:size, lane] for lane, size in enumerate(sizes.tolist())]
