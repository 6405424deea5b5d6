"""Adaptive context-mixing range coder for token ids, in lanes.

A block of ids is coded from an empty model, so blocks can be read alone.  Three predictions are mixed for each id.
Order 2 (the two ids before it, hashed) and order 1 (the id before it) each name the id that has followed their context, with a
confidence that grows when it is right and falls when it is wrong; order 0 is the frequency of each id so far.  The
weights are those that would have served best so far in the same pair of confidences: how often order 2 was right, how
often order 1 was right where order 2 was not, and the rest for order 0.  Weights, frequencies, predictions: all are learnt while
coding, by encoder and decoder alike.

The mixture is a cumulative distribution in whole numbers: order 0's scaled by its weight, plus the two named ids'
masses.  A range coder narrows a 64-bit interval by it and gives away 32 bits at a time; where the upper halves of the
interval's ends cannot agree, the interval is cut short instead of carrying.

A block is cut into lanes of consecutive ids.  All lanes code their next id in the same numpy step, each with
its own interval and contexts; they share the model, which takes in a step's ids when the step is over (of lanes that
write to one context, the last counts).  All arithmetic is in 64-bit integers, so decoding gives the ids back on any machine.
"""

from __future__ import annotations

import struct

import numpy as np

#: Ids of a block at most, lanes at most, and ids a lane at least (in a block that can fill one lane).
BLOCK_IDS = 1 << 22
LANES = 4096
LANE_IDS = 256
#: Weights are in 2^-MIX; order 0 keeps LEAST of them, so every id can be coded.
MIX = 10
LEAST = 16
CONFIDENT = 7
STATES = 2 * (CONFIDENT + 1) ** 2
#: Steps whose ids are gathered from the lanes, or put into them, at once.
AT_ONCE = 32
#: Counts of a pair of confidences are halved beyond this sum.
MEMORY = 1 << 14
HALF = np.uint64(32)
LOW = np.uint64((1 << 32) - 1)
FULL = np.uint64(1 << 32)
HASH1, HASH2 = 0x1B873593CC9E2D51, 0x27D4EB2F165667C5


#: Change of an entry's confidence when its id was right (index 8 and up) or wrong; a wrong one with none left is replaced.
STEP = np.array([(c >> 1) - c for c in range(8)] + [int(c < CONFIDENT) for c in range(8)], np.int64)


class Model:
    """What is known of a block so far.  Ids are numbered by their order among the block's distinct ids."""

    def __init__(self, distinct: int, ids: int):
        self.distinct = distinct
        # frequencies sum to 2^scale; each id has one at least
        self.scale = max(16, (distinct - 1).bit_length() + 1)
        self.bits = min(18, max(8, ids.bit_length()))
        self.counts = np.zeros(distinct, np.int64)
        self.total = self.next_scaling = self.steps = 0
        self.pending: list[np.ndarray] = []
        # predicted id and confidence (3 bits) of each context; contexts 0: nothing before
        self.first = np.zeros(distinct + 1, np.int32)
        self.second = np.zeros(1 << self.bits, np.int32)
        # by pair of confidences: neither right, order 1 alone, order 2 alone, both
        self.right = np.zeros(4 * STATES, np.int64)
        self.rescale()
        self.reweigh()

    def rescale(self) -> None:
        for x in self.pending:
            self.counts += np.bincount(x, minlength=self.distinct)
        self.pending = []
        self.total = int(self.counts.sum())
        free = (1 << self.scale) - self.distinct
        freq = 1 + (self.counts * free // self.total if self.total else np.zeros(self.distinct, np.int64))
        freq[int(freq.argmax())] += (1 << self.scale) - int(freq.sum())
        self.freq = freq
        self.below = np.concatenate([[0], np.cumsum(freq)])
        self.at = np.repeat(np.arange(self.distinct), freq)
        self.next_scaling = self.total + max(LANES // 4, self.total // 8)

    def reweigh(self) -> None:
        right = self.right.reshape(STATES, 4)
        all_ = right.sum(axis=1)
        right[all_ > MEMORY] >>= 1
        free = (1 << MIX) - LEAST
        all_ = right.sum(axis=1) + 4
        share1, share2 = (right[:, 1] + 1) * free // all_, (right[:, 2] + right[:, 3] + 1) * free // all_
        self.mass1, self.mass2 = share1 << self.scale, share2 << self.scale
        self.weight0 = (1 << MIX) - share1 - share2

    def predict(self, p1: np.ndarray, p2: np.ndarray):
        """For the ids before each lane's next (1 + number; 0: none): the predicted ids, their masses, order 0's weight."""
        self.slot = (p2 * HASH2 + p1 * HASH1 >> 32) & (1 << self.bits) - 1
        # widened once: numpy would do so again in each step that mixes widths
        self.p1, self.e2, self.e1 = p1, self.second.take(self.slot).astype(np.int64), self.first.take(p1).astype(np.int64)
        c2, c1 = self.e2 >> 3, self.e1 >> 3
        self.sure2, self.sure1 = self.e2 & 7, self.e1 & 7
        self.same = c1 == c2
        self.state = (self.sure2 << 3) + self.sure1 + self.same * (STATES // 2)
        return c1, c2, self.mass1.take(self.state), self.mass2.take(self.state), self.weight0.take(self.state)

    def learn(self, x: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        """Take in the ids of a step and whether (1 or 0) they are those predicted."""
        for table, at, e, sure, hit in ((self.second, self.slot, self.e2, self.sure2, hit2), (self.first, self.p1, self.e1, self.sure1, hit1)):
            kind = sure + (hit << 3)
            e = e + STEP.take(kind)
            new = np.flatnonzero(kind == 0)
            e[new] = x[new] << 3 | 1
            table[at] = e.astype(np.int32)
        self.right += np.bincount((self.state << 2) + hit1 + (hit2 << 1), minlength=4 * STATES)
        self.steps += 1
        if self.steps < 16 or self.steps % 8 == 0:
            self.reweigh()
        self.pending.append(x)
        self.total += len(x)
        if self.total >= self.next_scaling:
            self.rescale()


def narrow(low: np.ndarray, width: np.ndarray, below: np.ndarray, size: np.ndarray, shift: np.uint64):
    """Narrow the intervals of the first lanes; returns the lanes that give away 32 bits, and these."""
    a = len(below)
    unit = width[:a] >> shift
    lo, wi = low[:a] + unit * below.view(np.uint64), unit * size.view(np.uint64)
    give = np.flatnonzero(wi < FULL)
    g, w = lo[give], wi[give]
    w = np.where(g >> HALF != (g + w - np.uint64(1)) >> HALF, FULL - (g & LOW), w)
    lo[give], wi[give] = g << HALF, w << HALF
    low[:a], width[:a] = lo, wi
    return give, g >> HALF


def lane_shape(n: int) -> tuple[int, int, int]:
    """Lanes, ids of each, and how many of the first lanes have one more."""
    lanes = max(1, min(LANES, n // LANE_IDS))
    return lanes, n // lanes, n % lanes


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and each id's number among them."""
    if int(ids.max()) >= 1 << 24:
        return np.unique(ids, return_inverse=True)
    at = ids.astype(np.int64)
    there = np.zeros(int(at.max()) + 1, bool)
    there[at] = True
    return np.flatnonzero(there).astype(np.uint32), (np.cumsum(there) - 1).take(at)


def _varints(values: np.ndarray) -> bytes:
    """Numbers below 2^35 as little-endian base-128 digits."""
    values = values.astype(np.uint64)
    digits = np.stack([values >> np.uint64(7 * i) & np.uint64(127) for i in range(5)], axis=1).astype(np.uint8)
    more = np.stack([values >> np.uint64(7 * (i + 1)) > 0 for i in range(5)], axis=1)
    keep = np.concatenate([np.ones((len(values), 1), bool), more[:, :4]], axis=1)
    return (digits | more.astype(np.uint8) << 7)[keep].tobytes()


def _from_varints(data: bytes, count: int) -> tuple[np.ndarray, int]:
    raw = np.frombuffer(data, np.uint8, min(len(data), 5 * count))
    ends = np.flatnonzero(raw < 128)[:count]
    if len(ends) < count:
        raise ValueError("numbers cut off")
    size = int(ends[-1]) + 1 if count else 0
    starts = np.concatenate([[0], ends[:-1] + 1]) if count else np.empty(0, np.int64)
    digit = np.arange(size) - np.repeat(starts, np.diff(np.concatenate([starts, [size]])))
    parts = (raw[:size] & 127).astype(np.uint64) << (7 * digit).astype(np.uint64)
    return (np.add.reduceat(parts, starts) if count else parts), size


def encode(ids: np.ndarray) -> bytes:
    """The coded form of a block of 1 to ``BLOCK_IDS`` ids (unsigned 32-bit); an empty block is no bytes."""
    n = len(ids)
    if not n:
        return b""
    alphabet, x = _distinct(ids)
    lanes, each, more = lane_shape(n)
    starts = np.arange(lanes) * each + np.minimum(np.arange(lanes), more)
    model = Model(len(alphabet), n)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2 ** 64 - 1, np.uint64)
    p1 = p2 = np.zeros(lanes, np.int64)
    shift = np.uint64(model.scale + MIX)
    out_lane, out_word = [], []
    for t in range(each + (more > 0)):
        a = lanes if t < each else more
        if a < lanes:  # the last step of the longer lanes; the others are at their end
            p1, p2 = p1[:a], p2[:a]
        if t % AT_ONCE == 0:
            ahead = np.ascontiguousarray(x.take(starts[:, None] + np.arange(t, t + AT_ONCE), mode="clip").T)
        sym = ahead[t % AT_ONCE, :a]
        c1, c2, m1, m2, w0 = model.predict(p1, p2)
        hit1, hit2 = (c1 == sym).view(np.int8).astype(np.int64), (c2 == sym).view(np.int8).astype(np.int64)
        below = w0 * model.below.take(sym) + m1 * (c1 < sym) + m2 * (c2 < sym)
        size = w0 * model.freq.take(sym) + m1 * hit1 + m2 * hit2
        give, word = narrow(low, width, below, size, shift)
        out_lane.append(give)
        out_word.append(word.astype(np.uint32))
        model.learn(sym, hit1, hit2)
        p1, p2 = sym + 1, p1
    out_lane.append(np.arange(lanes))
    out_word.append(((low + LOW) >> HALF).astype(np.uint32))
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane.astype(np.min_scalar_type(lanes)), kind="stable")  # by digits, as the numbers are short
    steps = np.diff(np.concatenate([[0], alphabet.astype(np.int64)]))
    head = _varints(steps) + _varints(np.bincount(lane, minlength=lanes))
    return struct.pack("<II", n, len(alphabet)) + head + word[order].astype("<u4").tobytes()


def decode(data: bytes) -> np.ndarray:
    """The ids of a coded block."""
    if not data:
        return np.empty(0, np.uint32)
    n, distinct = struct.unpack_from("<II", data)
    steps, used = _from_varints(data[8:], distinct)
    alphabet = np.cumsum(steps.astype(np.int64)).astype(np.uint32)
    lanes, each, more = lane_shape(n)
    words, used2 = _from_varints(data[8 + used:], lanes)
    words = words.astype(np.int64)
    # two words behind each lane's own are read as nought
    source = np.zeros(int(words.sum()) + 2 * lanes, np.uint64)
    given = np.frombuffer(data, "<u4", int(words.sum()), 8 + used + used2)
    lane_of = np.repeat(np.arange(lanes), words)
    source[np.arange(len(given)) + 2 * lane_of] = given
    at = np.cumsum(words) - words + 2 * np.arange(lanes)
    code = source[at] << HALF | source[at + 1]
    at += 2
    model = Model(distinct, n)
    starts = np.arange(lanes) * each + np.minimum(np.arange(lanes), more)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 2 ** 64 - 1, np.uint64)
    p1 = p2 = np.zeros(lanes, np.int64)
    shift, top = np.uint64(model.scale + MIX), (1 << model.scale + MIX) - 1
    # a short division where all goals fit
    narrowest = np.uint32 if model.scale + MIX <= 32 else np.int64
    out, gathered = np.empty(n, np.int64), np.empty((AT_ONCE, lanes), np.int64)
    for t in range(each + (more > 0)):
        a = lanes if t < each else more
        if a < lanes:
            p1, p2 = p1[:a], p2[:a]
        c1, c2, m1, m2, w0 = model.predict(p1, p2)
        unit = width[:a] >> shift
        goal = np.minimum(((code[:a] - low[:a]) // unit).astype(np.int64), top)
        # how far the goal lies behind the start of each named id's share, and that share; within one, it is that id
        size1, size2 = w0 * model.freq.take(c1) + m1, w0 * model.freq.take(c2) + m2
        behind1, behind2 = goal - w0 * model.below.take(c1) - m2 * (c2 < c1), goal - w0 * model.below.take(c2) - m1 * (c1 < c2)
        size1, size2 = size1 + m2 * model.same, size2 + m1 * model.same
        past1, past2 = behind1 >= size1, behind2 >= size2
        in1, in2 = (behind1 >= 0) & ~past1, (behind2 >= 0) & ~past2
        # elsewhere the masses of the named ids that lie below are taken away
        rest = goal - m1 * past1 - m2 * past2
        sym = model.at.take(rest.astype(narrowest) // w0.astype(narrowest), mode="clip")
        np.copyto(sym, c1, where=in1)
        np.copyto(sym, c2, where=in2)
        hit1, hit2 = in1.astype(np.int64), in2.astype(np.int64)
        below = w0 * model.below.take(sym) + m1 * (c1 < sym) + m2 * (c2 < sym)
        size = w0 * model.freq.take(sym) + m1 * hit1 + m2 * hit2
        give, _ = narrow(low, width, below, size, shift)
        code[give] = code[give] << HALF | source[np.minimum(at[give], len(source) - 1)]
        at[give] += 1
        gathered[t % AT_ONCE, :a] = sym
        if a < lanes:
            out[starts[:a] + t] = sym
        elif (done := t % AT_ONCE + 1) == AT_ONCE or t == each - 1:
            out[starts[:, None] + np.arange(t + 1 - done, t + 1)] = gathered[:done].T
        model.learn(sym, hit1, hit2)
        p1, p2 = sym + 1, p1
    return alphabet[out]
