"""Adaptive context-mixing range coder for blocks of token ids, many independent blocks at a time.

A block predicts its next id three ways: order 2 (the id that followed the last two ids before), order 1 (the id that
followed the last id before) and order 0 (the file's table of id shares). The orders are mixed by how well they did: each
of the first two keeps a confidence (hits in a row, 3 at most) with its prediction, and the pair of confidences selects
adaptive chances of "order 2 is right", "order 1 is right" and "neither". The outcome is range coded with these chances; after
"neither" the id itself is coded by its order-0 share. All of it starts anew in every block, and blocks are coded side by side
as rows of numpy arrays: one step codes one id of each block. The widths (48-bit range, 16-bit digits) are below.

Ranges are whole numbers below 2**53 in double precision, which numpy divides and rounds down several at a time; all of it is exact.
Slots and digits of all blocks stand side by side (slot by slot, digit by digit), since blocks of similar text use the same ones.
"""

from __future__ import annotations

import numpy as np

TOTAL_BITS = 16  # of the order-0 table
EVENT_BITS = 12
RATE = 4
SLOT1, SLOT2 = 9, 10  # bits of the prediction tables
LANES = 4096
MAX_IDS = 1 << TOTAL_BITS
_ONE = 1 << EVENT_BITS
_FLOOR, _DIGIT = float(1 << 32), float(1 << 16)
_YES, _NO = _ONE - 17, 17  # what chances move to
#: The slot of no prediction: a symbol that no table of this width has.
_EMPTY = {np.uint16: (1 << 16) - 4, np.uint32: MAX_IDS << 2}


class Order0:
    """Distinct ids of a file and their shares of 2**16, each at least 1. ``ids`` is sorted; symbols are places in it."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray):
        self.ids, self.shares = ids, shares.astype(np.int64)
        self.starts = np.cumsum(self.shares) - self.shares
        self.symbol = np.repeat(np.arange(len(ids), dtype=np.int64), self.shares)

    @classmethod
    def of(cls, ids: np.ndarray) -> Order0:
        every = np.bincount(ids) if len(ids) else np.zeros(0, dtype=np.int64)
        distinct = np.flatnonzero(every)
        counts = every[distinct]
        if len(distinct) > MAX_IDS:
            raise ValueError("too many distinct ids for one file")
        spare = MAX_IDS - len(distinct)
        shares = 1 + counts * spare // max(1, counts.sum())
        if len(distinct):
            shares[np.argmax(counts)] += MAX_IDS - shares.sum()
        return cls(distinct, shares)


class _Model:
    """Predictions and chances of ``n`` blocks. A slot holds a predicted symbol and, in its two low bits, the confidence; row 0 of
    ``at``, ``sure`` and ``guess`` is order 1, row 1 order 2. Both chances stand in one number, that of order 2 in the high half."""

    def __init__(self, n: int, table: Order0):
        kind = np.uint16 if len(table.ids) < 1 << 14 else np.uint32
        self.n = np.int64(n)
        lane = np.arange(n, dtype=np.int64)
        self.base = np.stack([lane, lane + (n << SLOT1)])
        self.slots = np.full(n * ((1 << SLOT1) + (1 << SLOT2)), _EMPTY[kind], dtype=kind)
        first = np.array([1, _ONE // 4, _ONE // 2, 3 * _ONE // 4], dtype=np.int32)
        self.chances = np.repeat((first[:, None] << 16 | first).reshape(-1), n)  # by (confidence 2, confidence 1)
        self.last = np.zeros(n, dtype=np.uint16)
        self.before = np.zeros(n, dtype=np.uint16)  # multiplied

    def look(self, m: int):
        """Predictions of both orders and the widths of the first two outcomes."""
        hashed = np.empty((2, m), dtype=np.uint16)
        last = self.last[:m] * np.uint16(40503)
        np.bitwise_and(last >> 4, (1 << SLOT1) - 1, out=hashed[0])
        last += self.before[:m]
        np.bitwise_and(last >> 3, (1 << SLOT2) - 1, out=hashed[1])
        self.at = hashed * self.n
        self.at += self.base[:, :m]
        slots = self.slots.take(self.at, mode="wrap")
        self.sure, self.guess = slots & 3, slots >> 2
        self.at_w = (self.sure[1] << 2 | self.sure[0]) * self.n
        self.at_w += self.base[0, :m]
        self.both = self.chances.take(self.at_w, mode="wrap")
        p2, self.p1 = self.both >> 16, self.both & 0xFFFF
        w1 = (_ONE - 2) - p2
        w1 *= self.p1
        w1 >>= EVENT_BITS
        w1 += 1
        return p2, w1

    def learn(self, m: int, sym: np.ndarray, same: np.ndarray) -> None:
        """``same``: where each order predicts ``sym``. A chance p becomes p + ((goal - p) >> RATE), which is (15 p + goal) >> 4 and
        fits in 16 bits; where order 2 is right, the chance of order 1 is its own goal."""
        goals = self.p1
        goals += (_YES - _NO << 16) - _NO
        goals *= same[1]
        goals += (same[0] > same[1]) * np.int32(_YES - _NO)
        goals += _NO << 16 | _NO
        chances = self.both.view(np.uint32) * np.uint32((1 << RATE) - 1)
        chances += goals.view(np.uint32)
        chances >>= RATE
        chances &= _ONE - 1 << 16 | _ONE - 1
        self.chances[self.at_w] = chances.view(np.int32)
        slots = np.minimum(self.sure, 2)
        slots *= same
        slots += (sym.astype(slots.dtype) << 2) + 1
        self.slots[self.at] = slots
        np.multiply(self.last[:m], np.uint16(52429), out=self.before[:m])
        self.last[:m] = sym


def _live(sizes: np.ndarray) -> np.ndarray:
    """Blocks (in falling order of size) longer than t, for every step t."""
    return np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")


def encode_blocks(symbols: np.ndarray, sizes: np.ndarray, table: Order0) -> list[bytes]:
    """The codes of the blocks in the rows of ``symbols`` (blocks, longest); ``sizes`` must not rise."""
    n = len(sizes)
    steps = np.ascontiguousarray(symbols.T, dtype=np.uint16)
    model, low, span = _Model(n, table), np.zeros(n), np.full(n, float(1 << 48))
    digits = np.zeros((2 * len(steps) + 4, n), dtype=np.uint32)
    flat, place = digits.reshape(-1), np.arange(n, dtype=np.int64)
    starts, shares = table.starts.astype(float), table.shares.astype(float)
    for t, m in enumerate(_live(sizes)):
        sym, lo, at = steps[t, :m], low[:m], place[:m]
        w2, w1 = model.look(m)
        same = model.guess == sym
        not2 = ~same[1]
        r = np.floor(span[:m] * 2.0**-EVENT_BITS)
        own, next_ = r * w2, r * w1
        o = np.flatnonzero(not2 > same[0])
        s = sym.take(o)
        begin = (own + next_).take(o)
        width = np.floor((r.take(o) * _ONE - begin) * 2.0**-TOTAL_BITS)
        begin += width * starts.take(s)
        width *= shares.take(s)
        move = own * not2
        move[o] = begin
        lo += move
        next_ -= own
        next_ *= not2
        own += next_  # the width of order 1 where order 2 is wrong
        own[o] = width
        due = own < _FLOOR
        digit = np.floor(lo * 2.0**-32)
        flat[at] = digit  # the next one takes its place where none is due
        at += due * model.n
        digit *= due
        digit *= _FLOOR
        lo -= digit
        scale = due * (_DIGIT - 1)
        scale += 1
        lo *= scale
        own *= scale
        z = np.flatnonzero(own < _FLOOR)  # a second digit; a range never needs a third
        if len(z):
            digit = np.floor(lo[z] * 2.0**-32)
            flat[at[z]] = digit
            at[z] += n
            lo[z] = (lo[z] - digit * _FLOOR) * _DIGIT
            own[z] *= _DIGIT
        span[:m] = own
        model.learn(m, sym, same)
    flat[place] = np.floor((low + (_FLOOR - 1)) * 2.0**-32)  # one digit tells the rest of the range apart
    ends = place // max(1, n) + 1
    digits = digits[: ends.max(initial=0)]
    for i in range(len(digits) - 1, 0, -1):
        digits[i - 1] += digits[i] >> 16  # carry
    whole = digits.T.astype(">u2", order="C")
    return [whole[i, :e].tobytes() for i, e in enumerate(ends.tolist())]


def decode_blocks(codes: list[bytes], sizes: np.ndarray, table: Order0) -> np.ndarray:
    """The symbols (blocks, longest) of the codes; ``sizes`` must not rise. Of a damaged code, any numbers."""
    n = len(sizes)
    longest = int(sizes[0]) if n else 0
    lengths = np.array([len(c) // 2 for c in codes], dtype=np.int64)
    # Zeros follow every code: the decoder reads up to three digits ahead.
    row = np.cumsum(lengths + 8) - (lengths + 8)
    flat = np.frombuffer(b"".join(c[: len(c) // 2 * 2] + b"\0" * 16 for c in codes), dtype=">u2").astype(np.uint16)
    model, span = _Model(n, table), np.full(n, float(1 << 48))
    code = flat[row] * _FLOOR + flat[row + 1] * _DIGIT + flat[row + 2] if n else np.zeros(0)
    place = row + 3
    starts, shares, symbol = table.starts.astype(float), table.shares.astype(float), table.symbol.astype(np.uint16)
    out = np.zeros((longest, n), dtype=np.uint16)
    for t, m in enumerate(_live(sizes)):
        now, at = code[:m], place[:m]
        w2, w1 = model.look(m)
        r = np.floor(span[:m] * 2.0**-EVENT_BITS)
        own, next_ = r * w2, r * w1
        is2 = now < own
        not2 = ~is2
        both = own + next_
        o = np.flatnonzero(now >= both)
        begin = both.take(o)
        width = np.floor((r.take(o) * _ONE - begin) * 2.0**-TOTAL_BITS)
        rest = now.take(o) - begin
        s = symbol.take((rest / width).astype(np.int32), mode="clip")
        rest -= width * starts.take(s)
        width *= shares.take(s)
        now -= own * not2
        now[o] = np.minimum(rest, width - 1)  # less only in a damaged code
        next_ -= own
        next_ *= not2
        own += next_
        own[o] = width
        sym = model.guess[1] - model.guess[0]
        sym *= is2
        sym += model.guess[0]
        sym[o] = s
        sym = sym.astype(np.uint16, copy=False)
        due = own < _FLOOR
        scale = due * (_DIGIT - 1)
        scale += 1
        own *= scale
        now *= scale
        now += flat.take(at, mode="clip") * due
        at += due
        z = np.flatnonzero(own < _FLOOR)
        if len(z):
            now[z] = now[z] * _DIGIT + flat.take(at[z], mode="clip")
            at[z] += 1
            own[z] *= _DIGIT
        span[:m] = own
        out[t, :m] = sym
        model.learn(m, sym, model.guess == sym)
    return out.T
