"""Adaptive context-mixing range coder for token ids, many blocks at a time.

Ids are replaced by their rank in a frequency list, cut into blocks of
``BLOCK`` ids, and every block is coded with a model that starts empty, so any
block can be decoded alone. Numpy advances all blocks of a group in step.

For each id the model asks three predictors:

* order 2: the id that last followed the previous two ids here,
* order 1: the id that last followed the previous id here,
* order 0: how often each magnitude of rank has come up in this block.

"As order 2 says", "as order 1 says" or "neither" has frequencies that mix two
adaptive tables: one for how sure the two predictors have been in this place,
one for the block as a whole. "Neither" goes on with the magnitude of the rank
by order 0. Both are one step of the range coder, which divides by the product
of their totals; the lower digits of the rank follow evenly. The range coder
is carry-less with 64-bit state and 32-bit words.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

BLOCK = 4096
_HASH_BITS = 10
_GAIN = 24
_HALVE_EVERY = 128
_TURNED = 64  # steps that are laid out together, so that both layouts stay near
_WORD = np.uint64(32)
_LOW_WORD = np.uint64(0xFFFFFFFF)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# the three counts of a choice share 60 bits, that of order 2 lowest
_FIELD = 20
_ONES = np.uint64(1 | 1 << _FIELD | 1 << 2 * _FIELD)
_COUNT = np.uint64((1 << _FIELD) - 1)
_NEVER = np.uint16(65535)
_NONE = np.zeros(0, np.int64)
_SHIFTS = np.array([2 * _FIELD, _FIELD, 0], np.uint64)
_HALVES = np.uint64(((1 << _FIELD - 1) - 1) * int(_ONES))


class Group(NamedTuple):
    """Blocks that were coded together; ``table`` has ids, words and CRC of each."""

    ranks: bytes   # the id of each rank, unsigned 32-bit, most frequent first
    table: bytes   # unsigned 32-bit triples
    words: bytes   # the blocks' words one after another


class _Model:
    """What all blocks of a group know after the same number of ids.

    The slots of a block are together in every table. Types are converted in
    steps of their own, since numpy is slow at mixing them.
    """

    def __init__(self, lanes: int, known: int) -> None:
        self.known = int(_magnitude(np.array([max(1, known)]))[0]) + 1  # magnitudes
        self.slots = (np.arange(2 * lanes, dtype=np.uint64) << np.uint64(_HASH_BITS)
                      ).reshape(2, lanes)  # of orders 1, 2
        # a rank and, in its two lowest bits, how sure it is; narrow where ranks allow, since
        # most steps wait for this table
        self.entry = np.uint16 if known <= 1 << 14 else np.uint32
        self.follows = np.zeros(2 * lanes << _HASH_BITS, self.entry)
        self.whole = np.full(lanes, _ONES)
        self.placed = np.full(lanes << 4, _ONES)
        # counts of all smaller magnitudes, from none to all; a row is of whole 64-bit words
        places = np.arange(-(-(self.known + 1) // 8) * 8)
        self.floor = np.where(places <= self.known, places, 0).astype(np.uint16)
        self.upto = np.tile(self.floor, (lanes, 1))
        self.upto[:, self.known + 1:] = _NEVER
        # what a magnitude adds to them; the last row is for none
        self.grown = np.zeros((self.known + 1, len(places)), np.uint16)
        self.grown[:-1] = np.uint16(_GAIN) * (self.floor > places[:self.known, None])
        # products of the last id and of the one before it, for the hashes
        self.last1 = np.zeros(lanes, np.uint64)
        self.last2 = np.zeros(lanes, np.uint64)
        self.places()

    def places(self) -> None:
        lane = np.arange(len(self.whole))
        self.contexts, self.rows = lane << 4, lane * len(self.floor)
        self.hashes = np.empty((2, len(lane)), np.uint64)
        self.at = self.hashes.view(np.int64)

    def shrink(self) -> None:
        """The last block has ended."""
        self.slots = np.ascontiguousarray(self.slots[:, :-1])
        self.upto = self.upto[:-1]
        self.whole, self.last1, self.last2 = self.whole[:-1], self.last1[:-1], self.last2[:-1]
        self.places()

    def ask(self) -> np.ndarray:
        """The predictions of orders 1 and 2; sets the running counts of the choice."""
        two, three = self.entry(2), self.entry(3)
        self.hashes[0] = self.last1
        np.add(self.last1, self.last2, out=self.hashes[1])
        self.hashes >>= np.uint64(64 - _HASH_BITS)
        self.hashes += self.slots
        entry = self.follows.take(self.at)
        self.sure = entry & three
        self.context = ((self.sure[1] << two) + self.sure[0]).astype(np.int64)
        self.context += self.contexts
        self.counts = self.placed.take(self.context)
        self.choice = self.counts << np.uint64(2)
        self.choice += self.whole
        self.choice *= _ONES  # running counts
        self.all_bits = self.upto[:, self.known].astype(np.uint64)
        self.total = self.choice >> np.uint64(2 * _FIELD)
        self.total &= _COUNT
        self.total *= self.all_bits
        entry >>= two
        return entry

    def choose(self, hit: np.ndarray) -> None:
        """``hit``: 2 where order 2 was right, 1 where only order 1 was, else 0."""
        self.hit = hit
        self.plain = (hit == 0).view(np.uint8)
        self.shift = _SHIFTS.take(hit)
        self.before = self.choice << np.uint64(_FIELD)
        self.before >>= self.shift
        self.before &= _COUNT
        self.own = self.choice >> self.shift
        self.own &= _COUNT
        self.own -= self.before
        self.base = self.before * self.all_bits

    def part(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of what was chosen, out of ``total``.

        ``bits`` are the magnitudes; a block that coded a prediction takes all of them.
        """
        digits = bits * self.plain
        width = np.uint8(self.known) - self.plain * np.uint8(self.known - 1)
        at = digits.astype(np.int64)
        at += self.rows
        start = self.upto.take(at)
        at += width
        own = (self.upto.take(at) - start).astype(np.uint64)
        own *= self.own
        start = start.astype(np.uint64)
        start *= self.own
        start += self.base
        self.digits = digits.astype(np.uint64)
        return start, own

    def found(self, value: np.ndarray) -> np.ndarray:
        """The magnitude that each value falls into."""
        passed = np.bitwise_count((self.upto <= value[:, None]).view(np.uint64))
        bits = passed[:, 0] - np.uint8(1)
        for k in range(1, passed.shape[1]):
            bits += passed[:, k]
        return bits

    def learn(self, right: np.ndarray, bits: np.ndarray, rank: np.ndarray, step: int) -> None:
        """``right`` tells for each order whether it was."""
        gain = np.uint64(_GAIN) << self.shift
        self.whole += gain
        gain += self.counts
        self.placed[self.context] = gain
        none = np.uint8(self.known)
        self.upto += self.grown.take((bits - none) * self.plain + none, axis=0)
        sure = np.minimum(self.sure + self.entry(1), self.entry(3))
        sure *= right
        sure += (rank << np.uint32(2)).astype(self.entry)
        self.follows[self.at] = sure
        wide = rank.astype(np.uint64)
        self.last2 = self.last1 * _K2
        self.last1 = wide * _K1
        if step % _HALVE_EVERY == _HALVE_EVERY - 1:
            for counts in (self.whole, self.placed):
                counts += _ONES
                counts >>= np.uint64(1)
                counts &= _HALVES
            self.upto += self.floor
            self.upto >>= np.uint16(1)
            self.upto[:, self.known + 1:] = _NEVER


class _Span:
    """The range coder's interval for each block."""

    def __init__(self, lanes: int, model: _Model) -> None:
        self.low = np.zeros(lanes, np.uint64)
        self.span = np.full(lanes, ~np.uint64(0))
        # what the digits of any rank need, and some more so that they come out even
        self.narrow = np.uint64(min(int(_LOW_WORD), (16 << model.known) - 1))

    def due(self, limit: np.uint64) -> np.ndarray:
        """Blocks with a span up to the limit, a word at most, give off a word;
        the larger part of a span across a word border is kept."""
        if limit < _LOW_WORD and np.minimum.reduce(self.span) > limit:  # nearly always
            return _NONE
        due = (self.span <= limit).nonzero()[0]
        if len(due):
            low, span = self.low.take(due), self.span.take(due)
            left = (np.uint64(1) << _WORD) - (low & _LOW_WORD)
            over = (span > left).nonzero()[0]
            if len(over):
                left = left[over]
                right = span[over] - left
                low[over] += left * (right > left)
                span[over] = np.maximum(left, right)
            self.span[due] = span << _WORD
            self.low[due] = low << _WORD
            self.gone = low >> _WORD
        return due


def _magnitude(values: np.ndarray) -> np.ndarray:
    """Position of the highest set bit of each value above 0."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64) - 1


class _Words:
    """Words that blocks give off."""

    def __init__(self, lanes: int) -> None:
        self.words = np.zeros((lanes, BLOCK // 2), np.uint32)
        self.filled = np.zeros(lanes, np.int64)

    def room(self, more: int) -> None:
        """Room for so many words in each block."""
        if int(self.filled.max()) + more > self.words.shape[1]:
            wider = np.zeros((len(self.words), max(more, BLOCK // 2)), np.uint32)
            self.words = np.concatenate([self.words, wider], axis=1)
        self.flat, self.width = self.words.reshape(-1), self.words.shape[1]

    def put(self, due: np.ndarray, words: np.ndarray) -> None:
        at = self.filled.take(due)
        self.flat[due * self.width + at] = words
        at += 1
        self.filled[due] = at


def encode(ids: np.ndarray) -> Group:
    ids = np.ascontiguousarray(ids, np.uint32)
    if not len(ids):
        return Group(b"", b"", b"")
    by_rank, known = _ranked(ids)
    lanes = -(-len(ids) // BLOCK)
    tail = len(ids) - (lanes - 1) * BLOCK
    checks = _checks(ids, lanes)
    del ids
    ranks = np.zeros((BLOCK, lanes), known.dtype)  # a row for each step
    for k in range(0, BLOCK, _TURNED):
        ranks[k:k + _TURNED, :-1] = known[:-tail].reshape(lanes - 1, BLOCK)[:, k:k + _TURNED].T
    ranks[:tail, -1] = known[-tail:]
    del known
    magnitude_of = _magnitude(np.arange(1, len(by_rank) + 1, dtype=np.uint32)).astype(np.uint8)
    model = _Model(lanes, len(by_rank))
    coder, out = _Span(lanes, model), _Words(lanes)

    def settle(limit: np.uint64) -> None:
        due = coder.due(limit)
        if len(due):
            out.put(due, coder.gone)

    for step in range(BLOCK if lanes > 1 else tail):
        if step == tail:
            last = coder.low[-1:]
            model.shrink()
            coder.low, coder.span = coder.low[:-1], coder.span[:-1]
        if step % _HALVE_EVERY == 0:
            out.room(2 * _HALVE_EVERY)  # a block gives off two words in a step at most
        rank = ranks[step, :len(coder.low)].astype(np.uint32)
        pred = model.ask()
        right = (pred == rank).view(np.uint8)
        model.choose(np.maximum(right[0], right[1] << 1))
        bits = magnitude_of.take(rank)
        start, own = model.part(bits)
        unit = coder.span // model.total
        start *= unit
        coder.low += start
        np.multiply(unit, own, out=coder.span)
        settle(coder.narrow)
        rest = (rank + np.uint32(1)).astype(np.uint64)
        rest ^= np.uint64(1) << model.digits
        rest *= model.plain.astype(np.uint64)
        coder.span >>= model.digits
        rest *= coder.span
        coder.low += rest
        settle(_LOW_WORD)
        model.learn(right, bits, rank, step)
    out.room(2)
    low = coder.low if len(coder.low) == lanes else np.concatenate([coder.low, last])
    lane = np.arange(lanes)
    out.put(lane, low >> _WORD)
    out.put(lane, low & _LOW_WORD)
    table = np.empty((lanes, 3), np.uint32)
    table[:, 0] = BLOCK
    table[-1, 0] = tail
    table[:, 1] = out.filled
    table[:, 2] = checks
    body = out.words[np.arange(out.words.shape[1]) < out.filled[:, None]]
    return Group(by_rank.astype("<u4").tobytes(), table.astype("<u4").tobytes(),
                 body.astype("<u4").tobytes())


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids by falling frequency, and the place of each id of the text in that list."""
    if int(ids.max()) < max(1 << 17, len(ids)):
        counts = np.zeros(int(ids.max()) + 1, np.int64)
        for k in range(0, len(ids), 1 << 18):  # numpy makes long ones of each piece first
            counts += np.bincount(ids[k:k + (1 << 18)], minlength=len(counts))
        known = np.flatnonzero(counts)
        inverse, counts = ids, counts[known]
        rank_of = np.empty(int(ids.max()) + 1, _narrow(len(known)))
    else:
        known, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        rank_of = np.empty(len(known), _narrow(len(known)))
    order = np.lexsort((known, -counts))
    rank_of[known[order] if inverse is ids else order] = np.arange(len(known))
    return known[order], _looked_up(rank_of, inverse)


def _narrow(known: int) -> type:
    """What holds so many ranks."""
    return np.uint16 if known <= 1 << 16 else np.uint32


def _looked_up(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``table[at]`` piece by piece: numpy makes long indices of each piece first."""
    out = np.empty(len(at), table.dtype)
    for k in range(0, len(at), 1 << 16):
        out[k:k + (1 << 16)] = table.take(at[k:k + (1 << 16)])
    return out


def _checks(ids: np.ndarray, lanes: int) -> list[int]:
    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
    return [zlib.crc32(raw[4 * BLOCK * k:4 * BLOCK * (k + 1)]) for k in range(lanes)]


def decode(group: Group, only: slice = slice(None)) -> np.ndarray:
    """The ids again, or those of the blocks that ``only`` selects.

    Raises ``ValueError`` where a block's checksum doesn't hold.
    """
    known = np.frombuffer(group.ranks, "<u4")
    table = np.frombuffer(group.table, "<u4").reshape(-1, 3).astype(np.int64)
    begin = (np.cumsum(table[:, 1]) - table[:, 1])[only]
    table = table[only]
    lanes = len(table)
    if not lanes:
        return np.zeros(0, np.uint32)
    tail = int(table[-1, 0])
    body = np.concatenate([np.frombuffer(group.words, "<u4"), np.zeros(4, np.uint32)])
    model = _Model(lanes, len(known))
    coder = _Span(lanes, model)
    code = (body[begin].astype(np.uint64) << _WORD) | body[begin + 1]
    at, last = begin + 2, len(body) - 1
    ranks = np.zeros((BLOCK, lanes), _narrow(len(known)))

    def settle(limit: np.uint64) -> None:
        due = coder.due(limit)
        if len(due):
            place = at.take(due)
            code[due] = (code.take(due) << _WORD) | body.take(np.minimum(place, last))
            at[due] = place + 1

    for step in range(BLOCK if lanes > 1 else tail):
        if step == tail:
            model.shrink()
            coder.low, coder.span, code = coder.low[:-1], coder.span[:-1], code[:-1]
        pred = model.ask()
        unit = coder.span // model.total
        value = (code - coder.low) // unit
        np.minimum(value, model.total - np.uint64(1), out=value)
        hit = (value < (model.choice & _COUNT) * model.all_bits).view(np.uint8)
        hit = hit + (value < ((model.choice >> np.uint64(_FIELD)) & _COUNT)
                     * model.all_bits).view(np.uint8)
        model.choose(hit)
        value -= model.base
        value //= model.own
        bits = model.found(value.astype(np.uint16))
        start, own = model.part(bits)
        start *= unit
        coder.low += start
        np.multiply(unit, own, out=coder.span)
        settle(coder.narrow)
        coder.span >>= model.digits
        rest = (code - coder.low) // coder.span
        rest *= model.plain.astype(np.uint64)
        coder.low += coder.span * rest
        settle(_LOW_WORD)
        rest += np.uint64(1) << model.digits
        rest -= np.uint64(1)  # 0 after a prediction
        rank = rest.astype(np.uint32)
        np.copyto(rank, pred[0], where=hit == 1)
        np.copyto(rank, pred[1], where=hit == 2)
        ranks[step, :len(rank)] = rank
        model.learn((pred == rank).view(np.uint8), bits, rank, step)
    flat = np.empty((lanes, BLOCK), ranks.dtype)
    for k in range(0, BLOCK, _TURNED):
        flat[:, k:k + _TURNED] = ranks[k:k + _TURNED].T
    del ranks
    flat = flat.reshape(-1)[:(lanes - 1) * BLOCK + tail]
    if int(flat.max()) >= len(known):
        raise ValueError("a block of token ids is damaged")
    ids = _looked_up(known.astype(np.uint32, copy=False), flat)
    if _checks(ids, lanes) != table[:, 2].tolist():
        raise ValueError("a block of token ids is damaged")
    return ids
