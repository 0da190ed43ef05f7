"""A context-mixing range coder for token ids; plain numpy, no Spark.

A block is coded on its own: its model starts empty, and its checksums are its
own. The ids of a block lie in lanes, contiguous runs that are coded side by
side, one id of each lane per step. All lanes share one model, brought up to date
after every step, so that a step is a fixed number of array operations however
many lanes there are.

For an id there are three predictions: order 2 (the id last seen after the two
ids before), order 1 (after the one before) and order 0 (counts of all ids).
Orders 2 and 1 have a confidence each, order 0 the share of the candidate among all
ids so far, by powers of 16; the odds that the first candidate is right are mixed
from the three by weights learnt on the way, those of the second candidate come from
its confidence. One coding step says which candidate is right or that none is, and in
that case the id follows by its order-0 counts. All sums are of whole numbers, so
decoding repeats encoding exactly, on any machine.

The range coder is carry-less with 64 bits and gives off 16 bits at a time; each
lane has its own stream.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDCM"
VERSION = 2
HEAD = struct.Struct("<4sHHIIIII")  # magic, version, log2 of order-2 size, ids, lanes, vocabulary, two checksums
LANES, STEPS = 8192, 128
TURN = 64  # lanes that are brought from lanes to steps, or back, at a time
ORDER2_BITS = 18
REFRESH = 8  # steps between two updates of odds and counts
COUNT_STEP = 32
ONE = 4096  # probabilities are out of this
SURE = 8  # kinds of confidence, 0: no prediction yet
SHARES = 4  # kinds of order-0 shares: above 1/16, 1/256, 1/4096 or less
CONTEXTS = SURE * SURE * 2 * SHARES

U = np.uint64
# With 2**34 left of a range, two more words name a point inside of it whatever follows.
TOP, BOTTOM = U(1 << 48), U(1 << 34)
W12, W16, W32, W48, ONE_U = U(12), U(16), U(32), U(48), U(1)

# Odds and back, as whole numbers (256 is one nat).
_SHARES = np.arange(ONE).clip(1, None)
STRETCH = np.rint(256 * np.log(_SHARES / (ONE - _SHARES))).astype(np.int64)
SQUASH = np.rint(ONE / (1 + np.exp(-np.arange(-2048, 2049) / 256))).astype(np.int64).clip(1, ONE - 1)
# The confidence after a hit (first half) or a miss (second half).
NEXT_SURE = np.array([1, 2, 3, 4, 5, 6, 7, 7] + [1, 1, 1, 1, 2, 2, 3, 3], dtype=np.int32)


class DamagedBlock(ValueError):
    """A block's bytes or ids don't match its checksums."""


class _Model:
    """Predictions and odds of one block; an entry is a guess times 8 plus how sure."""

    def __init__(self, vocabulary: int, bits: int):
        self.mask = (1 << bits) - 1
        # Small entries, so that the tables and a step's arrays stay near the processor.
        self.kind = np.int32 if vocabulary <= 1 << 28 else np.int64
        self.order1 = np.zeros(vocabulary, dtype=self.kind)
        self.order2 = np.zeros(1 << bits, dtype=self.kind)
        self.counts = np.ones(vocabulary, dtype=np.int64)
        self.cum = np.arange(vocabulary + 1, dtype=np.int64)
        self.total = U(vocabulary)
        self.new_ids: list[np.ndarray] = []
        self.share = np.full(vocabulary, SHARES - 1, dtype=self.kind)
        self.shared = np.empty(0, dtype=np.int64)  # ids with a share above the least kind
        context = np.arange(CONTEXTS)
        self.of0, context = context % SHARES, context // SHARES
        self.of2, self.of1 = context // (2 * SURE), context % (2 * SURE)
        sure = np.arange(SURE)
        self.p2 = (ONE * sure // 9).clip(16)
        self.p1 = np.tile((ONE * sure // 10).clip(16), 2)
        self.pb = np.tile((ONE * sure // 12).clip(8), 2)
        self.p0 = ONE >> (4 * np.arange(1, SHARES + 1)).clip(None, 10)
        self.of_b = (self.of1 % SURE) + SURE * (self.of2 > 0)
        self.weights = [1 << 15, 1 << 15, 0]
        self.seen = np.zeros(3 * CONTEXTS, dtype=np.int64)
        self._odds()

    def _odds(self) -> None:
        """Shares of the first candidate, the second and neither, per context."""
        self.stretched = STRETCH[self.p2[self.of2]], STRETCH[self.p1[self.of1]], STRETCH[self.p0[self.of0]]
        x = sum(s * w for s, w in zip(self.stretched, self.weights, strict=True)) >> 15
        self.fa = np.minimum(SQUASH[x.clip(-2048, 2047) + 2048], ONE - 2)
        fb = (((ONE - self.fa) * self.pb[self.of_b]) >> 12).clip(1, ONE - 1 - self.fa)
        edges = np.stack((np.zeros_like(fb), self.fa, self.fa + fb, np.full_like(fb, ONE)))
        self.first = edges[:3].ravel().astype(U)
        self.size = np.diff(edges, axis=0).ravel().astype(U)

    def predict(self, before1: np.ndarray, before2: np.ndarray) -> None:
        key = before2 * 0x2545F491 + before1 * 0x1E3779B1
        self.at2, self.at1 = (key ^ (key >> 17)) & self.mask, before1
        self.e2, self.e1 = self.order2[self.at2], self.order1[before1]
        self.a, self.b = self.e2 >> 3, self.e1 >> 3
        self.c2, self.c1 = self.e2 & 7, self.e1 & 7
        context = self.c2 * (2 * SURE)
        context += self.c1
        context += (self.a == self.b).view(np.int8) << 3  # SURE
        context *= SHARES
        context += self.share.take(self.a)
        self.context = context.astype(np.intp)  # an index

    def update(self, ids: np.ndarray, choice: np.ndarray) -> None:
        """``choice``: the context plus ``CONTEXTS`` times 0 if the first candidate was
        right, 1 if the second was, 2 for neither. ``ids`` are of the tables' kind."""
        new = ids << 3
        # Bits rather than ``where``, which is slow where the two cases mix.
        for table, at, entry, sure in (
            (self.order2, self.at2, self.e2, self.c2),
            (self.order1, self.at1, self.e1, self.c1),
        ):
            entry ^= new  # ``sure`` alone after a hit, 8 and more beside it after a miss
            next_sure = NEXT_SURE.take(np.minimum(entry, sure + SURE))
            entry ^= sure
            entry &= (1 - sure) >> 31  # all bits where the guess is kept, which is if sure > 1
            entry ^= new
            entry ^= next_sure
            table[at] = entry
        self.seen += np.bincount(choice, minlength=3 * CONTEXTS)
        self.new_ids.append(ids)
        if len(self.new_ids) == REFRESH:
            self._refresh()

    def _refresh(self) -> None:
        self.counts += COUNT_STEP * np.bincount(np.concatenate(self.new_ids), minlength=len(self.counts))
        np.cumsum(self.counts, out=self.cum[1:])
        total = int(self.cum[-1])
        self.total = U(total)
        self.new_ids = []
        self.share[self.shared] = SHARES - 1
        self.shared = np.flatnonzero(self.counts > total >> 4 * (SHARES - 1))
        counts = self.counts[self.shared]
        self.share[self.shared] = SHARES - 1 - sum((counts > total >> 4 * kind).astype(int) for kind in range(1, SHARES))
        hits_a, hits_b, neither = self.seen.reshape(3, CONTEXTS)
        n = hits_a + hits_b + neither
        error = hits_a * ONE - n * self.fa
        all_ = int(n.sum()) * 64
        for i, stretched in enumerate(self.stretched):
            self.weights[i] = min(max(self.weights[i] + int((error * stretched).sum()) // all_, 0), 1 << 16)
        for table, of, right, tried in (
            (self.p2, self.of2, hits_a, n), (self.p1, self.of1, hits_a, n), (self.p0, self.of0, hits_a, n),
            (self.pb, self.of_b, hits_b, n - hits_a),
        ):
            # Sums of whole numbers below 2**53 are exact in doubles.
            hits, tries = (np.bincount(of, m, len(table)).astype(np.int64) for m in (right, tried))
            table += (hits * ONE - tries * table) // (tries + 256)
            np.clip(table, 4, ONE - 4, out=table)
        self.seen[:] = 0
        self._odds()


def _lane_sizes(n: int, lanes: int) -> tuple[int, int]:
    """Steps, and how many lanes take part in the last one."""
    steps = -(-n // lanes)
    return steps, n - lanes * (steps - 1)


def _by_step(ids: np.ndarray, lanes: int) -> np.ndarray:
    """Ids with a row per step and a column per lane; the first lanes have one id more."""
    steps, last = _lane_sizes(len(ids), lanes)
    found = np.zeros((steps, lanes), dtype=ids.dtype)
    _turn(found[:, :last], ids[: last * steps].reshape(last, steps))
    if last < lanes and steps > 1:
        _turn(found[:-1, last:], ids[last * steps :].reshape(lanes - last, steps - 1))
    return found


def _turn(of_step: np.ndarray, of_lane: np.ndarray) -> None:
    """Fill ``of_step`` from ``of_lane``, its transpose, by parts that a cache can hold."""
    for i in range(0, len(of_lane), TURN):
        of_step[:, i : i + TURN] = of_lane[i : i + TURN].T


def _turn_back(of_step: np.ndarray) -> np.ndarray:
    of_lane = np.empty(of_step.shape[::-1], dtype=of_step.dtype)
    for i in range(0, len(of_lane), TURN):
        of_lane[i : i + TURN] = of_step[:, i : i + TURN].T
    return of_lane.ravel()


def _by_lane(found: np.ndarray, n: int) -> np.ndarray:
    """The ids that ``_by_step`` made ``found`` of."""
    steps, lanes = found.shape
    last = n - lanes * (steps - 1)
    return np.concatenate((_turn_back(found[:, :last]), _turn_back(found[:-1, last:])))


def encode_block(ids: np.ndarray, vocabulary: int, bits: int = ORDER2_BITS) -> bytes:
    """Code ids (each below ``vocabulary``) into one block."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    n = len(ids)
    lanes = max(1, min(LANES, n // STEPS))
    head = (n, lanes, vocabulary, zlib.crc32(ids.tobytes()))
    body = b""
    if n:
        body = _encode(ids, lanes, vocabulary, bits)
    return HEAD.pack(MAGIC, VERSION, bits, *head, zlib.crc32(body)) + body


def _give_off(low: np.ndarray, width: np.ndarray, of: np.ndarray | None) -> np.ndarray:
    """Lanes (among ``of``, or all) whose top 16 bits are settled; a range that has
    become narrow across such a border is cut down to one side of it."""
    own_low, own_width = (low, width) if of is None else (low[of], width[of])
    settled = (own_low ^ (own_low + own_width)) < TOP
    narrow = (own_width < BOTTOM) & ~settled
    if narrow.any():
        at = np.flatnonzero(narrow) if of is None else of[narrow]
        width[at] = (~low[at] + ONE_U) & (BOTTOM - ONE_U)
        settled |= narrow
    return np.flatnonzero(settled) if of is None else of[settled]


def _encode(ids: np.ndarray, lanes: int, vocabulary: int, bits: int) -> bytes:
    steps, last = _lane_sizes(len(ids), lanes)
    model = _Model(vocabulary, bits)
    of_step = _by_step(ids.astype(model.kind, copy=False), lanes)
    all_low, all_width = np.zeros(lanes, dtype=U), np.full(lanes, ~U(0))
    low, width = all_low, all_width
    before1, before2 = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    out_lane, out_word = [], []
    for step in range(steps):
        if step == steps - 1:
            low, width = low[:last], width[:last]
            before1, before2 = before1[:last], before2[:last]
        x = of_step[step, : len(low)]
        model.predict(before1, before2)
        not_a = ~((model.a == x) & (model.c2 > 0))
        neither = not_a & ~((model.b == x) & (model.c1 > 0))
        choice = model.context
        choice += CONTEXTS * (not_a.astype(np.int16) + neither)
        part = width >> W12
        low += part * model.first[choice]
        np.multiply(part, model.size[choice], out=width)
        at = np.flatnonzero(neither)
        if len(at):
            own = x[at].astype(np.int64)
            part = width[at] // model.total
            low[at] += part * model.cum[own].astype(U)
            width[at] = part * model.counts[own].astype(U)
        at = None
        while len(at := _give_off(low, width, at)):
            now = low[at]
            out_lane.append(at)
            out_word.append(now >> W48)
            low[at] = now << W16
            width[at] <<= W16
        model.update(x, choice)
        before2, before1 = before1, x.astype(np.int64)
    point = (all_low >> W32) + ONE_U
    for word in (point >> W16, point & U(0xFFFF)):
        out_lane.append(np.arange(lanes))
        out_word.append(word)
    lane = np.concatenate(out_lane).astype(np.uint16 if lanes <= 1 << 16 else np.uint32)
    word = np.concatenate(out_word).astype("<u2")
    sizes = np.bincount(lane, minlength=lanes).astype("<u4")
    return sizes.tobytes() + word[np.argsort(lane, kind="stable")].tobytes()


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block, as uint32; raises ``DamagedBlock`` if it isn't whole."""
    if len(block) < HEAD.size:
        raise DamagedBlock("the block is shorter than its head")
    magic, version, bits, n, lanes, vocabulary, ids_crc, body_crc = HEAD.unpack_from(block)
    body = block[HEAD.size :]
    if magic != MAGIC or version != VERSION or zlib.crc32(body) != body_crc:
        raise DamagedBlock("the block's head or bytes are damaged")
    ids = _decode(body, n, lanes, vocabulary, bits) if n else np.empty(0, dtype="<u4")
    if zlib.crc32(ids.tobytes()) != ids_crc:
        raise DamagedBlock("the block's ids are damaged")
    return ids


def _decode(body: bytes, n: int, lanes: int, vocabulary: int, bits: int) -> np.ndarray:
    steps, last = _lane_sizes(n, lanes)
    sizes = np.frombuffer(body, dtype="<u4", count=lanes).astype(np.int64)
    # Past its end a lane's reader sees the next lane's words, which change nothing.
    words = np.concatenate((np.frombuffer(body, dtype="<u2", offset=4 * lanes), np.zeros(8, dtype="<u2"))).astype(U)
    place = np.cumsum(sizes) - sizes
    code = np.zeros(lanes, dtype=U)
    for i in range(4):
        code = (code << W16) | words[place + i]
    place += 4
    model = _Model(vocabulary, bits)
    low, width = np.zeros(lanes, dtype=U), np.full(lanes, ~U(0))
    before1, before2 = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    of_step = np.empty((steps, lanes), dtype="<u4")
    place_bits = lanes.bit_length()
    for step in range(steps):
        if step == steps - 1:
            low, width, code, place = low[:last], width[:last], code[:last], place[:last]
            before1, before2 = before1[:last], before2[:last]
        model.predict(before1, before2)
        part = width >> W12
        over = code - low
        not_a = over >= part * model.first[CONTEXTS:].take(model.context)
        neither = over >= part * model.first[2 * CONTEXTS :].take(model.context)
        choice = model.context
        choice += CONTEXTS * (not_a.astype(np.int16) + neither)
        low += part * model.first[choice]
        np.multiply(part, model.size[choice], out=width)
        x = model.a ^ model.b
        x &= not_a.astype(model.kind) - 1  # all bits where the first candidate is right
        x ^= model.b
        at = np.flatnonzero(neither)
        if len(at):
            part = width[at] // model.total
            from_low = low[at]
            value = np.minimum((code[at] - from_low) // part, model.total - ONE_U).astype(np.int64)
            # Neighbours are found faster one after the other: sorted with their places below them.
            value <<= place_bits
            value += np.arange(len(at))
            value.sort()
            own = np.empty_like(value)
            own[value & ((1 << place_bits) - 1)] = np.searchsorted(model.cum, value >> place_bits, side="right") - 1
            x[at] = own
            low[at] = from_low + part * model.cum[own].astype(U)
            width[at] = part * model.counts[own].astype(U)
        at = None
        while len(at := _give_off(low, width, at)):
            low[at] <<= W16
            width[at] <<= W16
            code[at] = (code[at] << W16) | words[place[at]]
            place[at] += 1
        of_step[step, : len(x)] = x
        model.update(x, choice)
        before2, before1 = before1, x.astype(np.int64)
    return _by_lane(of_step, n)
