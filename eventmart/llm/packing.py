"""Hierarchical multi-length packing of documents into token sequences.

Every document is its ids and an end id. What fills whole windows of the longest
tier is cut off at once; the rest is routed to the shortest tier that holds it.
Tiers are packed from the longest down: a window starts with a piece of its own
tier, its gap is filled with the longest pieces of shorter tiers that fit, and
what no piece fits is filled by cutting one. So all windows are full, and their
lengths are powers of two. Windows for which nothing is left to fill them are
joined and cut anew; the tail is carried to the next batch of the partition, and
the partition's last tail is cut by its binary digits. No sequence is padded.

Sequences of a batch are dealt to step groups of about ``step_tokens``, the
longest first and always to the group with the fewest tokens, so that groups
weigh the same and mix tiers.

Partitions are packed where they are read: nothing is shuffled, and a task holds
one Arrow batch and one tail. A hot source or copies make no difference, and a
very long document is cut into many windows.

Defined results: null texts count as empty, and such a document is its end id.
Repeated rows and ids are packed each. An empty table gives no pieces. Other
columns are not looked at. Sequence and step ids begin with the partition's
number, so they depend on how the input is split, but each id of each document
is in exactly one piece in any case.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import text_or_empty, workers_import
from eventmart.llm.tokens import chunk_ids, vocabulary

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
STEP_TOKENS = 64 * 4096

# A piece: (document's number in the batch or a tail's, start, length).
Piece = tuple[int, int, int]


class _Pool:
    """Pieces by length; the longest that fits is found by bit arithmetic."""

    def __init__(self, longest: int):
        self.by_length: list[list[Piece]] = [[] for _ in range(longest + 1)]
        self.lengths = 0

    def add(self, piece: Piece) -> None:
        self.by_length[piece[2]].append(piece)
        self.lengths |= 1 << piece[2]

    def _pop(self, length: int) -> Piece:
        stack = self.by_length[length]
        piece = stack.pop()
        if not stack:
            self.lengths &= ~(1 << length)
        return piece

    def longest_within(self, room: int) -> Piece | None:
        fit = self.lengths & ((1 << (room + 1)) - 1)
        return self._pop(fit.bit_length() - 1) if fit else None

    def shortest_over(self, room: int) -> Piece | None:
        over = self.lengths >> (room + 1)
        return self._pop((over & -over).bit_length() + room) if over else None


def pack(
    pieces: list[Piece], tiers: tuple[int, ...] = TIERS
) -> tuple[list[list[Piece]], list[Piece]]:
    """(full windows, tail): each window's pieces add up to a tier's length; the
    tail is shorter than the longest tier."""
    top = tiers[-1]
    windows: list[list[Piece]] = []
    pool = _Pool(top)
    routed: dict[int, list[Piece]] = {t: [] for t in tiers}
    for doc, start, length in pieces:
        while length >= top:
            windows.append([(doc, start, top)])
            start, length = start + top, length - top
        if length:
            tier = next(t for t in tiers if length <= t)
            routed[tier].append((doc, start, length))
    open_windows: list[list[Piece]] = []

    def filled(window: list[Piece], room: int) -> None:
        while room:
            piece = pool.longest_within(room)
            if piece is None:
                over = pool.shortest_over(room)
                if over is None:
                    open_windows.append(window)
                    return
                doc, start, length = over
                piece = (doc, start, room)
                pool.add((doc, start + room, length - room))
            window.append(piece)
            room -= piece[2]
        windows.append(window)

    for tier in tiers[:-1]:
        for piece in routed[tier]:
            pool.add(piece)
    for piece in routed[top]:
        filled([piece], top - piece[2])
    for i in range(len(tiers) - 2, -1, -1):
        shortest = tiers[i - 1] + 1 if i else 1
        while (piece := pool.longest_within(tiers[i])) is not None:
            if piece[2] < shortest:
                pool.add(piece)
                break
            filled([piece], tiers[i] - piece[2])

    stream = [piece for window in open_windows for piece in window]
    window, room = [], top
    for doc, start, length in stream:
        while length >= room:
            window.append((doc, start, room))
            windows.append(window)
            start, length = start + room, length - room
            window, room = [], top
        if length:
            window.append((doc, start, length))
            room -= length
    return windows, window


def binary_tail(tail: list[Piece]) -> list[list[Piece]]:
    """Cut the last tail into windows whose lengths are powers of two."""
    windows: list[list[Piece]] = []
    left = sum(p[2] for p in tail)
    pieces = list(reversed(tail))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        window = []
        while room:
            doc, start, length = pieces.pop()
            use = min(length, room)
            window.append((doc, start, use))
            room -= use
            if use < length:
                pieces.append((doc, start + use, length - use))
        windows.append(window)
    return windows


def step_groups(lengths: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each sequence, so that groups weigh about the same."""
    import heapq

    groups = max(1, round(sum(lengths) / step_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        weight, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (weight + lengths[i], g))
    return out


def _packer(path: str, end_id: int, tiers: tuple[int, ...], step_tokens: int):
    end = end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_ids(path)
        first = TaskContext.get().partitionId() << 32
        sequences = groups = 0
        id_type = None
        # Documents by number: (id, ids, tokens); those of the tail are kept.
        held: dict[int, tuple] = {}
        number, tail = 0, []

        def rows(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequences, groups
            sizes = [sum(p[2] for p in w) for w in windows]
            dealt = step_groups(sizes, step_tokens)
            out: list[list] = [[] for _ in range(9)]
            for window, size, group in zip(windows, sizes, dealt, strict=True):
                offset = 0
                for doc, start, length in window:
                    doc_id, ids, tokens = held[doc]
                    for column, value in zip(
                        out,
                        (doc_id, start, length, ids[4 * start : 4 * (start + length)], tokens,
                         first + sequences, offset, size, first + groups + group),
                        strict=True,
                    ):
                        column.append(value)
                    offset += length
                sequences += 1
            groups += max(dealt, default=-1) + 1
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            pieces = tail
            coded = encoder.encode_all(batch.column("text").to_pylist())
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                ids = own + end
                held[number] = (doc_id, ids, len(ids) // 4)
                pieces.append((number, 0, len(ids) // 4))
                number += 1
            windows, tail = pack(pieces, tiers)
            yield rows(windows)
            used = {p[0] for p in tail}
            held = {k: v for k, v in held.items() if k in used}
        if tail:
            yield rows(binary_tail(tail))
        encoder.forget()

    return packed


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset, tier (its sequence's length), step_group."""
    workers_import(docs.sparkSession)
    source = docs.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        _packer(vocabulary(tokenizer_path), end_id, tuple(tiers), step_tokens),
        f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, tier int, step_group bigint",
    )
