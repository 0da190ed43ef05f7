"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes when a string of ``min_length`` bytes that covers it also starts in a
document with a smaller id; of every repeated string the first document keeps its
bytes. Matches never cross documents.

*Classes.* Equal texts are one class, held by its least id; the classes lie in a
table bucketed by ``piece_group``, so that the three passes below read their texts
without moving them again. Texts with more than ``COMMON`` copies (and more than one
row in ``HOT_TEXTS``, so their digests, which are broadcast, are at most that many)
collapse in the tasks that read them.

*Candidates.* A window of ``min_length`` bytes is named by the least hash among its
``GRAM``-byte strings, and neighbouring windows of one name are a run. Equal windows
have equal names wherever they lie, so only runs whose name occurs in two classes can
repeat. Each group sends the names it has, 5 bytes a name, once each, and gets back
those other groups have as well.

*Suffix order.* Runs with shared names are sent to the task that owns the name, equal
ones once per group, held by the least id. There the suffixes of the distinct runs are
put into order by their first ``min_length`` bytes. For each suffix the nearest ones
before and after it in that order that belong to a smaller id (previous and next
smaller position) have the longest earlier match; its length is the longest previous
factor. It reaches ``min_length`` just where a smaller id lies in the same stretch of
common prefixes, which prefix and suffix minima over the stretch tell.

*Hot names.* A name that ``HOT_GROUPS`` groups have is split: its windows travel one by
one under the hash of their own bytes, each once per group, so one common phrase
with many continuations is spread over all tasks.

Defined results: null texts are empty; texts shorter than ``min_length`` stay whole; a
copy of an earlier text goes whole. Rows that share an id don't remove from one
another. Null ids rank last, together with the greatest long. Ids are integers. An
empty table gives no rows. The input's columns come back unchanged beside one new
column, which takes a free name where ``repeats`` is taken.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import free_name, stored, text_or_empty, workers_import
from eventmart.session import work_dir
from eventmart.sources.files import delete

MIN_LENGTH = 50
GRAM = 20
GROUP_BYTES = 8 << 20
HOT_GROUPS = 2000
COMMON, HOT_TEXTS = 1000, 100_000
STEP = 1 << 15
LONGEST_RUN = 4096
LOW = np.uint64((1 << 40) - 1)
LAST_ID = (1 << 63) - 1

PACKET = "part int, piece_group int, kind int, idx binary, name binary, owner binary, size binary, data binary"
REPEATS = "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"


# ---------------------------------------------------------------- windows


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed polynomial hash of every ``gram`` bytes, by doubling."""
    base, whole = 0x100000001B3, 1 << 64
    power = lambda e: np.uint64(pow(base, e, whole))
    square, width = data.astype(np.uint64) + np.uint64(1), 1
    out, have, left = None, 0, gram
    while left:
        if left & 1:
            if out is None:
                out = square
            else:
                n = len(square) - have
                out = out[:n] * power(width) + square[have:]
            have += width
        left >>= 1
        if left:
            square = square[:-width] * power(width) + square[width:]
            width *= 2
    out = out[: len(data) - gram + 1]
    out = out ^ (out >> np.uint64(29))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: len(values) - (width - done)], values[width - done :])
    return values


def window_runs(data: np.ndarray, offsets: np.ndarray, min_length: int, parts: int):
    """Runs of windows with one name: (name, document, first window, windows).

    ``offsets`` has the start of each document and the end of the last. The name's
    upper bits are the part that owns it, the lower 40 the rest of the hash.
    """
    gram = min(GRAM, min_length)
    last = len(data) - min_length + 1
    names, places = [], []
    for begin in range(0, max(last, 0), STEP):
        end = min(begin + STEP, last)
        least = _least(_gram_hashes(data[begin : end + min_length - 1], gram), min_length - gram + 1)
        cut = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        a, b = np.searchsorted(offsets, [begin, end])
        edges = np.concatenate((offsets[a:b], offsets[1:] - min_length + 1)) if b > a else offsets[1:] - min_length + 1
        edges = edges[(edges >= begin) & (edges < end)] - begin
        if len(edges):
            cut = np.union1d(cut, edges)
        names.append(least[cut])
        places.append(cut + begin)
    if not names:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    name, place = np.concatenate(names), np.concatenate(places)
    count = np.diff(np.append(place, last))
    doc = np.searchsorted(offsets, place, "right") - 1
    inside = place + min_length <= offsets[doc + 1]
    name, place, count, doc = name[inside], place[inside], count[inside], doc[inside]
    name = (((name >> np.uint64(40)) % np.uint64(parts)) << np.uint64(40)) | (name & LOW)
    if len(count) and count.max() > LONGEST_RUN:
        pieces = -(-count // LONGEST_RUN)
        which = np.repeat(np.arange(len(count)), pieces)
        within = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        place = place[which] + within * LONGEST_RUN
        count = np.minimum(count[which] - within * LONGEST_RUN, LONGEST_RUN)
        name, doc = name[which], doc[which]
    return name, doc, place - offsets[doc], count


# ---------------------------------------------------------------- packing


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """``values`` cut at ``edges`` as a binary column, without a loop."""
    width = values.dtype.itemsize
    ends = (edges * width).astype(np.int64)
    buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, buffers).cast(pa.binary())


def _values(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in one array, and the number in each row."""
    column = column.cast(pa.large_binary())
    flat, sizes = [], []
    for chunk in column.chunks:
        ends = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        if len(chunk):
            body = chunk.buffers()[2]
            flat.append(np.frombuffer(body, np.uint8)[ends[0] : ends[-1]] if body else np.zeros(0, np.uint8))
            sizes.append(np.diff(ends))
    if not flat:
        return np.zeros(0, kind), np.zeros(0, np.int64)
    return np.concatenate(flat).view(kind), np.concatenate(sizes) // np.dtype(kind).itemsize


def _five_bytes(names: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).view("V5").ravel()


def _from_five(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw.view(np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _texts(table: pa.Table):
    """A group's classes in order of digest: digests, ids, bytes, offsets."""
    table = table.sort_by("digest")
    data, sizes = _values(table["data"], np.uint8)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return table["digest"], table["owner"].to_numpy(), data, offsets


# ---------------------------------------------------------------- tasks


def _names_of_group(min_length: int, parts: int):
    def names(table: pa.Table) -> pa.Table:
        _, _, data, offsets = _texts(table)
        found = np.unique(window_runs(data, offsets, min_length, parts)[0])
        part = (found >> np.uint64(40)).astype(np.int64)
        have, first = np.unique(part, return_index=True)
        edges = np.append(first, len(part))
        group = table["piece_group"][0].as_py()
        return pa.table(
            {
                "part": pa.array(have, pa.int32()),
                "piece_group": pa.array(np.full(len(have), group), pa.int32()),
                "names": _binary(_five_bytes(found & LOW), edges),
            }
        )

    return names


def _shared_names(hot_groups: int):
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("piece_group", pa.int32()), ("names", pa.binary()), ("hot", pa.binary())])
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        raw, sizes = _values(table["names"], "V5")
        group = np.repeat(table["piece_group"].to_numpy(), sizes)
        name = (np.repeat(table["part"].to_numpy().astype(np.uint64), sizes) << np.uint64(40)) | _from_five(raw)
        order = np.argsort(name, kind="stable")
        name, group = name[order], group[order]
        start = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        times = np.repeat(np.diff(np.append(start, len(name))), np.diff(np.append(start, len(name))))
        many = times > 1
        name, group, times = name[many], group[many], times[many]
        order = np.argsort(group, kind="stable")
        name, group, hot = name[order], group[order], (times[order] >= hot_groups).astype(np.uint8)
        have, first = np.unique(group, return_index=True)
        edges = np.append(first, len(group))
        for i in range(len(have)):
            a, b = edges[i], edges[i + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([have[i]], pa.int32()), pa.array([name[a:b].tobytes()]), pa.array([hot[a:b].tobytes()])],
                schema=schema,
            )

    return shared


def _packets(group: int, part: np.ndarray, kind: int, columns: list[np.ndarray], pieces: list[bytes]) -> pa.Table:
    """Rows of ``PACKET``, one per part, from columns already in order of part."""
    have, first = np.unique(part, return_index=True)
    edges = np.append(first, len(part))
    squeeze = zstandard.ZstdCompressor(level=1).compress
    bodies = [squeeze(b"".join(pieces[a:b])) for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
    return pa.table(
        {
            "part": pa.array(have, pa.int32()),
            "piece_group": pa.array(np.full(len(have), group), pa.int32()),
            "kind": pa.array(np.full(len(have), kind), pa.int32()),
            **{n: _binary(c, edges) for n, c in zip(("idx", "name", "owner", "size"), columns, strict=True)},
            "data": pa.array(bodies, pa.binary()),
        }
    )


def _candidate_runs(min_length: int, parts: int):
    """Runs with shared names: each distinct one once (kind 0) and where they lie (kind 1)."""

    def candidates(classes: pa.Table, hints: pa.Table) -> pa.Table:
        _, owner, data, offsets = _texts(classes)
        group = classes["piece_group"][0].as_py()
        name, doc, first, count = window_runs(data, offsets, min_length, parts)
        known, _ = _values(hints["names"], np.uint64)
        hot, _ = _values(hints["hot"], np.uint8)
        order = np.argsort(known)
        known, hot = known[order], hot[order].astype(bool)
        pairs = np.lexsort((doc, name))
        n, d = name[pairs], doc[pairs]
        both = np.flatnonzero((n[1:] == n[:-1]) & (d[1:] != d[:-1]))
        shared = np.isin(name, known) | np.isin(name, np.unique(n[both]))
        name, doc, first, count = name[shared], doc[shared], first[shared], count[shared]
        split = np.isin(name, known[hot])
        if split.any():  # hot names: every window by itself
            which = np.repeat(np.arange(len(name)), np.where(split, count, 1))
            runs = np.where(split, count, 1)
            within = np.arange(len(which)) - np.repeat(np.cumsum(runs) - runs, runs)
            first = first[which] + within
            split = split[which]
            count = np.where(split, 1, count[which])
            name, doc = name[which], doc[which]
        order = np.lexsort((first, doc, owner[doc])) if len(doc) else np.zeros(0, np.int64)
        name, doc, first, count, split = name[order], doc[order], first[order], count[order], split[order]
        begin = offsets[doc] + first
        end = begin + count + min_length - 1
        body = data.tobytes()
        seen: dict[tuple[int, bytes], int] = {}
        leaders: list[int] = []
        which = np.empty(len(name), np.int32)
        for i, (a, b, key, one) in enumerate(zip(begin.tolist(), end.tolist(), name.tolist(), split.tolist(), strict=True)):
            piece = body[a:b]
            if one:
                own = xxhash.xxh3_64_intdigest(piece)
                key = (own >> 40) % parts << 40 | own & (1 << 40) - 1
            k = seen.setdefault((key, piece), len(leaders))
            if k == len(leaders):
                leaders.append(i)
            which[i] = k
        keys = np.fromiter((k for k, _ in seen), np.uint64, len(seen))
        pieces = [p for _, p in seen]
        part = (keys >> np.uint64(40)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        lead = owner[doc[leaders]].astype(np.int64) if leaders else np.zeros(0, np.int64)
        size = np.fromiter(map(len, pieces), np.int32, len(pieces))
        sent = _packets(
            group, part[order], 0,
            [order.astype(np.int32), keys[order], lead[order], size[order]],
            [pieces[i] for i in order.tolist()],
        )
        later = (owner[doc] > lead[which]).astype(np.int32) if len(doc) else np.zeros(0, np.int32)
        state = np.stack([doc.astype(np.int32), first.astype(np.int32), count.astype(np.int32), later], 1).ravel()
        one = np.array([0, 1], np.int64)
        kept = pa.table(
            {
                "part": pa.array([group % parts], pa.int32()),
                "piece_group": pa.array([group], pa.int32()),
                "kind": pa.array([1], pa.int32()),
                "idx": _binary(which, one * len(which)),
                "name": pa.array([b""], pa.binary()),
                "owner": pa.array([b""], pa.binary()),
                "size": pa.array([b""], pa.binary()),
                "data": _binary(state, one * len(state)),
            }
        )
        return pa.concat_tables([sent, kept])

    return candidates


def previous_factors(windows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which windows (rows of equal length) also belong to a smaller owner.

    Suffixes are sorted by their bytes; ``common`` marks neighbours whose common
    prefix is a whole window. The least owner before a suffix in its stretch tells
    whether a previous smaller position has that prefix, the least after it
    whether a next smaller one has.
    """
    length = windows.shape[1]
    text = np.ascontiguousarray(windows).view(f"S{length}").ravel()
    order = np.argsort(text, kind="stable")
    sorted_windows, rank = windows[order], owner[order]
    common = (sorted_windows[1:] == sorted_windows[:-1]).all(axis=1)
    stretch = np.concatenate(([0], np.cumsum(~common)))
    _, dense = np.unique(rank, return_inverse=True)
    wide = int(dense.max()) + 1
    # Minima within stretches: each stretch lies wholly below (above) the one before it.
    before = np.minimum.accumulate(dense - stretch * wide) + stretch * wide
    back = stretch[-1] - stretch
    after = (np.minimum.accumulate((dense - back * wide)[::-1]) + (back * wide)[::-1])[::-1]
    repeated = (before < dense) | (after < dense)
    out = np.empty(len(order), bool)
    out[order] = repeated
    return out


def _factor_task(min_length: int, most: int = 1 << 18):
    """Answers (kind 2) for the runs of the names a task owns; kind 1 passes through."""

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = batch.column("kind").to_numpy()
            if (kinds == 1).any():
                yield batch.filter(pa.array(kinds == 1))
            if (kinds == 0).any():
                held.append(batch.filter(pa.array(kinds == 0)))
        if not held:
            return
        table = pa.Table.from_batches(held)
        idx, sizes = _values(table["idx"], np.int32)
        group = np.repeat(table["piece_group"].to_numpy(), sizes)
        name, _ = _values(table["name"], np.uint64)
        owner, _ = _values(table["owner"], np.int64)
        size, _ = _values(table["size"], np.int32)
        loosen = zstandard.ZstdDecompressor().decompress
        body = b"".join(loosen(d.as_py()) for d in table["data"])
        del table, held
        data = np.frombuffer(body, np.uint8)
        ends = np.cumsum(size.astype(np.int64))
        starts = ends - size
        # Equal runs of all groups: one class with its least owner.
        seen: dict[tuple[int, bytes], int] = {}
        which = np.empty(len(name), np.int64)
        one = []
        for i, (a, b, key) in enumerate(zip(starts.tolist(), ends.tolist(), name.tolist(), strict=True)):
            k = seen.setdefault((key, body[a:b]), len(one))
            if k == len(one):
                one.append(i)
            which[i] = k
        one = np.array(one, np.int64)
        least = np.full(len(one), LAST_ID)
        np.minimum.at(least, which, owner)
        seen.clear()
        windows = size[one] - min_length + 1
        # Names with several distinct runs need the order of their suffixes.
        by_name = np.argsort(name[one], kind="stable")
        names = name[one][by_name]
        start = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.zeros(0, np.int64)
        run = np.diff(np.append(start, len(names)))
        several = by_name[np.repeat(run > 1, run)]
        cuts = np.concatenate(([True], name[one][several][1:] != name[one][several][:-1])) if len(several) else np.zeros(0, bool)
        gone_class, gone_at = [], []
        load = np.cumsum(windows[several])
        a = 0
        edges = np.append(np.flatnonzero(cuts), len(several))
        while a < len(several):
            # As many whole names as fit; one name at least.
            limit = (load[a - 1] if a else 0) + most
            b = edges[np.searchsorted(edges, a, "right") :]
            fits = b[load[b - 1] <= limit]
            end = int(fits[-1]) if len(fits) else int(b[0])
            classes = several[a:end]
            w = windows[classes]
            which_class = np.repeat(classes, w)
            within = np.arange(len(which_class)) - np.repeat(np.cumsum(w) - w, w)
            rows = np.lib.stride_tricks.sliding_window_view(data, min_length)[starts[one[which_class]] + within]
            repeated = previous_factors(rows, least[which_class])
            gone_class.append(which_class[repeated])
            gone_at.append(within[repeated])
            a = end
        lone = np.concatenate(gone_class) if gone_class else np.zeros(0, np.int64)
        at = np.concatenate(gone_at) if gone_at else np.zeros(0, np.int64)
        order = np.lexsort((at, lone))
        lone, at = lone[order], at[order]
        # Stretches of removed windows per class.
        new = np.concatenate(([True], (lone[1:] != lone[:-1]) | (at[1:] != at[:-1] + 1))) if len(lone) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(lone) - 1) if len(first) else first
        span_class, span_from, span_to = lone[first], at[first], at[last] + 1
        spans_from = np.searchsorted(span_class, np.arange(len(one)))
        spans_to = np.searchsorted(span_class, np.arange(len(one)), "right")
        whole = owner > least[which]
        n_spans = np.where(whole, 1, spans_to[which] - spans_from[which])
        entry = np.repeat(np.arange(len(which)), n_spans)
        nth = np.arange(len(entry)) - np.repeat(np.cumsum(n_spans) - n_spans, n_spans)
        is_whole = whole[entry]
        source = np.where(is_whole, 0, spans_from[which[entry]] + nth)
        if len(span_from):
            begin = np.where(is_whole, 0, span_from[source])
            finish = np.where(is_whole, size[entry] - min_length + 1, span_to[source])
        else:
            begin, finish = np.zeros(len(entry), np.int64), size[entry] - min_length + 1
        target = group[entry]
        order = np.argsort(target, kind="stable")
        have, at = np.unique(target[order], return_index=True)
        edges = np.append(at, len(order))
        out = np.stack([idx[entry], begin, finish], 1).astype(np.int32)[order]
        for i in range(len(have)):
            yield pa.RecordBatch.from_pydict(
                {
                    "part": [0], "piece_group": [int(have[i])], "kind": [2],
                    "idx": [b""], "name": [b""], "owner": [b""], "size": [b""],
                    "data": [out[edges[i] : edges[i + 1]].tobytes()],
                },
                schema=pa.schema(
                    [("part", pa.int32()), ("piece_group", pa.int32()), ("kind", pa.int32())]
                    + [(c, pa.binary()) for c in ("idx", "name", "owner", "size", "data")]
                ),
            )

    return answers


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open intervals."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], begin[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return begin[first], reach[np.append(first[1:] - 1, len(begin) - 1)]


def _cut_group(min_length: int):
    def cut(classes: pa.Table, rows: pa.Table) -> pa.Table:
        digest, owner, data, offsets = _texts(classes)
        kinds = rows["kind"].to_numpy()
        state_rows = rows.filter(pa.array(kinds == 1))
        which, _ = _values(state_rows["idx"], np.int32)
        state, _ = _values(state_rows["data"], np.int32)
        doc, first, count, later = state.reshape(-1, 4).astype(np.int64).T
        told, _ = _values(rows.filter(pa.array(kinds == 2))["data"], np.int32)
        told = told.reshape(-1, 3).astype(np.int64)
        told = told[np.argsort(told[:, 0], kind="stable")]
        a, b = np.searchsorted(told[:, 0], which), np.searchsorted(told[:, 0], which, "right")
        n = np.where(later == 1, 1, b - a)
        run = np.repeat(np.arange(len(which)), n)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        whole = later[run] == 1
        source = np.where(whole, 0, a[run] + nth)
        if len(told):
            begin, finish = np.where(whole, 0, told[source, 1]), np.where(whole, count[run], told[source, 2])
        else:
            begin, finish = np.zeros(len(run), np.int64), count[run]
        # One empty place between documents keeps their runs apart.
        shift = offsets[doc[run]] + doc[run]
        begin, finish = shift + first[run] + begin, shift + first[run] + finish + min_length - 1
        if len(begin):
            begin, finish = _merged(begin, finish)
        home = np.searchsorted(offsets[:-1] + np.arange(len(offsets) - 1), begin, "right") - 1
        n_docs = len(owner)
        spans = np.searchsorted(home, np.arange(n_docs + 1))
        base = offsets[home] + home
        begin, finish = begin - base, finish - base
        sizes = np.diff(offsets)
        removed = np.zeros(n_docs, np.int64)
        np.add.at(removed, home, finish - begin)
        kept = [bytes(d.as_py()).hex() for d in digest]
        for i in np.unique(home).tolist():
            sha, at, text = hashlib.sha256(), 0, data[offsets[i] : offsets[i + 1]]
            for j in range(spans[i], spans[i + 1]):
                sha.update(text[at : begin[j]])
                at = finish[j]
            sha.update(text[at:])
            kept[i] = sha.hexdigest()
        ranges = pa.StructArray.from_arrays([pa.array(begin, pa.int64()), pa.array(finish, pa.int64())], ["start", "end"])
        return pa.table(
            {
                "digest": digest,
                "owner": pa.array(owner, pa.int64()),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed),
                "spans": pa.ListArray.from_arrays(pa.array(spans, pa.int32()), ranges),
                "kept_sha256": pa.array(kept, pa.string()),
            }
        )

    return cut


# ---------------------------------------------------------------- operator


def _class_results(docs: DataFrame, min_length: int, hot_groups: int, group_bytes: int) -> DataFrame:
    """One row per distinct text: digest, owner (least id) and the cut."""
    spark = docs.sparkSession
    workers_import(spark)
    total = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    setting = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(setting, -(-total // (4 * group_bytes))), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    groups = 4 * buckets
    grouped = lambda rows: rows.withColumn(
        "piece_group", F.pmod(F.xxhash64("_digest"), F.lit(groups)).cast("int")
    )
    # Texts move once. The commonest ones, at most HOT_TEXTS, are one row per task
    # before they do; copies of others meet in the task that owns their group.
    owners = docs.groupBy("_digest").agg(F.count(F.lit(1)).alias("n"))
    rows = owners.agg(F.sum("n")).first()[0] or 0
    hot = owners.where(F.col("n") > max(COMMON, rows // HOT_TEXTS)).select("_digest")
    one = lambda rows, *by: rows.groupBy(*by, "_digest").agg(F.min("_id").alias("_id"), F.first("_text").alias("_text"))
    common = one(docs.join(F.broadcast(hot), "_digest"))
    others = docs.join(F.broadcast(hot), "_digest", "left_anti").select(common.columns)
    placed = grouped(others.unionByName(common)).repartition(buckets, "piece_group")
    classes = one(placed, "piece_group").select(
        "piece_group", F.col("_digest").alias("digest"), F.col("_id").alias("owner"), F.encode("_text", "UTF-8").alias("data")
    )
    name, path = f"suffix_classes_{uuid.uuid4().hex}", work_dir(spark, "suffix-classes")
    classes.write.bucketBy(buckets, "piece_group").option("path", path).saveAsTable(name)
    try:
        held = spark.table(name)
        by_group = held.groupBy("piece_group")
        names = by_group.applyInArrow(_names_of_group(min_length, buckets), "part int, piece_group int, names binary")
        hints = names.repartitionById(buckets, "part").mapInArrow(
            _shared_names(hot_groups), "piece_group int, names binary, hot binary"
        )
        runs = by_group.cogroup(hints.groupBy("piece_group")).applyInArrow(_candidate_runs(min_length, buckets), PACKET)
        answers = runs.repartitionById(buckets, "part").mapInArrow(_factor_task(min_length), PACKET)
        cut = by_group.cogroup(answers.groupBy("piece_group")).applyInArrow(
            _cut_group(min_length), f"digest binary, owner long, {REPEATS}"
        )
        return stored(cut, "suffix-cuts")
    finally:
        spark.sql(f"drop table if exists {name}")
        delete(spark, path)


def find_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    result: str = "repeats",
    hot_groups: int = HOT_GROUPS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``docs`` with a struct of the text's bytes, the removed ones, their spans
    (half-open byte ranges of the original text) and the SHA-256 of what is left."""
    text = text_or_empty(F.col(text_col))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    digest = F.unhex(F.sha2(text, 256))
    plain = docs.select(digest.alias("_digest"), key.alias("_id"), text.alias("_text"))
    found = _class_results(plain, min_length, hot_groups, group_bytes)
    result, by, own_id, cut = (free_name(docs, c) for c in (result, "suffix_digest", "suffix_id", "suffix_cut"))
    found = found.select(
        F.col("digest").alias(by),
        F.struct("owner", "n_bytes", "n_removed", "spans", "kept_sha256").alias(cut),
    )
    size = F.col(cut)["n_bytes"]
    whole = F.struct(
        size.alias("n_bytes"),
        size.alias("n_removed"),
        F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("end"))).alias("spans"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"),
    )
    own = F.struct(*[F.col(cut)[c].alias(c) for c in ("n_bytes", "n_removed", "spans", "kept_sha256")])
    copy = (F.col(own_id) > F.col(cut)["owner"]) & (size >= min_length)
    return (
        docs.select("*", digest.alias(by), key.alias(own_id))
        .join(found, by)
        .select(*[F.col(f"`{c}`") for c in docs.columns], F.when(copy, whole).otherwise(own).alias(result))
    )


def kept_bytes(text: str | Column, spans: str | Column) -> Column:
    """The bytes of ``text`` outside ``spans``, as a binary column."""
    body = F.encode(text_or_empty(text), "UTF-8")
    spans = F.col(spans) if isinstance(spans, str) else spans
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at(spans, i.cast("int"))["end"])
    end = lambda i: F.when(i == F.size(spans), F.octet_length(body)).otherwise(F.element_at(spans, (i + 1).cast("int"))["start"])
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.hex(F.substring(body, (start(i) + 1).cast("int"), (end(i) - start(i)).cast("int"))),
    )
    return F.unhex(F.array_join(pieces, ""))
