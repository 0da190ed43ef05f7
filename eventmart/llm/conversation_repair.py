"""Least-cost repair of conversations, by prefix-doubling path ranking.

A conversation's rows, in order of turn, are edited until the initials of the roles
read ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3, and the only
edit of blank and repeated rows), Insert an empty user or assistant row anywhere (2);
a truncated row that stays adds 1. Of the cheapest edits the audit, their initials in
order, is the least in ASCII order.

*Cost.* A layer lies before each row and after the last one, with four nodes: nothing
yet, after ``s``, after ``u``, after ``a``. Costs from each node to the end are products
of small (min, +) matrices, taken by doubling for all rows of a block at once.

*Path.* An arc is optimal if it and the rest of its way cost what its start costs.
Nodes of a layer are ranked by their least audit of length 1, then 2, 4, 8...: twice
the length is the pair (rank here, rank where the pointer of that length leads), and
pointers double alike. Ranks choose among the arcs; the letters of a whole audit are
then read at once, each by the pointers of the powers of two that make up its place.

*Spark.* Equal rows of a conversation collapse to one with a count before anything is
ordered. Faults come from aggregates and a join that Spark may split. What a
conversation's task holds is a few bytes per row without text; its texts only pass by,
in order, when they are hashed or given out. One conversation's audit and hash are single
values over all its rows, so one task must see them in order, however long.

Defined results: rows order by turn (nulls first), then role, then SHA-256 of the text.
Null roles and texts count as one space. Null conversation ids are one conversation.
``turn`` is a whole number. Conversations named in ``conversations`` without rows give zeros,
an empty audit and the hash of nothing. An empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import stored, workers_import

BLOCK_ROWS = 1 << 17
BLANKS = " \t\n\x0b\x0c\r"
INITIALS = "sua"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
START, SYSTEM, USER, ASSISTANT, END = range(5)
FAR = 1 << 29
KEEP, REROLE, DELETE, INSERT = 75, 82, 68, 73
REROLE_COST, DELETE_COST, INSERT_COST = 2, 3, 2
# What a row with initial s, u or a leads to from each node; -1: not allowed.
FOLLOWS = np.array([[SYSTEM, USER, -1], [-1, USER, -1], [-1, -1, ASSISTANT], [-1, USER, -1]])
# Where a rerole or an insert leads: to a user row, after one to an assistant row.
NEXT = np.array([USER, USER, ASSISTANT, USER])
FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


# ---------------------------------------------------------------- one block of rows


def _row_arcs(initial: np.ndarray, fault: np.ndarray):
    """Arcs of the row layers: per edit (letter, cost, next node), shape (rows, 4)."""
    n = len(initial)
    nodes = np.tile(np.arange(4), (n, 1))
    gone = ((fault == BLANK) | (fault == DUPLICATE))[:, None]
    extra = (fault == TRUNCATED).astype(np.int64)[:, None]
    known = initial >= 0
    keep = np.where(known[:, None], FOLLOWS.T[np.maximum(initial, 0)], -1)
    keep_cost = np.where((keep < 0) | gone, FAR, extra)
    rerole_cost = np.where(gone, FAR, REROLE_COST + extra) + np.zeros((n, 4), np.int64)
    return (
        (DELETE, np.full((n, 4), DELETE_COST), nodes),
        (KEEP, keep_cost, np.maximum(keep, 0)),
        (REROLE, rerole_cost, np.tile(NEXT, (n, 1))),
    )


def _inserts() -> np.ndarray:
    """Cost from node to node by inserts alone."""
    cost = np.full((5, 5), FAR, np.int64)
    np.fill_diagonal(cost, 0)
    cost[np.arange(4), NEXT] = INSERT_COST
    for via in range(5):
        cost = np.minimum(cost, cost[:, via, None] + cost[None, via, :])
    return cost


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product of matrices."""
    out = a[..., :, 0, None] + b[..., None, 0, :]
    for k in range(1, a.shape[-1]):
        np.minimum(out, a[..., :, k, None] + b[..., None, k, :], out=out)
    return np.minimum(out, FAR)


def cheapest_edits(initial: np.ndarray, fault: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Cost and audit of each conversation of a block.

    ``initial`` is 0, 1, 2 for s, u, a and -1 otherwise; ``sizes`` has the rows of each.
    """
    many, rows = len(sizes), len(initial)
    layers = rows + many
    conv = np.repeat(np.arange(many), sizes)
    at = np.arange(rows) + conv  # layer of each row
    last = np.cumsum(sizes + 1) - 1  # layer after each conversation's rows
    first = last - sizes
    end_of = np.repeat(last, sizes + 1)
    arcs = _row_arcs(initial, fault)

    step = np.full((layers, 5, 5), FAR, np.int32)
    row_index = np.arange(rows)
    for _, cost, to in arcs:
        for q in range(4):
            cell = step[at, q, to[:, q]]
            step[at, q, to[:, q]] = np.minimum(cell, cost[row_index, q])
    step[last, START, END] = 0
    step[last, ASSISTANT, END] = 0
    step[last, END, END] = 0
    step = _times(_inserts().astype(np.int32)[None], step)
    longest = int(sizes.max(initial=0)) + 1
    reach = 1
    while reach < longest:
        step = _times(step, step[np.minimum(np.arange(layers) + reach, end_of)])
        reach *= 2
    rest = step[:, :4, END].astype(np.int64)  # cost from each node to the end

    # Optimal arcs, least letter first; the pointer and the rank of length 1.
    letter = np.zeros((layers, 4), np.int64)
    pointer = np.arange(layers * 4).reshape(layers, 4)
    ends = np.zeros((layers, 4), bool)
    ends[last] = rest[last] == 0
    all_layers = np.arange(layers)
    options = []
    for sign, cost, to in arcs:
        if sign == KEEP:  # in ASCII order inserts come between deletes and keeps
            options.append((INSERT, all_layers, np.full((layers, 4), INSERT_COST), np.tile(NEXT, (layers, 1)), 0))
        options.append((sign, at, cost, to, 1))
    chosen = ends.copy()
    for sign, where, cost, to, ahead in options:
        target = where + ahead
        good = (cost < FAR) & (rest[where] == cost + np.take_along_axis(rest[target], to, 1)) & (rest[where] < FAR)
        new = good & ~chosen[where]
        i, q = np.nonzero(new)
        letter[where[i], q] = sign
        pointer[where[i], q] = target[i] * 4 + to[i, q]
        chosen[where[i], q] = True

    rank = letter.copy()
    length = (letter > 0).astype(np.int64)
    levels = []
    while True:
        levels.append(pointer.ravel())
        ahead = pointer.ravel()
        further = length.ravel()[ahead].reshape(layers, 4)
        if not further.any():
            break
        # Twice the length: the pair of this rank and the rank where the pointer leads,
        # dense within the layer again.
        pair = rank * 256 + rank.ravel()[ahead].reshape(layers, 4)
        rank = (pair[:, :, None] > pair[:, None, :]).sum(axis=2)
        length = length + further
        pointer = ahead[ahead].reshape(layers, 4)
    start = first * 4 + START
    sizes_out = length.ravel()[start]
    place = np.arange(int(sizes_out.sum())) - np.repeat(np.cumsum(sizes_out) - sizes_out, sizes_out)
    node = np.repeat(start, sizes_out)
    for bit, level in enumerate(levels):
        node = np.where(place >> bit & 1, level[node], node)
    text = letter.ravel()[node].astype(np.uint8).tobytes()
    cuts = np.concatenate(([0], np.cumsum(sizes_out))).tolist()
    return rest[first, START], [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


# ---------------------------------------------------------------- tasks


def _runs(column: pa.Array) -> np.ndarray:
    """Starts of runs of equal values (nulls are equal)."""
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))


def _audits(kind: pa.DataType):
    """Rows (conv, turn, initial, fault, later, n), sorted, to one row per conversation."""
    schema = pa.schema(
        [("conv", kind)] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string())]
    )

    def finished(held: list[tuple]) -> pa.RecordBatch:
        ids = [h[0] for h in held]
        initial = np.concatenate([h[1] for h in held])
        fault = np.concatenate([h[2] for h in held])
        sizes = np.array([len(h[1]) for h in held])
        conv = np.repeat(np.arange(len(held)), sizes)
        cost, audit = cheapest_edits(initial, fault, sizes)
        count = lambda mask: np.bincount(conv[mask], minlength=len(held))
        pair = initial[:-1] * 4 + initial[1:]
        legal = (initial[:-1] >= 0) & (initial[1:] >= 0) & np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
        illegal = np.bincount(conv[1:][(conv[1:] == conv[:-1]) & ~legal], minlength=len(held))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, kind),
                pa.array([h[3] for h in held], pa.int64()),
                *[pa.array(count(fault == f), pa.int64()) for f in (BLANK, DUPLICATE, TRUNCATED)],
                pa.array(illegal, pa.int64()),
                pa.array(cost, pa.int64()),
                pa.array([a.decode() for a in audit], pa.string()),
            ],
            schema=schema,
        )

    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows, current, parts, turns = 0, None, None, None

        def close():
            low, high, distinct = turns
            gaps = 0 if low is None else min(high - low + 1 - distinct, 2**63 - 1)
            none = [np.zeros(0, np.int64)]
            held.append((current, np.concatenate(parts[0] or none), np.concatenate(parts[1] or none), gaps))

        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _runs(batch.column("conv"))
            stops = np.append(starts[1:], batch.num_rows)
            n = batch.column("n").to_numpy()
            first_fault = batch.column("fault").to_numpy().astype(np.int64)
            initial = batch.column("initial").to_numpy().astype(np.int64)
            turn = batch.column("turn")
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                key = batch.column("conv")[a].as_py()
                if parts is None or key != current:
                    if parts is not None:
                        close()
                        rows += len(held[-1][1])
                    if rows >= BLOCK_ROWS:
                        yield finished(held)
                        held, rows = [], 0
                    current, parts, turns = key, ([], []), (None, None, 0)
                # A row and its repeats: the repeats are duplicates, unless blank.
                times = n[a:b]
                which = np.repeat(np.arange(a, b), times)
                again = np.concatenate(([False], which[1:] == which[:-1])) if len(which) else np.zeros(0, bool)
                fault = first_fault[which]
                fault[again & (fault != BLANK)] = DUPLICATE
                parts[0].append(initial[which])
                parts[1].append(fault)
                known = turn.slice(a, b - a).filter(pa.array(times > 0)).drop_null()
                if len(known):
                    values = known.to_numpy()
                    low, high, distinct = turns
                    new = int((values[1:] != values[:-1]).sum()) + (high is None or int(values[0]) != high)
                    turns = (int(values[0]) if low is None else low, int(values[-1]), distinct + new)
        if parts is not None:
            close()
        if held:
            yield finished(held)

    return audits


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(plan row, None) before each conversation's repaired (role, text), in order."""
    edits, state = iter(()), START

    def inserted(letter):
        nonlocal state
        while letter == "I":
            state = int(NEXT[state])
            yield ("user" if state == USER else "assistant", "")
            letter = next(edits, "")
        return letter

    plan = None
    for batch in batches:
        columns = batch.to_pydict()
        for i in range(batch.num_rows):
            if columns["ord"][i] == 0:
                if plan is not None:
                    for row in inserted(next(edits, "")):
                        yield None, row
                plan = {c: columns[c][i] for c in columns}
                edits, state = iter(plan["audit"]), START
                yield plan, None
                continue
            role, text = columns["role"][i], columns["text"][i]
            for _ in range(columns["n"][i]):
                letter = yield from _insert_rows(inserted, next(edits, ""))
                if letter == "K":
                    state = int(FOLLOWS[state][INITIALS.index(role[0])])
                    yield None, (role, text)
                elif letter == "R":
                    state = int(NEXT[state])
                    yield None, ("user" if state == USER else "assistant", text)
    if plan is not None:
        for row in inserted(next(edits, "")):
            yield None, row


def _insert_rows(inserted, letter):
    rows = inserted(letter)
    while True:
        try:
            yield None, next(rows)
        except StopIteration as stop:
            return stop.value


def _hashes(kind: pa.DataType):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema(
        [("conv", kind), *[(c, pa.int64()) for c in names], ("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, plan, sha, empty = [], None, None, True
        for new, row in _repaired(batches):
            if new is not None:
                if plan is not None:
                    done.append({**plan, "repaired_sha256": sha.hexdigest()})
                if len(done) >= 4096:
                    yield pa.RecordBatch.from_pylist(done, schema=schema)
                    done = []
                plan, sha, empty = {c: new[c] for c in ("conv", *names, "audit")}, hashlib.sha256(), True
                continue
            sha.update((("" if empty else "\n") + f"{row[0]}:{row[1]}").encode())
            empty = False
        if plan is not None:
            done.append({**plan, "repaired_sha256": sha.hexdigest()})
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    return hashes


def _rows_out(kind: pa.DataType):
    schema = pa.schema([("conv", kind), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, key, turn = [], None, 0
        for new, row in _repaired(batches):
            if new is not None:
                key, turn = new["conv"], 0
                continue
            done.append({"conv": key, "turn": turn, "role": row[0], "text": row[1]})
            turn += 1
            if len(done) >= 1024:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    return rows


# ---------------------------------------------------------------- operator


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) after damage by the crc32 of ``conv_id:turn``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where("fault != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _with_plans(rows: DataFrame, conversations: DataFrame | None) -> tuple[DataFrame, pa.DataType]:
    """Plans and texts in one frame, each conversation's plan before its texts."""
    spark = rows.sparkSession
    workers_import(spark)
    space = F.lit(" ")
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    plain = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), copies.cast("long").alias("n"),
    )
    held = stored(
        plain.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("digest", F.sha2("text", 256)),
        "conversation-rows",
    )
    seen = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    light = held.select(
        "conv", "turn", "role", "digest", "n", when.alias("at"),
        F.when(seen == "", BLANK).when(seen.isin(".", "!", "?"), 0).otherwise(TRUNCATED).alias("fault"),
    )
    first = light.groupBy("conv", "role", "digest").agg(F.min("at").alias("first")).select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(-1)
    faults = light.join(first, same).select(
        "conv", "turn", "role", "digest", initial.alias("initial"), "n",
        F.when((F.col("fault") != BLANK) & (F.col("at") != F.col("first")), DUPLICATE).otherwise(F.col("fault")).alias("fault"),
    )
    if conversations is not None:
        markers = conversations.select(F.col("conv_id").alias("conv")).distinct().select(
            "conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"),
            F.lit(-1).alias("initial"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("fault"),
        )
        faults = faults.union(markers)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    kind = held.select("conv").limit(0).toArrow().schema.field("conv").type
    ddl = held.schema["conv"].dataType.simpleString()
    plans = (
        faults.repartition(n, "conv")
        .sortWithinPartitions("conv", *order)
        .select("conv", "turn", "initial", "fault", "n")
        .mapInArrow(_audits(kind), f"conv {ddl}, {FOUND}")
    )
    plan_columns = [c.split()[0] for c in FOUND.split(", ")]
    empty = [F.lit(None).cast(k).alias(c) for c, k in (p.split() for p in FOUND.split(", "))]
    texts = held.select("conv", F.lit(1).alias("ord"), "turn", "role", "digest", "text", "n", *empty)
    heads = plans.select(
        "conv", F.lit(0).alias("ord"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"),
        F.lit("").alias("text"), F.lit(0).cast("long").alias("n"), *plan_columns,
    )
    both = heads.union(texts).repartition(n, "conv").sortWithinPartitions("conv", "ord", *order)
    return both.drop("turn", "digest"), kind


def repair_plans(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: faults, cost, audit and the hash of the repaired text.

    ``rows`` has conv_id, turn, role, text and may have ``copies`` (adjacent repeats).
    Every conv_id of ``conversations``, where given, has a row.
    """
    both, kind = _with_plans(rows, conversations)
    ddl = both.schema["conv"].dataType.simpleString()
    found = both.mapInArrow(_hashes(kind), f"conv {ddl}, {FOUND}, repaired_sha256 string")
    return found.withColumnRenamed("conv", "conv_id")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0, without gaps), role, text."""
    both, kind = _with_plans(rows, None)
    ddl = both.schema["conv"].dataType.simpleString()
    found = both.mapInArrow(_rows_out(kind), f"conv {ddl}, turn long, role string, text string")
    return found.withColumnRenamed("conv", "conv_id")
