"""Inner equi-joins of events with dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side whose measured rows take at most this many bytes is sent to every executor.
BROADCAST_BYTES = 64 << 20
# Pieces a key is cut into when both sides are shuffled; a power of two.
SALTS = 16


def row_bytes(side: DataFrame) -> Column:
    """Bytes of a row in memory: its texts as they are, eight for anything else."""
    texts = [f.name for f in side.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = F.lit(16 + 8 * len(side.columns)).cast("bigint")
    return reduce(lambda n, c: n + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)), texts, fixed)


def measure(side: DataFrame) -> int:
    """Bytes of all rows; reads the text columns, and only footers where there are none."""
    return side.agg(F.sum(row_bytes(side))).first()[0] or 0


def lookup(
    events: DataFrame,
    members: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    *,
    size: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``events`` with ``members`` and keep ``take`` of the latter.

    ``on`` maps event columns to member columns. ``size`` is an upper bound on the
    members' bytes where one is known; otherwise they are measured. Within
    ``broadcast_bytes`` the members are broadcast and the events do not move.

    Beyond it the join is hinted to be a merge: Spark guesses a side's bytes by its
    compressed files and sees no copies, so it would broadcast sides far beyond the limit.
    Both sides shuffle on the key and a salt. The salt spreads one
    key's events over ``salts`` tasks and the members are repeated once per
    salt. It is taken from the row's content, so a retried task sends every row
    where the first attempt did. Rows that are equal in all columns share a
    salt; both join inputs are plain shuffles, so AQE splits those further.
    Where ``events`` are aggregated already, ``salts=1`` joins them as they are.
    """
    if salts < 1 or salts & (salts - 1):
        raise ValueError(f"salts must be a power of two, not {salts}")
    keys = {left: f"_key_{i}" for i, left in enumerate(on)}
    side = members.select(*[F.col(on[left]).alias(key) for left, key in keys.items()], *take)
    equal = [F.col(left) == F.col(key) for left, key in keys.items()]
    if (measure(side) if size is None else size) <= broadcast_bytes:
        matched = events.join(F.broadcast(side), equal)
    elif salts == 1:
        matched = events.join(side.hint("merge"), equal)
    else:
        pieces = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        side = side.withColumn("_piece", F.explode(pieces))
        salt = F.xxhash64(*events.columns).bitwiseAND(F.lit(salts - 1))
        salted = events.withColumn("_salt", salt)
        matched = salted.join(side.hint("merge"), [*equal, F.col("_salt") == F.col("_piece")])
    return matched.select(*events.columns, *take)
