"""From JSON messages to normalised events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.functions.text import repair_text


def decode(messages: DataFrame, topic: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parse ``value`` with the topic's wire schema; broken JSON gives NULLs.

    With ``columns`` the parser builds only those fields and skips the others,
    which is what a metric that needs two of twenty wants.
    """
    schema = schemas.wire(topic)
    if columns is not None:
        schema = T.StructType([schema[c] for c in columns])
    event = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(event.alias("event")).select("event.*")


def decode_open(messages: DataFrame, topic: str) -> DataFrame:
    """The topic's typed fields and the whole message as a VARIANT in ``message``.

    A message is parsed once; fields the wire schema doesn't know stay in ``message``,
    from which ``field`` takes them when they are wanted. Broken JSON and values of
    another type give NULLs.
    """
    opened = messages.select(F.try_parse_json(F.col("value").cast("string")).alias("message"))
    typed = [field(f.name, f.dataType.simpleString()).alias(f.name) for f in schemas.wire(topic).fields]
    return opened.select(*typed, "message")


def field(name: str, kind: str, message: str = "message") -> Column:
    """A field of a VARIANT message as a value of type ``kind``, or NULL."""
    return F.try_variant_get(message, f"$.{name}", kind)


def normalize(decoded: DataFrame, topic: str) -> DataFrame:
    """Epoch milliseconds to timestamps, song and artist text repaired.

    Text is repaired here, before any grouping, so two spellings of one song
    are counted together.
    """
    times = {c: F.timestamp_millis(c) for c in schemas.EPOCH_COLUMNS if c in decoded.columns}
    texts = {
        c: repair_text(c)
        for c in ("song", "artist")
        if topic in schemas.TEXT_TOPICS and c in decoded.columns
    }
    return decoded.withColumns({**times, **texts})


def events(messages: DataFrame, topic: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``decode`` and ``normalize`` in one."""
    return normalize(decode(messages, topic, columns), topic)


def rejected(messages: DataFrame) -> DataFrame:
    """The text of messages without a usable event time."""
    text = F.col("value").cast("string").alias("value")
    parsed = F.from_json(F.col("value").cast("string"), "ts BIGINT")
    return messages.select(text, parsed.alias("event")).where("event.ts IS NULL").select("value")
