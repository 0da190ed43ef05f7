"""Event topics as streams of one text column, ``value``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_options(topic: str, options: Mapping[str, str]) -> dict[str, str]:
    """Reader options for one topic; the caller's options win over the defaults."""
    if "kafka.bootstrap.servers" not in options:
        raise ValueError("kafka.bootstrap.servers is required")
    return {**KAFKA_DEFAULTS, **options, "subscribe": topic}


def topic_stream(
    spark: SparkSession,
    topic: str,
    options: Mapping[str, str] | None = None,
    fmt: str = "kafka",
    path: str | None = None,
) -> DataFrame:
    """Subscribe to ``topic``.

    ``fmt="kafka"`` reads the broker; set ``maxOffsetsPerTrigger`` in
    ``options`` to bound a micro-batch after an outage. ``text`` (JSON lines)
    and ``parquet`` follow a folder of files, ``path`` or ``path/topic``.
    """
    options = dict(options or {})
    if fmt == "kafka":
        source = spark.readStream.format("kafka").options(**kafka_options(topic, options))
        return source.load().select(F.col("value").cast("string").alias("value"))
    if fmt not in ("text", "parquet"):
        raise ValueError(f"unknown topic format {fmt!r}")
    if path is None:
        raise ValueError("a file topic needs a path")
    folder = path if options.pop("flat", None) else f"{path.rstrip('/')}/{topic}"
    return spark.readStream.format(fmt).schema("value STRING").options(**options).load(folder)
