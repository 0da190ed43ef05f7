"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the results depend on: one zone for day boundaries, strict casts.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# How times are stored: as 64-bit integers, which have minima and maxima to
# filter by, rather than in the older 96-bit form.
STORAGE_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

# What only the speed depends on. AQE sizes shuffles and splits hot partitions
# at run time; RocksDB keeps streaming state off the JVM heap.
PHYSICAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build(app: str = "eventmart", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the engine's settings; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**PHYSICAL_CONF, **STORAGE_CONF, **SEMANTIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results and files depend on in a session made elsewhere."""
    for key, value in {**STORAGE_CONF, **SEMANTIC_CONF}.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_BASES: dict[str, str] = {}


def _shared_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_BASES:
        _LOCAL_BASES[application] = tempfile.mkdtemp(prefix="eventmart-")
        atexit.register(shutil.rmtree, _LOCAL_BASES[application], ignore_errors=True)
    return _LOCAL_BASES[application]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Executors must be able to read what others wrote there, so a machine-local
    folder is only made where the master is local and the setting is absent, as
    in tests; it goes when the program ends.
    """
    return f"{_shared_base(spark)}/{name}-{uuid.uuid4().hex}"
