"""Token-id files: documents encoded, coded into checksummed blocks, read back.

Documents are dealt to tasks by ranges of their id and sorted, so that file after
file and block after block the ids ascend. A task encodes its documents, appends
the end id to each and codes them into blocks of whole documents with the context
coder of ``id_coder``; a block is independent of all others. A file is a Parquet
file of the shared folder whose rows are blocks: ``part`` (its place among the
files), ``block``, ``first`` (ids in the part before it), ``n_ids``, ``doc_ids``,
``sizes`` (ids of each document) and ``payload``.

Reading decodes each block on its own, checks it, and cuts it into documents.
Where a document starts in the whole collection is the sum of the parts before,
one row per part, plus its place in the part.

Defined results: null texts count as empty and are their end id alone. Null ids
come first. Rows with the same id are documents of their own, in the order of a
hash of their text. An empty table gives no blocks and no rows. Other columns are
not looked at. A document is never divided between blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.common import text_or_empty, workers_import
from eventmart.llm.id_coder import DamagedBlock, decode_block, encode_block
from eventmart.llm.tokens import chunk_ids, vocabulary

END_ID = 2
BLOCK_IDS = 1 << 20


def _block_writer(path: str, end_id: int, block_ids: int):
    end = end_id.to_bytes(4, "little")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_ids(path)
        size = max(encoder.library.get_vocab_size(), end_id + 1)
        part = TaskContext.get().partitionId()
        ids: list[bytes] = []
        docs, waiting, first, number = [], 0, 0, 0
        schema = None

        def block() -> pa.RecordBatch:
            nonlocal first, number, waiting
            sizes = [len(i) // 4 for i in ids]
            payload = encode_block(np.frombuffer(b"".join(ids), dtype="<u4"), size)
            row = [[part], [number], [first], [waiting], [list(docs)], [sizes], [payload]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(schema), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "block", "first", "n_ids", "doc_ids", "sizes", "payload"]
            first, number, waiting = first + waiting, number + 1, 0
            ids.clear()
            docs.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            schema = batch.schema.field("doc_id").type
            coded = encoder.encode_all(batch.column("text").to_pylist())
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                ids.append(own + end)
                docs.append(doc_id)
                waiting += len(ids[-1]) // 4
                if waiting >= block_ids:
                    yield block()
        if ids:
            yield block()

    return blocks


def write_tokens(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``docs`` in ascending order of id into files under ``path``."""
    spark = docs.sparkSession
    workers_import(spark)
    source = docs.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    ranged = source.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "tie").drop("tie")
    ranged.mapInArrow(
        _block_writer(vocabulary(tokenizer_path), end_id, block_ids),
        f"part bigint, block bigint, first bigint, n_ids bigint, doc_ids array<{id_type}>, "
        "sizes array<bigint>, payload binary",
    ).write.parquet(path)


def _documents(with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("part", "first", "n_ids", "sizes", "payload")}
                ids = decode_block(row["payload"])
                if len(ids) != row["n_ids"] or sum(row["sizes"]) != row["n_ids"]:
                    raise DamagedBlock("the block's documents don't add up")
                raw, place = ids.tobytes(), 0
                starts, sums, texts = [], [], []
                for size in row["sizes"]:
                    own = raw[4 * place : 4 * (place + size)]
                    starts.append(row["first"] + place)
                    sums.append(zlib.crc32(own))
                    texts.append(own if with_ids else None)
                    place += size
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids").slice(i, 1).flatten(),
                        pa.array([row["part"]] * len(sums), pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(row["sizes"], pa.int64()),
                        pa.array(sums, pa.int64()),
                        pa.array(texts, pa.binary()),
                    ],
                    names=["doc_id", "part", "place", "n_tokens", "ids_crc32", "ids"],
                )

    return read


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32, ids (little-endian unsigned 32-bit, or null)."""
    workers_import(spark)
    files = spark.read.parquet(path)
    id_type = files.schema["doc_ids"].dataType.elementType.simpleString()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: bounded by the number of tasks that wrote, not by the data.
    bases = (
        files.groupBy("part")
        .agg(F.sum("n_ids").alias("ids_in_part"))
        .select("part", F.coalesce(F.sum("ids_in_part").over(before), F.lit(0)).alias("base"))
    )
    rows = files.select("part", "first", "n_ids", "doc_ids", "sizes", "payload").mapInArrow(
        _documents(with_ids),
        f"doc_id {id_type}, part bigint, place bigint, n_tokens bigint, ids_crc32 bigint, ids binary",
    )
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
