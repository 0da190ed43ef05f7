"""Exact dedup by an extendible-hash index on shared files.

Every document gets a 64-bit hash of its normalised text (A-Z lower-cased; null
counts as empty). The directory names a bucket by the top bits of the hash: all
buckets start with ``start_depth`` bits, and while a bucket holds more than
``capacity`` keys the directory is doubled for it, which splits the bucket by
its next bit, up to ``max_depth`` bits. Buckets are ranges of keys and own the texts:
texts are grouped by (bucket, hash, bytes), equal hashes with unequal bytes of a
bucket stay apart as links of one chain, and owner tasks write the buckets, range
after range, to the shared folder. The index has one row per link with the row that
stays, the group's size and its SHA-256. Documents find their bucket in the directory
and look up their link in it by hash and SHA-256.

Everything is DataFrame work. The grouping combines before the shuffle, so a
text that a third of all rows share is one row per task; look-ups are a join whose
larger partitions Spark may split, and rows that repeat both id and text are written
out by several tasks. A chain in which two unequal texts had the same SHA-256 would
stop the job.

Defined results: a null text equals the empty text. Null ids rank below all
others. Of rows equal in id and text exactly one stays. An empty table gives no
rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import ascii_lower, stored, text_or_empty

CAPACITY = 256
START_DEPTH = 4
MAX_DEPTH = 18
CHUNK = 4096  # repeats of one id and text that a task writes out at a time


def _top_bits(hash_: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hash_, 64 - bits)


def directory(
    hashes: DataFrame,
    capacity: int = CAPACITY,
    start_depth: int = START_DEPTH,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """The directory for ``hashes`` (column ``hash``, no repeats).

    One row per used entry of ``max_depth`` bits, so ``2**max_depth`` at most:
    entry, n, depth; the bucket an entry points to is its top ``depth`` bits. A
    bucket still overfull at ``max_depth`` stays whole in the directory; its texts
    are dealt to tasks by hash and bytes as well.
    """
    entries = hashes.groupBy(_top_bits(F.col("hash"), max_depth).alias("entry")).agg(
        F.count(F.lit(1)).alias("n")
    )
    found = stored(entries.withColumn("depth", F.lit(start_depth)), "directory")
    for depth in range(start_depth, max_depth):
        bucket = F.shiftright("entry", max_depth - depth)
        overfull = (
            found.where(F.col("depth") == depth)
            .groupBy(bucket.alias("bucket"))
            .agg(F.sum("n").alias("keys"))
            .where(F.col("keys") > capacity)
            .select("bucket", F.lit(True).alias("overfull"))
        )
        if overfull.isEmpty():
            break
        deeper = F.when((F.col("depth") == depth) & F.col("overfull"), depth + 1)
        found = stored(
            found.withColumn("bucket", bucket)
            .join(overfull, "bucket", "left")
            .select("entry", "n", F.coalesce(deeper, "depth").alias("depth")),
            "directory",
        )
    return found


def in_bucket(keyed: DataFrame, found: DataFrame, max_depth: int) -> DataFrame:
    """``keyed`` (column ``hash``) with the depth and bucket the directory ``found`` names."""
    # 2**max_depth rows at most, whatever the input.
    depths = F.broadcast(found.select(F.col("entry").alias("_entry"), "depth"))
    entry = _top_bits(F.col("hash"), max_depth)
    bucket = F.expr(f"shiftright(_entry, {max_depth} - depth)")
    return keyed.join(depths, entry == F.col("_entry")).withColumn("bucket", bucket).drop("_entry")


def build_index(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    start_depth: int = START_DEPTH,
    max_depth: int = MAX_DEPTH,
) -> tuple[DataFrame, DataFrame]:
    """(entries, index), both stored in the shared folder.

    ``entries``: depth, bucket, hash, text_sha256, doc_id, copies; one row per id and text.
    ``index``: depth, bucket, hash, link, text_sha256, keep_id, group_size; one
    row per distinct text.
    """
    keyed = docs.select(
        F.col(id_column).alias("doc_id"),
        ascii_lower(text_or_empty(text_column)).alias("norm"),
    ).withColumn("hash", F.xxhash64("norm"))
    entries = stored(
        keyed.groupBy("hash", F.sha2("norm", 256).alias("text_sha256"), "doc_id").agg(
            F.count(F.lit(1)).alias("copies")
        ),
        "entries",
    )
    found = directory(entries.select("hash").distinct(), capacity, start_depth, max_depth)
    texts = in_bucket(keyed, found, max_depth).groupBy("depth", "bucket", "hash", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    chains = (
        texts.select(
            "depth", "bucket", "hash",
            F.struct(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size").alias("text"),
        )
        .groupBy("depth", "bucket", "hash")
        .agg(F.sort_array(F.collect_list("text")).alias("chain"))
    )
    apart = F.size(F.array_distinct("chain.text_sha256")) == F.size("chain")
    index = chains.select(
        "depth", "bucket", "hash",
        F.posexplode(
            F.when(apart, F.col("chain")).otherwise(
                F.raise_error(F.lit("unequal texts with one SHA-256"))
            )
        ).alias("link", "text"),
    ).select("depth", "bucket", "hash", "link", "text.*")
    # A bucket's range of keys is in one file, in order, unless it is cut for its size.
    lowest = F.expr(f"shiftleft(bucket, {max_depth} - depth)")
    owned = index.repartitionByRange(lowest, F.shiftrightunsigned("hash", 1)).sortWithinPartitions("bucket", "depth", "hash", "link")
    return in_bucket(entries, found, max_depth), stored(owned, "index")


KEY = ["depth", "bucket", "hash", "text_sha256"]


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    start_depth: int = START_DEPTH,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, and
    where the index has its text (bucket, depth, link)."""
    entries, index = build_index(docs, id_column, text_column, capacity, start_depth, max_depth)
    many = entries.where(F.col("copies") > CHUNK)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    rows = entries.where(F.col("copies") <= CHUNK).join(index, KEY).select("*", copy)
    if not many.isEmpty():
        # First the chunks of a row's repeats, dealt to all tasks, then the repeats.
        chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {CHUNK}"))).alias("chunk")
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunks = many.join(index, KEY).select("*", chunk).repartition(n, "hash", "doc_id", "chunk")
        first = F.col("chunk") * CHUNK
        each = F.explode(F.sequence(first + 1, F.least(first + CHUNK, F.col("copies")))).alias("copy")
        rows = rows.unionByName(chunks.select("*", each).drop("chunk"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256",
        "bucket", "depth", "link",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is found again by id and SHA-256. Only where several rows tie in both
    is one of them picked, by all their columns, in a branch that is left out of
    the plan if there are none.
    """
    entries, index = build_index(docs, id_column, text_column)
    stays = (
        entries.join(index, KEY)
        .where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select(
            F.col("text_sha256").alias("_sha"),
            F.col("doc_id").alias("_id"),
            (F.col("copies") > 1).alias("_tied"),
        )
    )
    stays = stored(stays, "stays")
    sha = F.sha2(ascii_lower(text_or_empty(docs[text_column])), 256)

    def rows(which: DataFrame) -> DataFrame:
        same = which["_id"].eqNullSafe(docs[id_column]) & (which["_sha"] == sha)
        return docs.join(which, same, "left_semi")

    tied = stays.where("_tied")
    if tied.isEmpty():
        return rows(stays)
    # The least row by all columns: it combines before the shuffle, so that rows
    # which a third of the table repeats are one row per task.
    whole = F.struct(*[docs[c] for c in docs.columns])
    picked = (
        rows(tied)
        .groupBy(F.col(id_column).alias("_tie_id"), sha.alias("_tie_sha"))
        .agg(F.min_by(whole, F.to_json(whole)).alias("_tie_row"))
        .select("_tie_row.*")
    )
    return rows(stays.where(~F.col("_tied"))).unionByName(picked)
