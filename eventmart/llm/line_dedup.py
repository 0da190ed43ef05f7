"""Substring dedup by hashing lines and windows of words, with the original
offsets retained.

Two kinds of repeats are cut out: runs of repeated lines, and passages of
``min_words`` words or more wherever they begin and end in lines (all windows of
so many words that a lesser (id, place) has, see ``passages``).

For lines, a unit is normalised (A-Z lower-cased, white space between
words one blank) and hashed to 128 bits; blank lines are no units. Digests are
grouped over the whole corpus, and the occurrence of the least (id, position)
stays; every other one is a repeat. Consecutive repeats of a document form a
run, and a run of at least ``min_words`` words is cut out. Shorter runs stay, as
a short line that many documents have is no copied passage.

A digest that a third of all lines share is one row per task before the shuffle
in the grouping, and a partition Spark may split in the join that follows. What
is gathered per document are its own repeats only.

Defined results: null texts stay null, blank ones as they are. Rows equal in id
and text are one document and get one result. Null ids rank before others. A
document that is all repeats is left with an empty text. Spans are character
offsets [start, end) of the original text; joined by line feeds they are the new
text. Where words follow each other in a period, the first ``min_words`` stay.
Columns of the input stay as they are; the result's name must be free.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import free_name, maybe_among, stored, text_or_empty, workers_import
from eventmart.llm.passages import repeated_stretches

MIN_WORDS = 50
SLICE = 512  # documents whose lines a worker holds at a time


def line_units(text: str) -> list[tuple[bytes, int, int, int]]:
    """(digest, start, end, words) of every line that isn't blank."""
    found, start = [], 0
    for line in text.split("\n"):
        words = line.encode().lower().split()
        if words:
            digest = xxhash.xxh3_128_digest(b" ".join(words))
            found.append((digest, start, start + len(line), len(words)))
        start += len(line) + 1
    return found


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["text_hash", "digest", "unit", "start", "end", "words"]
    for whole, first in ((b, i) for b in batches for i in range(0, b.num_rows, SLICE)):
        batch = whole.slice(first, SLICE)
        row, digest, unit, start, end, words = [], [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            for u, (d, s, e, w) in enumerate(line_units(text)):
                row.append(i)
                digest.append(d)
                unit.append(u)
                start.append(s)
                end.append(e)
                words.append(w)
        take = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(take),
                batch.column("text_hash").take(take),
                pa.array(digest, pa.binary()),
                pa.array(unit, pa.int32()),
                pa.array(start, pa.int32()),
                pa.array(end, pa.int32()),
                pa.array(words, pa.int32()),
            ],
            names=["doc_id", *names],
        )


def repeated_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, text_hash, cuts, n_cut, n_passages): for each document with
    something to cut, the spans in order; how many runs of lines and how many
    passages they come from."""
    workers_import(docs.sparkSession)
    source = docs.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    units = stored(
        source.mapInArrow(
            _units,
            f"doc_id {id_type}, text_hash bigint, digest binary, unit int, start int, end int, words int",
        ),
        "units",
    )
    place = F.struct("doc_id", "text_hash", "unit")
    # Stored, so that the join is of two plain shuffles, which Spark may split.
    firsts = stored(
        units.groupBy("digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        "firsts",
    )
    repeats = units.join(firsts, "digest").where(~place.eqNullSafe(F.col("first")))
    # Rows equal in id and text say the same; a document's own repeats only.
    repeats = repeats.select("doc_id", "text_hash", "unit", "start", "end", "words").distinct()
    of_document = Window.partitionBy("doc_id", "text_hash").orderBy("unit")
    runs = (
        repeats.withColumn("run", F.col("unit") - F.row_number().over(of_document))
        .groupBy("doc_id", "text_hash", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"))
        .where(F.col("words") >= min_words)
    )
    passages = _merged(repeated_stretches(source, min_words), 1)
    both = runs.select("doc_id", "text_hash", "start", "end", F.lit(1).alias("n_cut"), F.lit(0).alias("n_passages"))
    both = both.unionByName(
        passages.select("doc_id", "text_hash", "start", "end", F.lit(0).alias("n_cut"), F.lit(1).alias("n_passages"))
    )
    return (
        _merged(both, 0, "n_cut", "n_passages")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"),
            *[F.sum(c).cast("int").alias(c) for c in ("n_cut", "n_passages")],
        )
    )


def _merged(spans: DataFrame, gap: int, *sums: str) -> DataFrame:
    """Spans of a document that overlap, or lie ``gap`` apart at most, as one."""
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("start") > reached + gap).cast("int"), F.lit(0))
    return (
        spans.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "text_hash", "span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), *[F.sum(c).alias(c) for c in sums])
    )


def drop_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = MIN_WORDS,
    result: str = "repeats",
) -> DataFrame:
    """``docs`` with cut texts and a column ``result``: struct of ``n_cut`` (runs of
    lines cut out), ``kept_spans`` (array of start, end in the original text) and
    ``n_passages`` (stretches of repeated windows cut out; whole lines may be both)."""
    cuts = stored(
        repeated_runs(docs, id_column, text_column, min_words).select(
            F.col("doc_id").alias("_cut_id"), F.col("text_hash").alias("_cut_hash"), F.col("cuts").alias("_cuts"),
            F.col("n_cut").alias("_cut_runs"), F.col("n_passages").alias("_cut_passages"),
        ),
        "cuts",
    )
    text, found, near = F.col(text_column), F.col("_cuts"), free_name(docs, "near")
    hashed = F.xxhash64(text_or_empty(docs[text_column]))
    same = cuts["_cut_id"].eqNullSafe(docs[id_column]) & (cuts["_cut_hash"] == hashed)
    marked = maybe_among(docs, hashed, cuts, "_cut_hash", near)
    # Texts pass a hash of the cuts one by one; nothing as large as they is sorted, and
    # those that surely stay whole aren't moved.
    joined = marked.where(F.col(near)).join(cuts.hint("shuffle_hash"), same, "left")
    joined = joined.unionByName(marked.where(~F.col(near)), allowMissingColumns=True)
    long = F.char_length(text_or_empty(text))
    # Kept pieces lie between the cuts, without the white space beside them.
    starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda c: c["end"] + 1))
    ends = F.concat(F.transform(found, lambda c: c["start"] - 1), F.array(long))
    pieces = F.filter(
        F.transform(
            F.arrays_zip(starts.alias("start"), ends.alias("end")),
            lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")),
        ),
        lambda p: p["end"] > p["start"],
    )
    whole = F.filter(
        F.array(F.struct(F.lit(0).alias("start"), long.alias("end"))), lambda p: p["end"] > p["start"]
    )
    is_cut = found.isNotNull()
    spans = F.when(is_cut, pieces).otherwise(whole)
    cut_text = F.array_join(
        F.transform(pieces, lambda p: F.substring(text, p["start"] + 1, p["end"] - p["start"])), "\n"
    )
    n_cut, n_passages = (F.coalesce(c, F.lit(0)) for c in ("_cut_runs", "_cut_passages"))
    return joined.select(
        *[F.when(is_cut, cut_text).otherwise(text).alias(c) if c == text_column else F.col(c) for c in docs.columns],
        F.struct(n_cut.alias("n_cut"), spans.alias("kept_spans"), n_passages.alias("n_passages")).alias(result),
    )
