"""URL filter: host and path rules, then a list behind a blocked Bloom filter.

Rules are a short list of (verdict, host/path); of those that fit, the longest
decides. Where no rule fits, a list of canonical URLs does: listed means block.
A blocked Bloom filter of the list, ``blocks`` blocks of eight 32-bit words, lets
through what may be listed; only that goes to an exact hash join with the list,
which takes the false positives out again.

The filter has at most ``blocks`` rows whatever the list's length, so it is safe
to broadcast; a list too long for it costs more possible hits, never a wrong
verdict. The words of a block are combined before the shuffle. A URL that a third
of all pages share is a large partition of the exact join, which Spark may split.

Canonical: host without a leading ``www.`` or ``m.``, path without trailing
slashes and ``.html``, no query, no fragment, no scheme.

Defined results: of a null URL, or one without ``://``, host and path are empty
and nothing fits; it is allowed unless the list has the empty URL. Repeated rows
get a verdict each, null entries of the list are ignored, an empty list allows,
an empty table gives no rows. Columns other than the two named are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import ascii_lower

BLOCKS = 1 << 16
WORDS = 8
# After the first "://": up to / ? # or the end, then up to ? # or the end.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    plain_path = F.regexp_replace(F.regexp_replace(path, r"/+\z", ""), r"\.html\z", "")
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), plain_path)


def _fits(rule: str, host: Column, path: Column) -> Column:
    rule_host, slash, rest = rule.partition("/")
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)


def _by_rule(rules: Sequence[Rule], host: Column, path: Column, part: int) -> Column:
    """The longest fitting rule's verdict (part 0) or text (part 1), else null."""
    found: Column = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1])):
        found = F.when(_fits(rule[1], host, path), F.lit(rule[part])).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit of each word, from eight five-bit pieces of the key's hash."""
    hash_ = F.xxhash64(key)
    one = F.lit(1).cast("bigint")
    place = [F.shiftrightunsigned(hash_, 5 * i).bitwiseAND(31).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", one, p) for p in place]


def bloom_filter(listed: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w7), one row per block in use."""
    bits = _bits(F.col(key))
    return (
        listed.where(F.col(key).isNotNull())
        .select(_block(F.col(key), blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
        .groupBy("block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    blocks: int = BLOCKS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, possible (the filter
    let it through). ``listed``: canonical URLs, in its first column."""
    listed = listed.toDF("listed", *(f"_{i}" for i in range(1, len(listed.columns))))
    listed = listed.select("listed").where("listed is not null").distinct()
    host, path = host_of(F.col(url_column)), path_of(F.col(url_column))
    parts = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = parts.select(
        "*",
        _by_rule(rules, F.col("host"), F.col("path"), 1).alias("rule"),
        _by_rule(rules, F.col("host"), F.col("path"), 0).alias("ruled"),
        canonical(F.col("host"), F.col("path")).alias("canonical"),
    )
    probed = judged.withColumn("block", _block(F.col("canonical"), blocks)).join(
        # ``blocks`` rows at most.
        F.broadcast(bloom_filter(listed, "listed", blocks)),
        "block",
        "left",
    )
    hits = [F.col(f"w{i}").bitwiseAND(bit) != 0 for i, bit in enumerate(_bits(F.col("canonical")))]
    possible = F.coalesce(reduce(lambda a, b: a & b, hits), F.lit(False)) & F.col("ruled").isNull()
    probed = probed.select("page_id", "host", "path", "rule", "ruled", "canonical", possible.alias("possible"))
    sure = probed.where(~F.col("possible")).withColumn("listed", F.lit(None).cast("string"))
    checked = probed.where("possible").join(listed, F.col("canonical") == F.col("listed"), "left")
    verdict = F.coalesce("ruled", F.when(F.col("listed").isNotNull(), "block").otherwise("allow"))
    return checked.unionByName(sure).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "possible")
