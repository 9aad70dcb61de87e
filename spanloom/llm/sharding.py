"""Shards of bounded size by extendible hashing; DataFrame functions only.

A document's 60-bit key comes from the MD5 of its id and text. The directory starts with one bucket
for all keys; a bucket above the byte limit splits on the next bit of the key, and only that one, so
a shard is a key prefix of just the depth it needs. The splits are found on byte counts per prefix,
not on the documents: one aggregate to a depth where the average bucket is far below the limit, the
sums of all shallower prefixes from that, and the first depth that fits. Prefixes that are still too
large there are counted again, and only they, some bits deeper.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

KEY_BITS = 60
#: Bytes of UTF-8 text a shard may hold.
SHARD_BYTES = 16 << 20
#: Directory bits counted beyond the average shard, and at each further pass.
SPARE_BITS, MORE_BITS = 3, 6


def _prefix(depth):
    return F.expr(f"shiftright(key, {KEY_BITS} - {depth})")


def _leaves(fine: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """For each fine prefix (depth high): its shallowest depth >= low whose prefix fits the limit."""
    # prefix, bytes, rows at depth high -> sums at every depth from low to high
    every = fine.select("p", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn(
        "at", F.expr(f"shiftright(p, {high} - depth)")
    )
    fits = every.groupBy("depth", "at").agg(F.sum("bytes").alias("b")).where(F.col("b") <= limit).select("depth", "at")
    return every.join(fits, ["depth", "at"]).groupBy("p").agg(F.min("depth").alias("depth"))


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """docs with shard_depth, shard_prefix and shard_id ("depth:prefix") added.

    A shard's texts have at most ``limit`` bytes of UTF-8 in all. One text above the limit, or rows
    that agree in id and text and exceed it together, form a shard of their own at the full depth of
    60 bits. Null ids and texts count as empty; an empty table gives an empty result. Columns of
    docs with the names of added ones are replaced.
    """
    docs = docs.drop("shard_depth", "shard_prefix", "shard_id")
    own = "__shard"  # starts no column of docs
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    keyed = docs.withColumn(f"{own}_key", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    sizes = materialize(
        keyed.groupBy(F.col(f"{own}_key").alias("key")).agg(F.sum(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0))).cast("long").alias("bytes")),
        "sizes",
    )
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(KEY_BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total) / limit))))
    found, rest = [], sizes
    while True:
        fine = rest.groupBy(_prefix(high).alias("p")).agg(F.sum("bytes").alias("bytes"))
        leaf = _leaves(fine, low, high, limit)
        if high == KEY_BITS:  # nothing is left to split on
            leaf = fine.join(leaf, "p", "left").select("p", F.coalesce("depth", F.lit(KEY_BITS)).alias("depth"))
        leaf = materialize(leaf.select(F.lit(high).alias("level"), "p", F.col("depth").cast("int").alias("depth")), f"leaves{high}")
        found.append((high, leaf))
        if high == KEY_BITS:
            break
        rest = materialize(rest.withColumn("p", _prefix(high)).join(leaf, "p", "left_anti").select("key", "bytes"), f"oversized{high}")
        if not rest.take(1):
            break
        low, high = high + 1, min(KEY_BITS, high + MORE_BITS)
    out = keyed
    depth = F.lit(None).cast("int")
    for high, leaf in found:
        mine = leaf.select(F.col("p").alias(f"{own}_p{high}"), F.col("depth").alias(f"{own}_d{high}"))
        out = out.join(mine, F.expr(f"shiftright({own}_key, {KEY_BITS} - {high})") == F.col(f"{own}_p{high}"), "left")
        depth = F.coalesce(depth, F.col(f"{own}_d{high}"))
    out = out.withColumn("shard_depth", depth).withColumn("shard_prefix", F.expr(f"shiftright({own}_key, {KEY_BITS} - shard_depth)"))
    return out.select(*docs.columns, "shard_depth", "shard_prefix", F.concat_ws(":", "shard_depth", "shard_prefix").alias("shard_id"))


def shard_sizes_sql(limit: int = SHARD_BYTES) -> str:
    """DuckDB SQL for doc_id, n_bytes, shard_depth, shard_prefix, shard_id of table documents."""
    return f"""
WITH keyed AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15) AS BIGINT) AS k
  FROM documents),
sums AS (
  SELECT d, k >> (60 - d) AS p, sum(n_bytes) AS b
  FROM keyed, (SELECT CAST(range AS INTEGER) AS d FROM range(0, 61)) GROUP BY d, k >> (60 - d)),
fit AS (
  SELECT k, coalesce(min(d), 60) AS depth
  FROM (SELECT DISTINCT k FROM keyed) LEFT JOIN sums ON k >> (60 - d) = p AND b <= {limit} GROUP BY k)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS shard_depth, CAST(k >> (60 - depth) AS BIGINT) AS shard_prefix,
       CAST(depth AS VARCHAR) || ':' || CAST(k >> (60 - depth) AS VARCHAR) AS shard_id
FROM keyed JOIN fit USING (k)"""
