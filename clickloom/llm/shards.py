"""Shards of bounded size by extendible hashing, in DataFrame operations alone.

A document's 60-bit hash comes from doc_id and text. The directory starts with one bucket; a bucket above the limit
splits on one more bit of the hash prefix, all others stay as they are. Sizes of all prefixes come from one
aggregate of several bits at a time, whose rows are bounded by the prefixes that are still too large, and
further rounds read only documents in these. A bucket that no bit can split holds copies of one document; its
copies are counted, and dealt by number into as many pages as the limit asks for."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialize

HASH_BITS = 60
LIMIT_BYTES = 64 << 20
#: Most bits that one round adds, so its table has at most 2**16 rows for each bucket to be split.
ROUND_BITS = 16


def document_hash() -> F.Column:
    key = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _prefix(bits, of: int = HASH_BITS, column: str = "h") -> F.Column:
    return F.expr(f"shiftright({column}, {of} - {bits})")


def directory(hashes: DataFrame, limit: int, bits: int) -> DataFrame:
    """Buckets (depth, prefix, shard_bytes, shard_rows, last) of rows (h, bytes): none above the limit but those
    that hold one hash only (``last``)."""
    rest, depth, found = hashes, 0, None
    while True:
        step = min(bits, HASH_BITS - depth)
        low = depth + step
        sums = rest.groupBy(_prefix(low).alias("p")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("h").alias("a"), F.max("h").alias("b")
        )
        sums = materialize(sums, "prefixes")
        levels = sums.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(low))))
        nodes = levels.groupBy("depth", F.expr(f"shiftright(p, {low} - depth)").alias("prefix")).agg(
            F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"), F.min("a").alias("a"), F.max("b").alias("b")
        )
        nodes = materialize(nodes.withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("a") == F.col("b"))), "nodes")
        above = nodes.where("not fits").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        leaves = nodes.where("fits").join(above, (nodes.depth == above.depth) & (F.expr("shiftright(prefix, 1)") == above.parent), "left_semi")
        if depth == 0:
            leaves = leaves.union(nodes.where("fits and depth = 0"))
        leaves = leaves.select("depth", "prefix", "shard_bytes", "shard_rows", (F.col("a") == F.col("b")).alias("last"))
        found = leaves if found is None else found.union(leaves)
        large = nodes.where((F.col("depth") == low) & ~F.col("fits")).select(F.col("prefix").alias("open"))
        if large.isEmpty():
            return materialize(found, "directory")
        rest = materialize(rest.join(large, _prefix(low) == F.col("open"), "left_semi"), "rest")
        depth = low


def shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) with doc_bytes, shard, depth, shard_bytes and shard_rows added.

    ``shard`` spells the bits of the bucket's prefix, with depth as their number; a page of a bucket of copies adds a
    dash and its number. ``doc_bytes`` counts UTF-8 bytes of the text, null texts have none. Every shard has
    at most ``limit`` bytes unless it holds a single document that is larger by itself. A null doc_id counts as an
    empty one; rows that agree in doc_id and text are copies. An empty table has no shards. Columns of the input
    with one of the added names are replaced."""
    added = ("doc_bytes", "shard", "depth", "shard_bytes", "shard_rows")
    docs = docs.drop(*added)
    columns = docs.columns
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    hashes = materialize(docs.select(document_hash().alias("h"), size.alias("bytes")), "hashes")
    total = hashes.agg(F.sum("bytes")).first()[0] or 0
    bits = min(ROUND_BITS, max(4, math.ceil(math.log2(total / limit + 1)) + 2))
    buckets = directory(hashes, limit, bits)

    # Each entry of the first ``bits`` bits lists the buckets it leads to: one, or those that split it further.
    spread = F.expr(f"sequence(shiftleft(prefix, greatest({bits} - depth, 0)), shiftleft(prefix + 1, greatest({bits} - depth, 0)) - 1)")
    entry = F.when(F.col("depth") <= bits, spread).otherwise(F.array(F.expr(f"shiftright(prefix, greatest(depth - {bits}, 0))")))
    entries = buckets.withColumn("entry", F.explode(entry)).groupBy("entry").agg(
        F.collect_list(F.struct("depth", "prefix", "shard_bytes", "shard_rows", "last")).alias("buckets")
    )
    held = docs.withColumn("doc_bytes", size).withColumn("_h", document_hash())
    held = held.join(entries, _prefix(bits, column="_h") == F.col("entry"))
    own = F.filter("buckets", lambda x: F.expr("_h").isNotNull() & (F.call_function("shiftright", F.col("_h"), (F.lit(HASH_BITS) - x["depth"]).cast("int")) == x["prefix"]))
    held = held.withColumn("_own", F.element_at(own, 1))
    name = F.when(F.col("_own.depth") > 0, F.lpad(F.bin("_own.prefix"), F.col("_own.depth"), F.lit("0"))).otherwise(F.lit(""))
    held = held.withColumn("shard", name).withColumn("depth", F.col("_own.depth").cast("int"))
    crowded = f"_own.last and _own.shard_bytes > {limit} and _own.shard_rows > 1"
    plain = held.where(f"not ({crowded})").select(*columns, "doc_bytes", "shard", "depth", F.col("_own.shard_bytes").alias("shard_bytes"), F.col("_own.shard_rows").alias("shard_rows"))
    if buckets.where(f"last and shard_bytes > {limit} and shard_rows > 1").isEmpty():
        return plain
    copies = held.where(crowded).groupBy(*columns, "doc_bytes", "shard", "depth").agg(F.count("*").alias("_n"))
    # Copies may differ in further columns: each kind takes pages of its own.
    kind = F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 16)
    fit = F.greatest(F.floor(F.lit(limit) / F.col("doc_bytes")), F.lit(1))
    paged = copies.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1))).withColumn("_page", F.floor(F.col("_i") / fit))
    rows = F.least(fit, F.col("_n") - F.col("_page") * fit).cast("bigint")
    paged = paged.select(
        *columns, "doc_bytes", F.concat_ws("-", "shard", kind, F.col("_page").cast("string")).alias("shard"), "depth",
        (rows * F.col("doc_bytes")).alias("shard_bytes"), rows.alias("shard_rows"),
    )
    return plain.union(paged)


def oracle(limit: int) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS doc_bytes,
         ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), '/', coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), p AS (
  SELECT g.depth, h >> ({HASH_BITS} - g.depth) AS prefix, sum(doc_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows,
         sum(doc_bytes) <= {limit} OR min(h) = max(h) AS fits
  FROM d, (SELECT unnest(range(0, 41)) AS depth) g GROUP BY ALL
), leaf AS (
  SELECT p.* FROM p WHERE fits AND (depth = 0 OR EXISTS (SELECT 1 FROM p q WHERE q.depth = p.depth - 1 AND q.prefix = p.prefix >> 1 AND NOT q.fits))
)
SELECT doc_id, doc_bytes,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard,
       depth::INTEGER AS depth, shard_bytes, shard_rows
FROM d JOIN leaf ON d.h >> ({HASH_BITS} - leaf.depth) = leaf.prefix
"""
