"""Exact de-duplication of batches against immutable snapshots, screened by binary fuse filters.

Each batch that was taken in is a snapshot. For each part of the digest space it keeps one filter over
the digests of its distinct texts, built once. A new batch is first grouped by itself, with copies combined before the
shuffle; then one digest of each class is screened by the filters of all earlier snapshots, part by part. Only
texts whose digest some filter holds, or that the batch has twice, are read again. These are grouped by digest
and whole text, which is the byte check; everything else is new without another look."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import GAP
from clickloom.llm.fuse_filter import FuseFilter
from clickloom.session import materialize

#: Distinct digests that one filter holds on average.
PART_KEYS = 1 << 17
#: Largest number of digests of repeated texts whose filters, nine bits a digest, are broadcast, so that
#: the other texts need not be shuffled. Beyond it all texts meet the digests in a plain join.
BROADCAST_KEYS = 1 << 24

_FILTER = "snapshot int, part bigint, seed int, segment int, segments int, prints binary"


def normalised(text) -> F.Column:
    """White-space runs as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def _build(rows: pa.Table) -> pa.Table:
    out = FuseFilter.build(rows.column("digest").to_numpy().view(np.uint64))
    values = [rows.column("batch")[0].as_py(), rows.column("part")[0].as_py(), out.seed, out.segment, out.segments, out.prints.tobytes()]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = ["snapshot", "part", "seed", "segment", "segments", "prints"]
    return pa.table({name: pa.array([value], kind) for name, value, kind in zip(names, values, kinds, strict=True)})


def build_filters(classes: DataFrame) -> DataFrame:
    """One row for each snapshot and part of the digest space."""
    return classes.select("batch", "part", "digest").groupBy("batch", "part").applyInArrow(_build, _FILTER)


def _screen(classes: pa.Table, filters: pa.Table) -> pa.Table:
    digests = classes.column("digest").to_numpy()
    batches = classes.column("batch").to_numpy()
    held = np.zeros(len(digests), bool)
    for row in filters.to_pylist():
        one = FuseFilter(row["seed"], row["segment"], row["segments"], np.frombuffer(row["prints"], np.uint8))
        held |= (batches > row["snapshot"]) & one.holds(digests.view(np.uint64))
    return pa.table({"digest": pa.array(digests[held])})


def screen(classes: DataFrame, filters: DataFrame) -> DataFrame:
    """Digests of classes that a filter of an earlier snapshot holds."""
    rows = classes.select("batch", "part", "digest")
    return rows.groupBy("part").cogroup(filters.groupBy("part")).applyInArrow(_screen, "digest bigint")


def _only_held(df: DataFrame, digests: DataFrame) -> DataFrame:
    """Rows of ``df`` that can have one of these digests, by filters that tasks build part by part."""
    if (n := digests.count()) > BROADCAST_KEYS:
        return df
    parts = n // PART_KEYS + 1
    keys = digests.select(F.lit(0).alias("batch"), F.pmod("digest", F.lit(parts)).alias("part"), "digest")
    filters = {
        row.part: FuseFilter(row.seed, row.segment, row.segments, np.frombuffer(row.prints, np.uint8))
        for row in build_filters(keys).collect()
    }
    shared = df.sparkSession.sparkContext.broadcast(filters)

    @F.pandas_udf("boolean")
    def held(digest: pd.Series) -> pd.Series:
        values = digest.to_numpy()
        part = np.mod(values, parts)
        out = np.zeros(len(values), bool)
        for k, one in shared.value.items():
            at = np.flatnonzero(part == k)
            out[at] = one.holds(values[at].view(np.uint64))
        return pd.Series(out)

    return df.where(held("digest"))


def exact_duplicates(docs: DataFrame, batch=None) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one for each row of ``docs`` (doc_id, text).

    ``batch`` is a column expression that numbers the batches in order of arrival, from 0. By default there
    are three, by a hash of doc_id. Texts are equal when they are identical, byte for byte, after white-space runs
    became one space; null counts as empty. Of equal texts the smallest doc_id stays, null ones last.
    Rows with the same doc_id are one document: they are counted each and kept or dropped together.
    The result does not depend on how rows are split into batches. Further columns are ignored."""
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(3)) if batch is None else batch
    text = normalised(F.col("text"))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), batch.cast("int").alias("batch"), text.alias("text"))
    source = source.withColumn("digest", F.xxhash64("text"))
    rows = materialize(source.select("doc_id", "batch", "digest", F.sha2("text", 256).alias("text_sha256")), "digests")
    classes = rows.groupBy("batch", "digest").agg(F.count("*").alias("n"))
    parts = rows.count() // PART_KEYS + 1
    classes = materialize(classes.withColumn("part", F.pmod(F.col("digest"), F.lit(parts))), "classes")
    filters = materialize(build_filters(classes), "filters")
    again = screen(classes.where("batch > 0"), filters).union(classes.where("n > 1").select("digest"))
    again = materialize(again.distinct(), "suspects")

    suspects = _only_held(source.select("doc_id", "digest", "text"), again).join(again, "digest")
    buckets = suspects.groupBy("digest", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    buckets = buckets.select(F.sha2("text", 256).alias("sum"), "keep_id", "group_size")
    out = rows.join(buckets, rows.text_sha256 == buckets["sum"], "left")
    alone = F.col("group_size").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
