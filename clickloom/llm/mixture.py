"""Mixing sources to target weights by capped water-filling.

All sources share the words of the corpus by weight. A source may be repeated ``epochs`` times at most; what is
above that is shared again by weight among the others, until none is above. In order of cap by weight
the sources that end at their cap come first, so running sums over one row for each source find
the level directly. A source then gives whole repetitions of all its documents and a fraction of one more:
the documents whose seeded hash lies at or below a threshold.

The threshold comes from sums, not from a sort of documents: words by source and slice of the hash, then by
single hash value within the one slice that the fraction ends in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import WORD
from clickloom.session import materialize

#: Slices of the 60-bit hash for each source.
SLICE_BITS = 12
#: Sources whose plan, one row each, is broadcast; beyond it the plan is repeated for each salt of a plain join.
BROADCAST_SOURCES, SALTS = 100_000, 64
_HASH_BITS = 60


def seeded(seed: int) -> F.Column:
    """60 bits of a hash of the seed and the document, the same in each run."""
    key = F.concat_ws("/", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, _HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """(source, source_size) with target added. Weights repeat over the sources by code point, null last."""
    whole = Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    order = whole.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    exact = lambda x: x.cast("decimal(38,0)")
    filled = (
        sizes.withColumn("weight", w).withColumn("cap", epochs * F.col("source_size"))
        .withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("capped", exact(F.col("cap")) * F.col("open") <= exact(F.col("rest")) * F.col("weight"))
        .withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0)))
        .withColumn("open", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole))
    )
    level = F.col("weight").cast("double") * F.col("rest").cast("double") / F.col("open").cast("double")
    return filled.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, ...) with size, source_size, target, repeats and taken added.

    ``size`` counts words, null texts have none. ``repeats`` says how often the mix has the document, and taken is
    size times that. A source's taken words differ from its target by half a document at most, the one
    at which the fraction ends. Rows that agree in doc_id and text stand or fall together. Null is a source of
    its own; sources without words have target 0 and their documents repeat 0 times. Columns of the input with one of
    the added names are replaced."""
    added = ("size", "source_size", "target", "repeats", "taken")
    docs = docs.drop(*added)
    sized = docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")).withColumn("_u", seeded(seed))
    slim = materialize(sized.select("source", "size", F.col("_u").alias("u")), "sizes")
    wanted = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    wanted = wanted.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    wanted = materialize(wanted, "targets")

    piece = F.shiftrightunsigned("u", _HASH_BITS - SLICE_BITS)
    slices = slim.groupBy("source", piece.alias("piece")).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)))
    named = wanted.withColumnRenamed("source", "of_source")
    slices = slices.join(named, F.col("source").eqNullSafe(F.col("of_source")))
    ends = slices.where("below < part and part <= below + words").groupBy("of_source", "part").agg(F.min("piece").alias("at_piece"), F.min("below").alias("at_below"))
    inside = slim.join(ends, F.col("source").eqNullSafe(F.col("of_source")) & (piece == F.col("at_piece")))
    values = inside.groupBy("of_source", "u", "part", "at_below").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("of_source").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("below", F.col("at_below") + F.coalesce(F.sum("words").over(before), F.lit(0)))
    taken = values.where(F.col("below") + F.col("words") / 2 <= F.col("part")).groupBy("of_source").agg(F.max("u").alias("last"))
    start = F.shiftleft("at_piece", _HASH_BITS - SLICE_BITS) - 1
    limits = ends.select("of_source", start.alias("start")).join(taken.withColumnRenamed("of_source", "t"), F.col("of_source").eqNullSafe(F.col("t")), "left")
    limits = limits.select(F.col("of_source").alias("l"), F.coalesce("last", "start").alias("last"))
    plan = named.join(limits, F.col("of_source").eqNullSafe(F.col("l")), "left")
    plan = plan.select("of_source", "source_size", "target", "whole", F.coalesce("last", F.lit(-1)).alias("last"))

    plan = materialize(plan, "plan")
    if plan.count() <= BROADCAST_SOURCES:
        out = sized.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of_source")))
    else:  # a source's documents go to as many tasks as there are salts
        plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = sized.join(plan, F.col("source").eqNullSafe(F.col("of_source")) & (F.pmod("_u", F.lit(SALTS)) == F.col("salt")))
    repeats = F.when(F.col("source_size") > 0, F.col("whole") + F.when(F.col("_u") <= F.col("last"), 1).otherwise(0)).otherwise(0)
    out = out.withColumn("repeats", repeats.cast("int")).withColumn("taken", F.col("size") * F.col("repeats"))
    return out.select(*docs.columns, *added)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat('42/', coalesce(doc_id::VARCHAR, ''), '/', coalesce(text, ''))), 1, 15))::BIGINT AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS source_size, 3 * sum(size)::HUGEINT AS cap,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::HUGEINT AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST) AS k FROM s
), c AS (
  SELECT a.*, a.cap * (SELECT sum(weight) FROM o b WHERE b.k >= a.k)
              <= a.weight * ((SELECT sum(source_size) FROM o) - coalesce((SELECT sum(cap) FROM o b WHERE b.k < a.k), 0)) AS capped
  FROM o a
), t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE weight::DOUBLE * ((SELECT sum(source_size) FROM c) - coalesce((SELECT sum(cap) FROM c WHERE capped), 0))::DOUBLE
                   / (SELECT sum(weight) FROM c WHERE NOT capped)::DOUBLE END AS target
  FROM c
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u RANGE UNBOUNDED PRECEDING) AS up_to,
         sum(d.size) OVER (PARTITION BY d.source, d.u) AS own
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN source_size > 0 AND up_to - own + own / 2 <= target - whole * source_size
                              AND target - whole * source_size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
