"""Proportional stratified interleaving: every shard holds every source in its share.

Rows of a source are put in a seeded random order; the row of rank r among n has the fractional
rank (2 r - 1) / (2 n). Sorted by it, all sources run through the order evenly, so any
stretch of it has the mixture of the whole; the order is cut into stretches of equal row counts.

Neither order is ever sorted in one task. Rows are dealt into stretches by cut points sampled from the whole order,
ties and all, so neither a large source nor many small ones, whose rows share a few fractional ranks, nor equal
keys fill one stretch; places are the counts of earlier stretches plus the rank within.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sangam.operators.ids import bucket_starts

from .common import Scratch, table

#: Rows that a stretch of an order has on average; a task sorts one at a time.
BUCKET_ROWS = 1 << 14


def seeded_hash(seed: int, key: Column) -> Column:
    """32 hexadecimal digits, the same in any engine; null keys have the hash of the seed alone."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))


def _in_order(rows: DataFrame, order: list[str], total: int, scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``__place``, their place from 0 in the order, which must have no ties.

    Cut points from a sample of the rows deal them out in stretches, so many equal values of the first columns
    are parted by the later ones. Each stretch is sorted by itself; the rows of earlier ones come from their counts.
    """
    parts = max(1, -(-total // BUCKET_ROWS))
    dealt = rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    dealt = scratch.keep(dealt, name)
    counts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("_n"))
    starts = scratch.keep(bucket_starts(counts, ["__part"]), f"{name}-starts")
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    ranked = dealt.withColumn("__rank", rank).join(starts, "__part")
    return ranked.withColumn("__place", F.col("_start") + F.col("__rank") - 1).drop("__part", "__rank", "_start")


def stratified_shards(
    rows: DataFrame, shards: int = 8, key: str = "doc_id", source: str = "source", seed: int = 17
) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Row counts of shards differ by one at most. A source's counts in two shards differ by its
    share of the rows times the number of sources, plus one, at most, whatever its size. Null sources are a source
    of their own; null keys and repeated rows are rows like others, in an order by the digest of all their columns
    among rows with equal keys; an empty table gives an empty result. Columns ``shard`` and ``slot`` are replaced.
    All columns travel with the row: drop what the shards don't need.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    scratch = Scratch(rows.sparkSession, "shards")
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    hashed = rows.select(
        F.struct(*kept).alias("__row"),
        F.col(source).cast("string").alias("__source"),
        seeded_hash(seed, F.col(key)).alias("__hash"),
        F.md5(F.to_json(F.struct(*kept)).cast("binary")).alias("__tie"),
        # tells apart rows that are equal in everything; once written it stays
        F.monotonically_increasing_id().alias("__id"),
    )
    hashed = scratch.keep(hashed, "hashed")
    total = hashed.count()
    ties = ["__hash", "__tie", "__id"]
    # rank within the source: its rows follow one another
    placed = scratch.keep(_in_order(hashed, ["__source", *ties], total, scratch, "by-source"), "placed")
    scratch.drop("hashed", "by-source")
    firsts = placed.groupBy("__source").agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n"))
    firsts = scratch.keep(firsts.withColumnRenamed("__source", "__s"), "firsts")
    ranked = placed.join(firsts, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s")
    ranked = ranked.withColumn("__fraction", (2 * (F.col("__place") - F.col("__first")) + 1) / (2 * F.col("__n")))
    ranked = ranked.select("__row", "__source", "__fraction", *ties)
    # place in the order by fractional rank
    placed = _in_order(ranked, ["__fraction", "__source", *ties], total, scratch, "by-fraction")
    placed = placed.withColumn("shard", F.expr(f"cast((__place * {shards}) div {max(total, 1)} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return placed.select("__row.*", "shard", (F.col("__place") - first).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write shards as folders ``shard=<n>``, rows of a shard in the order of their slots per file."""
    parts = F.floor(F.col("slot") / F.lit(BUCKET_ROWS * 16))
    sharded.repartition("shard", parts).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    return stratified_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
