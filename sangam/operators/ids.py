"""Dense running ids in load order."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..schema import LOADED
from ..session import staged

ID_BUCKET_ROWS = 1 << 18
#: Mark of an order column, in its metadata, whose values follow one another without a gap in each bucket, as readers number rows.
GAPLESS = "gapless"
#: Starts of so many buckets are broadcast, of more joined by a shuffle.
MOST_BROADCAST = 1 << 18


def gapless(df: DataFrame, name: str = "pos", marked: bool = True) -> DataFrame:
    """``df`` with column ``name`` marked as gapless, or not."""
    return df.withMetadata(name, {GAPLESS: marked})


def is_gapless(df: DataFrame, name: str = "pos") -> bool:
    return bool((df.schema[name].metadata or {}).get(GAPLESS))


def bucket_starts(counts: DataFrame, bucket: list[str]) -> DataFrame:
    """Rows before each bucket, ``_start``, for one row per bucket with its rows ``_n``.

    A tree of running totals: buckets are dealt in order to tasks, each task sums along its own, and
    only one total per task goes through the driver, however many buckets there are. Other columns of ``counts`` stay.
    """
    part = counts.repartitionByRange(*bucket).sortWithinPartitions(*bucket).withColumn("_part", F.spark_partition_id())

    def summed(batches):
        total = 0
        for batch in batches:
            n = batch.column("_n")
            ends = pc.add(pc.cumulative_sum(n), total)
            total = ends[-1].as_py() if len(n) else total
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.subtract(ends, n)], names=[*batch.schema.names, "_start"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.schema)
    sums = staged(part.mapInArrow(summed, f"{types}, _start bigint"), "bucket-starts")
    before, total = [], 0
    for row in sums.groupBy("_part").agg(F.sum("_n").alias("n")).orderBy("_part").collect():
        before.append((row["_part"], total))
        total += row["n"]
    parts = F.broadcast(counts.sparkSession.createDataFrame(before, "_part int, _before bigint"))
    others = [c for c in counts.columns if c not in ("_n", *bucket)]
    return sums.join(parts, "_part").select(*bucket, *others, (F.col("_start") + F.col("_before")).alias("_start"))


def dense_ids(
    df: DataFrame, bucket: list[str], within: list[str], name: str = "sentence_id"
) -> DataFrame:
    """Number all rows 0, 1, 2 ... by (``bucket``, ``within``), without a global sort.

    Rows are counted per bucket, ``bucket_starts`` gives each bucket its first id, and rows are ranked inside their
    bucket.  The join and the ranking share one shuffle by bucket.  The order
    must be unique and its columns not null. Runs jobs when called.

    If ``within`` is one column marked as ``gapless``, and the counts bear it out, a row's place in its bucket is its value less the
    bucket's smallest: then no row is shuffled.
    """
    count = F.count(F.lit(1)).alias("_n")
    if len(within) == 1 and is_gapless(df, within[0]):
        place = F.col(within[0])
        counts = df.groupBy(*bucket).agg(count, F.min(place).alias("_first"), F.max(place).alias("_last"), F.sum(place).alias("_sum"))
        even = (F.col("_last") - F.col("_first") + 1 == F.col("_n")) & (2 * F.col("_sum") == F.col("_n") * (F.col("_first") + F.col("_last")))
        starts = bucket_starts(counts.select(*bucket, "_n", "_first", even.alias("_even")), bucket)
        if starts.filter("not coalesce(_even, false)").isEmpty():
            few = starts.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
            placed = df.join(F.broadcast(starts) if few else starts, bucket)
            return placed.withColumn(name, F.col("_start") + place - F.col("_first")).drop("_start", "_first", "_even")
        starts = starts.select(*bucket, "_start")
    else:
        starts = bucket_starts(df.groupBy(*bucket).agg(count), bucket)
    rank = F.row_number().over(Window.partitionBy(*bucket).orderBy(*within))
    ranked = df.withColumn("_rank", rank).join(starts, bucket)
    return ranked.withColumn(name, F.col("_start") + F.col("_rank") - 1).drop("_start", "_rank")


def renumber(df: DataFrame, bucket_rows: int = ID_BUCKET_ROWS) -> DataFrame:
    """Close the gaps in ``sentence_id`` that dropped rows left, keeping the order."""
    bucketed = df.withColumn("_bucket", F.floor(F.col("sentence_id") / bucket_rows))
    renamed = bucketed.withColumnRenamed("sentence_id", "_old")
    return dense_ids(renamed, ["_bucket"], ["_old"]).select(*df.columns)


def in_load_order(*frames: DataFrame) -> DataFrame:
    """Union of reader results; rows of an earlier frame come first. ``pos`` is ``gapless`` if it is in all of them."""
    ranked = [
        f.select(*LOADED.fieldNames()).withColumn(
            "rank", F.lit(i << 32).cast("bigint") + F.col("rank")
        )
        for i, f in enumerate(frames)
    ]
    return gapless(reduce(DataFrame.unionByName, ranked), marked=all(map(is_gapless, frames)))


def unify(*frames: DataFrame) -> DataFrame:
    """One sentence table of all frames with running ids in load order."""
    numbered = dense_ids(in_load_order(*frames), ["rank", "file", "block"], ["pos"])
    return numbered.select("sentence_id", "source", "split", "text", "tokens", "lid_tags")
