"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import pathlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sangam.session import fresh_path, remove, shuffles_freed

#: Words are runs of anything but the blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    Executors elsewhere need it installed, or sent with ``addPyFile``.
    """
    root = str(pathlib.Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of texts that tasks hand to Python, unless the session sets a bound of its own.

    Spark's default of 64 MB is held several times at once, on both sides of each of an executor's tasks.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, "4m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows, and bytes unless one row has more, that are turned into Python objects at a time.
ROWS_AT_A_TIME = 1000
BYTES_AT_A_TIME = 1 << 22


def small_slices(batch: pa.RecordBatch):
    """Slices of a batch, in order, of at most ``ROWS_AT_A_TIME`` rows and, but for single rows, ``BYTES_AT_A_TIME``."""
    if batch.num_rows > 1 and (batch.num_rows > ROWS_AT_A_TIME or batch.nbytes > BYTES_AT_A_TIME):
        half = batch.num_rows // 2
        yield from small_slices(batch.slice(0, half))
        yield from small_slices(batch.slice(half))
    elif batch.num_rows:
        yield batch


def give_back() -> None:
    """Return memory that this Python worker has freed to the system; idle workers are kept for a minute, beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Scratch:
    """Tables of one operator call, written as Parquet below one folder of the shared work folder.

    A written table cuts the lineage: a lost executor costs the tasks it ran, not the
    steps before. ``drop`` removes a table that later steps don't read; the rest goes
    with the session's work folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        find_package(spark)
        small_batches(spark)
        self.spark = spark
        self.root = fresh_path(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.root}/{name}")


def arrow_rows(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` takes an Arrow batch as ``small_slices`` cuts it and returns a dict of columns, or None for no rows.

    Partitions stay as they are; state lives no longer than a batch. Batches as Spark makes them may hold tens of MB of
    text, of which Python objects should be made a little at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    find_package(df.sparkSession)
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)

    def batches(incoming):
        batch = columns = arrays = None
        for batch in (part for whole in incoming for part in small_slices(whole)):
            columns = function(batch)
            if columns is not None:
                arrays = [
                    c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in arrow
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        del batch, columns, arrays
        give_back()

    return df.mapInArrow(batches, parsed)


#: Bits of a membership map: 8 MB, whatever the number of values.
MAP_BITS = 1 << 26
_ROW_BITS = 1 << 15


def membership(values: DataFrame):
    """A broadcast map of bits, one set per value of the only column, a long that is spread evenly in its low bits.

    ``may_hold`` tells of longs whether they may be among the values. The map is of fixed size: with
    very many values it holds too much and spares less work, but never leaves one out.
    """
    (name,) = values.columns
    place = F.col(name).bitwiseAND(MAP_BITS - 1)
    rows = values.filter(F.col(name).isNotNull()).groupBy(F.floor(place / _ROW_BITS).cast("int").alias("row"))
    rows = rows.agg(F.bitmap_construct_agg((place % _ROW_BITS)).alias("bits")).collect()
    bits = bytearray(MAP_BITS // 8)
    for row in rows:
        at = row["row"] * _ROW_BITS // 8
        bits[at : at + _ROW_BITS // 8] = row["bits"]
    return values.sparkSession.sparkContext.broadcast(bytes(bits))


def may_hold(bits: bytes, values: np.ndarray) -> np.ndarray:
    place = values.astype(np.int64) & (MAP_BITS - 1)
    return (np.frombuffer(bits, dtype=np.uint8)[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
