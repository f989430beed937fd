"""Outputs of a finished sentence table and the check that they exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.arrays import array_to_text, text_to_array
from ..schema import FINAL
from .reports import script_pivot, summary

OUTPUTS = ("dataset.parquet", "dataset.csv", "summary.csv", "script_pivot.csv")
CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": '""'}
ARRAYS = ("tokens", "lid_tags")


def write_parquet(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """Parquet with array columns as they are.

    With ``partition_by``, rows are first rebalanced on those columns: small partitions
    get one file rather than one per task, large ones as many as their size asks for.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FINAL).parquet(path).select(*FINAL.fieldNames())


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; CSV has no arrays, so they are written as JSON."""
    flat = df.withColumns({c: array_to_text(F.col(c)) for c in ARRAYS if c in df.columns})
    flat.write.mode(mode).options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write_csv`` wrote."""
    flat = ", ".join(
        f"{f.name} {'string' if f.name in ARRAYS else f.dataType.simpleString()}" for f in FINAL
    )
    rows = spark.read.schema(flat).options(header=True, quote='"', escape='"').csv(path)
    return rows.withColumns({c: text_to_array(F.col(c)) for c in ARRAYS})


def write_small_csv(df: DataFrame, path: str, *order: str) -> None:
    """A report, one row per source or so, as a single sorted file."""
    one = df.repartition(1).sortWithinPartitions(*order)
    one.write.mode("overwrite").option("header", True).csv(path)


def write_outputs(df: DataFrame, folder: str, partition_by=()) -> DataFrame:
    """Write all outputs below ``folder`` and return the written dataset.

    Everything after the Parquet files is made from them, so ``df`` is computed once.
    """
    spark = df.sparkSession
    write_parquet(df, f"{folder}/dataset.parquet", partition_by)
    written = spark.read.schema(df.schema).parquet(f"{folder}/dataset.parquet")
    write_csv(written, f"{folder}/dataset.csv")
    write_small_csv(summary(written), f"{folder}/summary.csv", "source", "split")
    write_small_csv(script_pivot(written), f"{folder}/script_pivot.csv", "source")
    return written


def outputs_check(spark: SparkSession, folder: str, names=OUTPUTS) -> DataFrame:
    """Bytes and status of each expected output, from the file listing alone."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            F.substring_index("path", "/", -1).alias("file"),
            "path",
            "length",
        )
        .filter(~F.col("file").startswith("_"))
    )
    named = F.coalesce(*[F.when(F.col("path").contains(f"/{n}/"), n) for n in names])
    sizes = listed.groupBy(named.alias("name")).agg(F.sum("length").alias("bytes"))
    expected = spark.createDataFrame([(n,) for n in names], "name string")
    return (
        expected.join(sizes, "name", "left")
        .na.fill({"bytes": 0})
        .withColumn("status", F.when(F.col("bytes") > 0, "ok").otherwise("missing_or_empty"))
    )
