"""Counts, percents, summaries and examples.

Grouping columns here have few values and the aggregates are combined ahead of
the shuffle, so one dominant source or label costs no more than an even spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import percent, round1, text_bar
from ..schema import SCRIPT_TYPES, SPLITS

TOTAL = "TOTAL"
#: Values kept in a quantile sketch, and how far off a median read from it may be, as a share of the rows.
SKETCH_SIZE, SKETCH_ERROR = 200, 0.0166
#: Five standard errors of the sketch of distinct ids.
SKETCHED_IDS_ERROR = 0.1
#: Ids in a range of 2^15 from which on its bitmap is smaller than they are.
LEAST_PER_RANGE = 512


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def ordered_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Counts in descending order, ties by the columns themselves."""
    return counts_by(df, *columns).orderBy(F.desc("n"), *columns)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count, percent of all rows and a text bar per value; nulls are left out of
    the rows but count towards the whole."""
    counts = counts_by(df, column)
    pct = percent(F.col("n"), F.sum("n").over(Window.partitionBy()))
    return (
        counts.withColumn("pct", pct)
        .filter(F.col(column).isNotNull())
        .withColumn("bar", text_bar(F.col("pct")))
        .orderBy(F.desc("n"), column)
    )


def wide_counts(df: DataFrame, key: str, column: str, values) -> DataFrame:
    """One row per ``key`` and one count column per listed value, zero where none occur."""
    return df.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def script_pivot(df: DataFrame) -> DataFrame:
    """Sentence counts by source and script type, all four types as columns."""
    return wide_counts(df, "source", "script_type", SCRIPT_TYPES)


def script_by_split(df: DataFrame) -> DataFrame:
    return wide_counts(df, "script_type", "split", SPLITS)


def source_by_split(df: DataFrame) -> DataFrame:
    """Count and percent within the source for each of the three splits, also if zero."""
    per_source = df.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS],
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("n")) for s in SPLITS])
    )
    return (
        per_source.select("source", "total", pairs.alias("p"))
        .select("source", "p.split", "p.n", "total")
        .withColumn("pct", percent(F.col("n"), F.col("total")))
        .drop("total")
    )


def load_counts(df: DataFrame) -> DataFrame:
    """Counts per source and split, per source, and overall; null marks a total."""
    cells = counts_by(df, "source", "split")
    return cells.rollup("source", "split").agg(
        F.sum("n").alias("n"), F.grouping_id().cast("bigint").alias("level")
    )


def summary(df: DataFrame) -> DataFrame:
    """Sentence count and mean token count per source and split, plus a TOTAL row
    per source, sorted.  Rows without a split count in the total only.

    The rows are aggregated once; totals come from the small table of cells.
    """
    cells = df.groupBy("source", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("tokens").cast("bigint")).alias("tokens")
    )
    both = cells.groupingSets(
        [[F.col("source"), F.col("split")], [F.col("source")]], "source", "split"
    ).agg(
        F.sum("n").alias("n"), F.sum("tokens").alias("tokens"), F.grouping("split").alias("total")
    )
    return (
        both.filter((F.col("total") == 1) | F.col("split").isNotNull())
        .select(
            "source",
            F.when(F.col("total") == 1, TOTAL).otherwise(F.col("split")).alias("split"),
            F.col("n").alias("sentence_count"),
            round1(F.col("tokens") / F.col("n")).alias("avg_length"),
        )
        .orderBy("source", "split")
    )


def length_stats(df: DataFrame) -> DataFrame:
    """Min, max, mean and exact median of the token count, from its histogram."""
    lengths = df.groupBy(F.size("tokens").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    return lengths.agg(
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        (F.sum(F.col("length") * F.col("n")) / F.sum("n")).alias("mean_length"),
        F.percentile("length", F.lit(0.5), F.col("n")).alias("median_length"),
    )


def length_sketches(df: DataFrame, *by: str) -> DataFrame:
    """Row count and quantile sketch of the token count for each value of ``by``; sketches can be stored and merged.

    A sketch holds some hundred values however many rows it saw. Quantiles read from it are off by
    ``SKETCH_ERROR`` of the rows at most, in rank, in 99 of 100 cases, also after merging.
    """
    length = F.size("tokens").cast("bigint")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(length, SKETCH_SIZE).alias("sketch"))


def sketched_medians(sketches: DataFrame, *by: str) -> DataFrame:
    """Approximate median per value of ``by`` from ``length_sketches``, merging those of finer groups."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return merged.withColumn("median_length", F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5))).drop("sketch")


def tag_vocab(df: DataFrame) -> DataFrame:
    """Distinct tags, sorted."""
    return df.select(F.explode(F.array_distinct("lid_tags")).alias("tag")).distinct().orderBy("tag")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def _id_facts(df: DataFrame, value: Column) -> dict:
    """Rows, ids that aren't null, null texts, and sketched: distinct ids, and ranges of 2^15 ids summed over tasks."""
    no_text = F.col("text").isNull() if "text" in df.columns else F.lit(False)
    seen = F.xxhash64(F.spark_partition_id(), F.bitmap_bucket_number(value))
    rows = df.select(value.alias("id"), no_text.alias("no_text"), F.when(value.isNotNull(), seen).alias("seen"))
    facts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("id").alias("n"),
        F.count_if("no_text").alias("null_texts"),
        F.hll_sketch_estimate(F.hll_sketch_agg("id")).alias("ids"),
        F.hll_sketch_estimate(F.hll_sketch_agg("seen")).alias("ranges"),
    )
    return {name: found or 0 for name, found in facts.first().asDict().items()}


def _distinct_ids(df: DataFrame, value: Column, facts: dict) -> DataFrame:
    """One row with the number of distinct ids as ``n_ids``.

    If the ids of a task lie as densely as running numbers do, it sends a bitmap for each range it saw, and no id is
    shuffled; if bitmaps would be larger than the ids they stand for, the ids are grouped.
    """
    known = df.filter(value.isNotNull())
    if facts["n"] >= LEAST_PER_RANGE * facts["ranges"]:
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(value))
        ids = known.groupBy(F.bitmap_bucket_number(value).alias("range")).agg(F.bitmap_count(bits).alias("n"))
    else:
        ids = known.groupBy(value.alias("id")).agg(F.lit(1).cast("bigint").alias("n"))
    return ids.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_ids"))


def ids_unique(df: DataFrame, column: str = "sentence_id") -> DataFrame:
    """One row: n_rows and ids_unique, whether every row has an id of its own.

    A sketch of the ids comes first: if it lies so far below the rows that some must be repeated, that is the
    answer. Else they are counted exactly. Runs a job when called.
    """
    value = F.col(column)
    facts = _id_facts(df, value)
    n_rows = F.lit(facts["n_rows"]).cast("bigint")
    if facts["n"] < facts["n_rows"] or facts["ids"] < (1 - SKETCHED_IDS_ERROR) * facts["n"]:
        return df.sparkSession.range(1).select(n_rows.alias("n_rows"), F.lit(False).alias("ids_unique"))
    return _distinct_ids(df, value, facts).select(n_rows.alias("n_rows"), (F.col("n_ids") == n_rows).alias("ids_unique"))


def id_null_checks(df: DataFrame) -> DataFrame:
    """Row count, distinct ids and null texts in one row, all exact. Runs a job when called."""
    facts = _id_facts(df, F.col("sentence_id"))
    counts = {name: F.lit(facts[name]).cast("bigint") for name in ("n_rows", "null_texts")}
    return _distinct_ids(df, F.col("sentence_id"), facts).select(
        counts["n_rows"].alias("n_rows"),
        "n_ids",
        counts["null_texts"].alias("null_texts"),
        (counts["n_rows"] == F.col("n_ids")).alias("ids_unique"),
    )


def first_per_group(df: DataFrame, group: str, k: int, order: str = "sentence_id") -> DataFrame:
    """The first ``k`` rows of each group; the limit applies ahead of the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return df.withColumn("rn", rank).filter(F.col("rn") <= k)
