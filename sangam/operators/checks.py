"""Quality gates: frames of (check, observed, threshold, status)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import SPLITS
from ..sources.manifest import missing_from

PASSED, WARNING, FAILED, PARTIAL = "passed", "warning", "failed", "partial"


def gate(check, observed: Column, threshold, status: Column) -> list[Column]:
    name = F.lit(check) if isinstance(check, str) else check
    return [
        name.alias("check"),
        observed.cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
        status.alias("status"),
    ]


def verdict(checks: DataFrame) -> DataFrame:
    """One row: failed if any check failed, else warning if any warned."""
    worst = (
        F.when(F.bool_or(F.col("status") == FAILED), FAILED)
        .when(F.bool_or(F.col("status").isin(WARNING, PARTIAL)), WARNING)
        .otherwise(PASSED)
    )
    return checks.agg(worst.alias("status"))


def train_size(df: DataFrame, at_least: int = 25_000) -> DataFrame:
    rows = df.agg(F.count_if(F.col("split") == "train").alias("n"))
    status = F.when(F.col("n") >= at_least, PASSED).otherwise(WARNING)
    return rows.select(*gate("train_rows", F.col("n"), at_least, status))


def sources_loaded(expected: DataFrame, df: DataFrame) -> DataFrame:
    """Passed if every expected source has rows, partial if some have, else failed."""
    missing = missing_from(expected, df, "source").withColumn("missing", F.lit(1))
    counts = expected.join(missing, "source", "left").agg(
        F.count(F.lit(1)).alias("n_expected"), F.count("missing").alias("n_missing")
    )
    loaded = F.col("n_expected") - F.col("n_missing")
    status = (
        F.when(loaded == F.col("n_expected"), PASSED).when(loaded > 0, PARTIAL).otherwise(FAILED)
    )
    return counts.select(
        F.lit("sources_loaded").alias("check"),
        loaded.cast("double").alias("observed"),
        F.col("n_expected").cast("double").alias("threshold"),
        status.alias("status"),
    )


def skip_decision(verdicts: DataFrame, has_access: bool) -> DataFrame:
    """What to do with a source of ID files: skip it, fetch its text, or look into it."""
    no_text = F.bool_and(F.col("status").isin("id_only", "empty", "missing"))
    decision = (
        F.when(F.lit(has_access), "hydrate").when(F.col("no_text"), "skip").otherwise("inspect")
    )
    return (
        verdicts.agg(no_text.alias("no_text"), F.count_if(F.col("status") == "has_text").alias("n"))
        .withColumn("decision", decision)
        .withColumnRenamed("n", "tasks_with_text")
    )


def unified_table(expected: DataFrame, df: DataFrame) -> DataFrame:
    """Expected sources non-empty, ids unique, texts non-null."""
    from .reports import id_null_checks

    empty = missing_from(expected, df, "source").agg(F.count(F.lit(1)).alias("n"))
    ids = id_null_checks(df)

    def zero(n: Column) -> Column:
        return F.when(n == 0, PASSED).otherwise(FAILED)

    repeated = F.col("n_rows") - F.col("n_ids")
    nulls = F.col("null_texts")
    row_checks = F.explode(
        F.array(
            F.struct(*gate("repeated_ids", repeated, 0, zero(repeated))),
            F.struct(*gate("null_texts", nulls, 0, zero(nulls))),
        )
    )
    return empty.select(*gate("empty_sources", F.col("n"), 0, zero(F.col("n")))).unionByName(
        ids.select(row_checks.alias("c")).select("c.*")
    )


def table_facts(df: DataFrame) -> DataFrame:
    """Per source: rows, rows for training, null texts; and how often an id occurs again.

    One pass.  A repeated id counts for one of the sources it occurs in.
    """
    by_id = df.groupBy("source", "sentence_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("text").isNull()).alias("nulls"),
    )
    seen = by_id.groupBy("sentence_id").agg(
        (F.sum("n") - 1).alias("again"), F.collect_list(F.struct("source", "n", "train", "nulls")).alias("seen")
    )
    rows = seen.select("again", F.posexplode("seen").alias("place", "s"))
    return rows.groupBy("s.source").agg(
        F.sum("s.n").alias("n_rows"),
        F.sum("s.train").alias("n_train"),
        F.sum("s.nulls").alias("n_nulls"),
        F.sum(F.when(F.col("place") == 0, F.col("again")).otherwise(0)).alias("n_repeated"),
    )


def table_gates(expected: DataFrame, facts: DataFrame, at_least: int = 25_000) -> DataFrame:
    """Train size, sources loaded, sources empty, ids repeated and texts null, from ``table_facts``."""

    def zero(n: Column) -> Column:
        return F.when(n == 0, PASSED).otherwise(FAILED)

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    loaded = sources_loaded(expected, facts)
    empty = F.col("threshold") - F.col("observed")
    sums = facts.agg(total("n_train").alias("train"), total("n_repeated").alias("repeated"), total("n_nulls").alias("nulls"))
    train = F.when(F.col("train") >= at_least, PASSED).otherwise(WARNING)
    rows = F.explode(
        F.array(
            F.struct(*gate("train_rows", F.col("train"), at_least, train)),
            F.struct(*gate("repeated_ids", F.col("repeated"), 0, zero(F.col("repeated")))),
            F.struct(*gate("null_texts", F.col("nulls"), 0, zero(F.col("nulls")))),
        )
    )
    return sums.select(rows.alias("c")).select("c.*").unionByName(loaded).unionByName(
        loaded.select(*gate("empty_sources", empty, 0, zero(empty)))
    )


def share_dropped(report: DataFrame, fail_above: float = 90, warn_above: float = 50) -> DataFrame:
    pct = F.col("pct_dropped")
    status = F.when(pct > fail_above, FAILED).when(pct > warn_above, WARNING).otherwise(PASSED)
    return report.select(*gate("pct_dropped", pct, warn_above, status))


def script_types_present(df: DataFrame, required=("roman_only",)) -> DataFrame:
    found = df.agg(F.collect_set("script_type").alias("found"))
    wanted = F.array(*[F.lit(r) for r in required])
    missing = F.size(F.array_except(wanted, F.col("found")))
    status = F.when(missing == 0, PASSED).otherwise(FAILED)
    return found.select(*gate("missing_script_types", missing, 0, status))


def split_balance(
    df: DataFrame, train_min=60, train_max=95, validation_min=3, test_min=3
) -> DataFrame:
    """Shares of the splits against their limits."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS],
    )

    def share(split: str) -> Column:
        return F.col(split) / F.col("total") * 100

    def row(check: str, split: str, limit, bad: Column) -> Column:
        return F.struct(*gate(check, share(split), limit, F.when(bad, FAILED).otherwise(PASSED)))

    rows = F.array(
        row("train_min_pct", "train", train_min, share("train") < train_min),
        row("train_max_pct", "train", train_max, share("train") > train_max),
        row("validation_min_pct", "validation", validation_min, share("validation") < validation_min),
        row("test_min_pct", "test", test_min, share("test") < test_min),
    )
    return counts.select(F.explode(rows).alias("c")).select("c.*")


def all_checks(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
