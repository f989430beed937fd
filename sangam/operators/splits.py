"""Stratified train / validation / test assignment for rows without a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import computed, staged

RARE_BELOW, TOO_FEW = 3, 10
# 16^4 parts per stratum, so that one stratum may hold nearly all rows.
HASH_DIGITS = 4


def has_split(split: Column) -> Column:
    return F.coalesce(split, F.lit("")) != ""


def stratum_key() -> Column:
    return F.concat_ws("__", "source", "script_type")


def stratum_sizes(df: DataFrame, rare_below: int = RARE_BELOW) -> DataFrame:
    """Size of each stratum of the unassigned rows and whether it is rare."""
    return (
        df.filter(~has_split(F.col("split")))
        .groupBy(stratum_key().alias("stratum"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rare", F.col("n") < rare_below)
    )


def _apportioned(strata: DataFrame, name: str, total: Column, whole: Column, rest: Column) -> DataFrame:
    """Shares ``whole`` of the strata, one more for those with the largest ``rest`` until they sum up to ``total``.

    Strata that go to train as a whole take no part. Ties go by the stratum's name. Only the strata's counts meet.
    """
    part = Window.partitionBy("all_train")
    seats = total - F.sum(whole).over(part)
    place = F.row_number().over(part.orderBy(rest.desc(), "stratum"))
    strata = strata.withColumns({"_whole": whole, "_seats": seats, "_place": place})
    more = (F.col("_place") <= F.col("_seats")).cast("bigint")
    return strata.withColumn(name, F.col("_whole") + more).drop("_whole", "_seats", "_place")


def _sizes(strata: DataFrame, exact_totals: bool) -> DataFrame:
    """``strata`` (stratum, n) with n_train, and n_held for train and validation together.

    n_train = (8n + 5) div 10 and half of the rest, rounded up, for validation;
    a rare stratum, or everything if too few rows are left, goes to train. With ``exact_totals`` these
    sizes hold for all other strata together, and are apportioned among them by largest remainders.
    """
    usable = F.sum(F.when(F.col("n") >= RARE_BELOW, F.col("n")).otherwise(0)).over(Window.partitionBy())
    strata = strata.withColumn("_usable", usable)
    strata = strata.withColumn("all_train", (F.col("n") < RARE_BELOW) | (F.col("_usable") < TOO_FEW))
    if exact_totals:
        n_train = F.expr("(8 * _usable + 5) div 10")
        strata = _apportioned(strata, "n_train", n_train, F.expr("(8 * n) div 10"), F.expr("(8 * n) % 10"))
        held = F.col("n") - F.col("n_train")
        strata = strata.withColumn("_held", held)
        n_validation = F.expr("(_usable - (8 * _usable + 5) div 10 + 1) div 2")
        strata = _apportioned(strata, "n_validation", n_validation, F.expr("_held div 2"), F.expr("_held % 2"))
        n_held = F.col("n_train") + F.col("n_validation")
    else:
        strata = strata.withColumn("n_train", F.expr("(8 * n + 5) div 10"))
        n_held = F.expr("n_train + (n - n_train + 1) div 2")
    strata = strata.withColumn("n_held", F.when(F.col("all_train"), F.col("n")).otherwise(n_held))
    strata = strata.withColumn("n_train", F.when(F.col("all_train"), F.col("n")).otherwise(F.col("n_train")))
    return strata.select("stratum", "n", "all_train", "n_train", "n_held")


def _parts(rows: DataFrame, exact_totals: bool) -> DataFrame:
    """Rows before each hash part of a stratum, and the sizes the stratum is cut into."""
    counts = rows.groupBy("stratum", "part").agg(F.count(F.lit(1)).alias("n_part"))
    strata = _sizes(counts.groupBy("stratum").agg(F.sum("n_part").alias("n")), exact_totals)
    earlier = (
        Window.partitionBy("stratum").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumn("before", F.coalesce(F.sum("n_part").over(earlier), F.lit(0))).join(
        strata, "stratum"
    )


def _in_part(rank: str) -> Column:
    return (F.col("before") < F.col(rank)) & (F.col(rank) <= F.col("before") + F.col("n_part"))


def _label(train: Column, validation: Column) -> Column:
    return F.when(train, "train").when(validation, "validation").otherwise("test")


def assign_splits(df: DataFrame, seed: int = 42, exact_totals: bool = False) -> DataFrame:
    """Fill missing splits 80/10/10 per stratum (source and script type); keep the others.

    With ``exact_totals`` the shares hold within one row over all strata that are neither rare nor too few,
    and within one row per stratum in each.

    Rows of a stratum are ranked by ``md5(seed|sentence_id)``.  No stratum is ever
    sorted as a whole: rows are counted per leading hash digits, only the parts
    that hold one of the two cut ranks are sorted, and the row found there is the
    cut.  Each row is then compared with the cuts of its stratum.  Cut parts and cuts
    are thin written tables, so the planner knows their size when it chooses how to join
    them: by broadcast while they are small, and else by a shuffle that it may split.

    ``df`` is read three times, two of them here, so pass a written or otherwise cheap table.
    """
    columns = df.columns
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col("sentence_id").cast("string")))
    key = F.struct(digest.alias("h"), F.col("sentence_id").alias("id"))
    missing = ~has_split(F.col("split"))
    keyed = computed(df.withColumn("stratum", stratum_key()), "key", F.when(missing, key))
    open_rows = keyed.filter(missing).withColumn("part", F.substring("key.h", 1, HASH_DIGITS))
    cut_parts = (
        _parts(open_rows.select("stratum", "part"), exact_totals)
        .filter(_in_part("n_train") | _in_part("n_held"))
        .select("stratum", "part", "before", "n_train", "n_held")
    )
    by_key = Window.partitionBy("stratum", "part").orderBy("key")
    cuts = (
        open_rows.select("stratum", "part", "key")
        .join(staged(cut_parts, "cut-parts"), ["stratum", "part"])
        .withColumn("rank", F.col("before") + F.row_number().over(by_key))
        .groupBy("stratum")
        .agg(
            F.max(F.when(F.col("rank") == F.col("n_train"), F.col("key"))).alias("last_train"),
            F.max(F.when(F.col("rank") == F.col("n_held"), F.col("key"))).alias("last_held"),
        )
    )
    label = _label(F.col("key") <= F.col("last_train"), F.col("key") <= F.col("last_held"))
    split = F.when(missing, label).otherwise(F.col("split"))
    labelled = keyed.join(staged(cuts, "cuts"), "stratum", "left")
    return labelled.withColumn("split", split).select(*columns)


def split_totals(df: DataFrame) -> DataFrame:
    """Rows per split, and how far the count is from 80, 10 or 10 percent of all, in rows."""
    n = F.count(F.lit(1))
    counts = df.groupBy("split").agg(n.alias("n"))
    share = F.when(F.col("split") == "train", 0.8).otherwise(0.1)
    return counts.withColumn("off", F.col("n") - share * F.sum("n").over(Window.partitionBy()))
