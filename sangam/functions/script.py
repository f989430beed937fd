"""Script counts and labels from Unicode ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .numbers import percent, round1_exact

# The Devanagari block and the ASCII letters.
DEVANAGARI = r"\u0900-\u097f"
LATIN = "A-Za-z"


def _count(text: Column, chars: str) -> Column:
    # Dropping the complement and taking the length beats regexp_count, which
    # builds an array with one string per letter.
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("bigint")


def script_counts(text: Column) -> Column:
    counts = F.struct(_count(text, DEVANAGARI).alias("deva"), _count(text, LATIN).alias("latin"))

    def derive(c: Column) -> Column:
        total = c["deva"] + c["latin"]
        return F.struct(
            c["deva"].alias("devanagari"),
            c["latin"].alias("latin"),
            total.alias("total_alpha"),
            percent(c["deva"], total).alias("deva_pct"),
            percent(c["latin"], total).alias("latin_pct"),
        )

    # Through a one-element array, so that each count is taken once.
    return F.transform(F.array(counts), derive)[0]


def script_label(text: Column) -> Column:
    """Label by which scripts occur at all; a match stops at the first hit, so
    no counting is needed."""
    deva, latin = text.rlike(f"[{DEVANAGARI}]"), text.rlike(f"[{LATIN}]")
    return (
        F.when(deva & latin, "mixed_script")
        .when(deva, "devanagari_only")
        .when(latin, "roman_only")
        .otherwise("unknown")
    )


def with_script(df: DataFrame, percents: bool = False) -> DataFrame:
    """Add ``script_type`` and, if asked, the two rounded percent columns."""
    out = df
    if percents:
        out = (
            out.withColumn("_sc", script_counts(F.col("text")))
            .withColumn("deva_pct", round1_exact(F.col("_sc.deva_pct")))
            .withColumn("latin_pct", round1_exact(F.col("_sc.latin_pct")))
            .drop("_sc")
        )
    return out.withColumn("script_type", script_label(F.col("text")))
