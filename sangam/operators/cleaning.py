"""Cleaning: text rules, exact duplicates, length limits, and their report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import percent
from ..functions.text import clean_pairs, clean_text, clean_token_count, clean_tokens
from ..session import computed, staged
from .ids import renumber

MIN_TOKENS, MAX_TOKENS = 3, 100


def cleaned(df: DataFrame, align_tags: bool = False, as_read: str | None = None) -> DataFrame:
    """Clean ``text``; the tokens follow from it and are rebuilt by ``retokenised``.

    ``lid_tags`` stay as read, and may then be more or fewer than the tokens. With ``align_tags`` they follow their
    tokens through the cleaning; only rows whose tokens it changes are looked at token by token. ``as_read`` names a
    column for the tags as read beside them.
    """
    out = computed(df, "text", clean_text(F.col("text")))
    if as_read:
        out = out.withColumn(as_read, F.col("lid_tags"))
    if align_tags:
        same = clean_tokens(F.col("text")) == F.col("tokens")
        tags = F.slice("lid_tags", F.lit(1), F.size("tokens"))
        few = F.greatest(F.size("tokens") - F.size(tags), F.lit(0))
        padded = F.concat(tags, F.array_repeat(F.lit(None).cast("string"), few))
        followed = clean_pairs(F.col("tokens"), F.col("lid_tags"))["tag"]
        out = out.withColumn("lid_tags", F.when(same, padded).otherwise(followed))
    return out.drop("tokens")


def retokenised(df: DataFrame) -> DataFrame:
    return df.withColumn("tokens", clean_tokens(F.col("text")))


def _misaligned(tags: str) -> Column:
    return F.count_if(F.size("tokens") != F.size(tags))


def tag_alignment(df: DataFrame) -> DataFrame:
    """Rows per source, and how many have another number of tags than of tokens."""
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n"), _misaligned("lid_tags").alias("n_misaligned"))


def tag_alignments(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    """``tag_alignment`` of several columns of tags, each under the name of its mode, in one pass over ``df``."""
    counts = F.array(*(F.struct(F.lit(m).alias("mode"), _misaligned(c).alias("n_misaligned")) for m, c in modes.items()))
    found = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"), counts.alias("modes"))
    return found.select("source", "n", F.inline("modes")).select("mode", "source", "n", "n_misaligned")


def dedup_first(df: DataFrame, key: str = "text", order=("sentence_id",)) -> DataFrame:
    """The first row of each ``key`` by ``order``.

    Spark turns the rank filter into a group limit ahead of the shuffle, so even
    a text with very many copies sends at most one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def length_filter(df: DataFrame, min_tokens=MIN_TOKENS, max_tokens=MAX_TOKENS) -> DataFrame:
    """Keep cleaned rows with a token count between the limits, both inclusive.

    The condition is on ``text``, the key of ``dedup_first``, so Spark applies it
    before the shuffle when it is written after it.
    """
    return df.filter(clean_token_count(F.col("text")).between(min_tokens, max_tokens))


def clean_rows(
    df: DataFrame, order=("sentence_id",), min_tokens=MIN_TOKENS, max_tokens=MAX_TOKENS, align_tags: bool = False
) -> DataFrame:
    """Rows that survive cleaning, before they get tokens and new ids."""
    return length_filter(dedup_first(cleaned(df, align_tags), order=order), min_tokens, max_tokens)


def apply_cleaning(
    df: DataFrame, min_tokens=MIN_TOKENS, max_tokens=MAX_TOKENS, stage: bool = True, align_tags: bool = False
) -> DataFrame:
    """Clean, retokenise, drop duplicates, then length outliers, and renumber.

    ``lid_tags`` stay as read, so they may be longer than the new tokens, unless ``align_tags`` lets them follow.
    Numbering reads the kept rows twice, so they are written to the shared folder
    in between; ``stage=False`` computes them twice instead and writes nothing.
    """
    kept = clean_rows(df, min_tokens=min_tokens, max_tokens=max_tokens, align_tags=align_tags)
    if stage:
        kept = staged(kept, "kept")
    return retokenised(renumber(kept)).select(*df.columns)


def cleaning_counts(
    df: DataFrame, min_tokens=MIN_TOKENS, max_tokens=MAX_TOKENS, **labels: Column
) -> DataFrame:
    """Distinct cleaned texts and their rows by whether the length fits and by ``labels``, columns over ``text``.

    Whatever row of a text is kept, its length is the same, so counts per distinct
    text are enough and copies are combined ahead of the shuffle.  Texts are told
    apart by their MD5, so the shuffle carries digests.
    """
    text = F.col("text")
    fits = F.coalesce(clean_token_count(text).between(min_tokens, max_tokens), F.lit(False))
    names = ["fits", *labels]
    texts = cleaned(df).select(
        F.unhex(F.md5(text)).alias("digest"), fits.alias("fits"), *(c.alias(n) for n, c in labels.items())
    )
    texts = texts.groupBy("digest", *names).agg(F.count(F.lit(1)).alias("copies"))
    return texts.groupBy(*names).agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("copies"))


def cleaning_report(df: DataFrame, min_tokens=MIN_TOKENS, max_tokens=MAX_TOKENS) -> DataFrame:
    """One row: rows before, dropped as duplicates, then by length, after, percents."""
    return report_of(cleaning_counts(df, min_tokens, max_tokens))


def report_of(counted: DataFrame) -> DataFrame:
    """The cleaning report of ``cleaning_counts``, whatever its labels."""

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    texts, copies, fits = F.col("texts"), F.col("copies"), F.col("fits")
    counts = counted.agg(
        total(copies).alias("rows_before"),
        total(copies - texts).alias("dropped_duplicates"),
        total(F.when(~fits, texts).otherwise(0)).alias("dropped_length"),
        total(F.when(fits, texts).otherwise(0)).alias("rows_after"),
    )
    dropped = F.col("dropped_duplicates") + F.col("dropped_length")
    before = F.col("rows_before")
    return counts.select(
        "*",
        dropped.alias("total_dropped"),
        percent(F.col("dropped_duplicates"), before).alias("pct_duplicates"),
        percent(F.col("dropped_length"), before).alias("pct_length"),
        percent(dropped, before).alias("pct_dropped"),
    )


def dropped_by_source(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows kept and dropped per source; a source that lost all rows still shows."""
    before = raw.groupBy("source").agg(F.count(F.lit(1)).alias("raw_count"))
    after = clean.groupBy("source").agg(F.count(F.lit(1)).alias("clean_count"))
    return (
        before.join(after, "source", "left")
        .na.fill({"clean_count": 0})
        .withColumn("dropped", F.col("raw_count") - F.col("clean_count"))
    )
