"""The whole preparation as one job: read, clean, number, label, split, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.script import with_script
from ..operators.cleaning import MAX_TOKENS, MIN_TOKENS, clean_rows, retokenised
from ..operators.ids import dense_ids, in_load_order
from ..operators.sinks import write_outputs
from ..operators.splits import assign_splits, has_split
from ..schema import FINAL, LOAD_ORDER
from ..session import staged, staging
from ..sources import SourceFile, read_array_csv, read_conll


def prepare(
    *frames: DataFrame,
    seed: int = 42,
    resplit: bool = True,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    align_tags: bool = False,
    exact_totals: bool = False,
) -> DataFrame:
    """Final dataset of loaded frames (``LOADED`` schema, earlier frames first).

    Duplicates are judged by load order directly, so rows are numbered only once,
    after cleaning.  The surviving rows are written to the shared folder before the
    numbering, which reads them twice; they are written numbered only if
    some lack a split, because the split assignment reads them three times.  ``align_tags`` lets
    tags follow their tokens, ``exact_totals`` makes split sizes exact over all rows.  Calling this runs jobs.
    """
    kept = clean_rows(in_load_order(*frames), LOAD_ORDER, min_tokens, max_tokens, align_tags)
    kept = staged(kept, "kept")
    numbered = dense_ids(kept, ["rank", "file", "block"], ["pos"])
    final = with_script(retokenised(numbered)).select(*FINAL.fieldNames())
    if resplit and not kept.filter(~has_split(F.col("split"))).isEmpty():
        final = assign_splits(staged(final, "numbered"), seed, exact_totals)
    return final


def build_dataset(
    spark: SparkSession, manifest: list[SourceFile], folder: str, partition_by=(), **options
) -> DataFrame:
    """Prepare the corpus of a manifest and write all outputs below ``folder``.

    The order of the manifest is the load order, whatever the kinds of its files.
    Staged tables are gone when this returns.
    """
    with staging(spark):
        loaded = read_conll(spark, manifest).unionByName(read_array_csv(spark, manifest))
        return write_outputs(prepare(loaded, **options), folder, partition_by)
