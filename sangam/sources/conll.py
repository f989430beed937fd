"""Token-per-line files: ``word<TAB>tag``, a blank line ends a sentence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import SPACE_CHARS, is_blank, strip_ws, text_of
from ..operators.ids import gapless
from ..schema import LOADED
from ..session import one_form, staged
from .lines import read_lines, runs_of, whole_runs
from .manifest import SourceFile, empty_source, entry_of, locate

ITEMS = ["word", "tag"]


def _tokens(lines: DataFrame) -> DataFrame:
    """Word and tag of every line, whether the line ends a sentence and whether it is one of a token, as columns; ``_read`` says the same."""
    value = F.col("value")
    # most lines begin with a visible ASCII character, which is seen at once
    visible = value.between("!", "~")
    after_word = F.substr(value, F.instr(value, "\t") + 1)
    word = strip_ws(F.substring_index(value, "\t", 1))
    return lines.withColumns(
        {
            "ends": F.when(visible, False).otherwise(is_blank(value)),
            "keep": value.contains("\t") & (word != ""),
            "word": word,
            "tag": strip_ws(F.substring_index(after_word, "\t", 1)),
        }
    )


def _read(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """Whether each line ends a sentence, whether it is one of a token, and word and tag of those that are.

    Lines are read as Arrow arrays, by the step that folds them: for Spark's own functions each takes several times as long.
    """
    tabbed = pc.fill_null(pc.match_substring(lines, "\t"), False)
    fields = pc.split_pattern(lines.filter(tabbed), "\t", max_splits=2)
    word, tag = (pc.utf8_trim(pc.list_element(fields, place), SPACE_CHARS) for place in (0, 1))
    named = pc.not_equal(word, "")
    keep = tabbed.to_numpy(zero_copy_only=False).copy()
    keep[keep] = named.to_numpy(zero_copy_only=False)
    ends = ~keep
    others = pc.equal(pc.utf8_trim(lines.filter(pa.array(ends)), SPACE_CHARS), "")
    ends[ends] = pc.fill_null(others, False).to_numpy(zero_copy_only=False)
    return ends, keep, [word.filter(named), tag.filter(named)]


def _sentences(runs: DataFrame) -> DataFrame:
    tokens = runs.withColumns({"tokens": F.col("word"), "lid_tags": F.col("tag"), "text": text_of(F.col("word"))})
    return gapless(tokens.select(*LOADED.fieldNames()))


def lines_to_sentences(lines: DataFrame, stage: bool = True, in_order: bool = False) -> DataFrame:
    """Sentences of token lines given as rank, source, split, file, block, pos, value.

    A line without a tab is skipped and ends nothing; so is one with an empty
    word.  Fields after the second are ignored.

    Lines of a block are brought together and sorted first, unless ``in_order`` says that they follow one
    another in one task, as a reader of files gives them: then lines are not shuffled, only what crosses a block's ends.
    The runs found are read more than once, here and by whoever numbers them, so they are written to the shared
    folder first; ``stage=False`` leaves the plan lazy.
    """
    if not in_order:
        lines = lines.repartition("rank", "file", "block").sortWithinPartitions("rank", "file", "block", "pos")
    carry = ["rank", "file", "source", "split"]
    runs = runs_of(lines, ["rank", "file", "block"], [*carry, "block"], ITEMS, _read)
    if stage:
        runs = staged(runs, "runs")
    return _sentences(whole_runs(runs, ["rank", "file"], carry, ITEMS))


def read_conll(spark: SparkSession, manifest: list[SourceFile]) -> DataFrame:
    """Sentences of the CoNLL entries of a manifest, in the ``LOADED`` schema.

    All entries are read in one scan. Lines stay in the task that reads them; sentences that cross a file split are chained from
    two rows a split. Runs a job when called; after it the files aren't read again.
    """
    found = locate(spark, manifest, "conll")
    if found is None:
        return empty_source(spark)
    runs = runs_of(read_lines(spark, found), ["file", "block"], ["file", "block"], ITEMS, _read)
    runs = staged(runs.withColumn("file", one_form(F.col("file"))), "runs")
    entries = staged(entry_of(runs.select("file").distinct(), found.roots), "entries")
    return _sentences(whole_runs(runs, ["file"], ["file"], ITEMS).join(entries, "file"))
