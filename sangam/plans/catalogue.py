"""Every registered query by name: (spark, sf_dir) -> DataFrame.

Arrays leave as joined text so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as X
from ..operators import checks, cleaning, reports, sinks, splits
from ..operators.ids import dense_ids, unify
from ..schema import LOAD_ORDER, SCRIPT_TYPES
from ..session import fresh_path, remove, staged
from ..sources import (
    SourceFile,
    empty_source,
    file_kinds,
    inspect_id_only,
    lines_to_sentences,
    load_report,
    manifest_frame,
    missing_from,
    read_array_csv,
    read_conll,
    rows_to_sentences,
    sample_ids,
    task_verdicts,
)
from . import corpus as C
from .dataset import prepare

EXPECTED = ("en", "de", "es", "fr", "it", "pt")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def joined(items: str, sep: str = " ", name: str | None = None):
    return F.array_join(items, sep).alias(name or items)


def kept_rows(spark, d) -> DataFrame:
    """Cleaned rows in load order, not numbered."""
    return cleaning.retokenised(cleaning.clean_rows(C.loaded_lines(spark, d), LOAD_ORDER))


def labelled_rows(spark, d) -> DataFrame:
    return X.with_script(kept_rows(spark, d))


def clean_corpus(spark, d) -> DataFrame:
    """Numbered clean sentences with their script."""
    return prepare(C.loaded_lines(spark, d), resplit=False)


def split_corpus(spark, d) -> DataFrame:
    return prepare(C.loaded_lines(spark, d))


# Text functions


@query
def strip_urls(spark, d):
    rows = C.document_lines(spark, d)
    return rows.select("doc_id", "line_no", X.strip_urls(F.col("text")).alias("text"))


@query
def strip_urls_html(spark, d):
    return C.table(spark, d, "pages").select(
        "page_id",
        X.strip_urls(F.col("url")).alias("url"),
        X.strip_urls(F.col("html")).alias("html"),
    )


@query
def strip_mentions(spark, d):
    rows = C.document_lines(spark, d)
    return rows.select("doc_id", "line_no", X.strip_mentions(F.col("text")).alias("text"))


@query
def collapse_ws(spark, d):
    return C.table(spark, d, "documents").select("doc_id", X.collapse_ws(F.col("text")).alias("text"))


@query
def clean_text(spark, d):
    rows = C.document_lines(spark, d)
    return rows.select("doc_id", "line_no", X.clean_text(F.col("text")).alias("text"))


@query
def clean_text_html(spark, d):
    return C.table(spark, d, "pages").select("page_id", X.clean_text(F.col("html")).alias("html"))


@query
def retokenize(spark, d):
    tokens = C.table(spark, d, "documents").select("doc_id", X.tokens_of(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id", joined("tokens", "|"), F.size("tokens").cast("bigint").alias("token_count")
    )


@query
def parse_array_repr(spark, d):
    rows = C.array_rows(spark, d)
    items = rows.select("doc_id", "line_no", X.parse_array_repr(F.col("words")).alias("items"))
    return items.select(
        "doc_id", "line_no", joined("items", "|"), F.size("items").cast("bigint").alias("n")
    )


@query
def parse_array_repr_strict(spark, d):
    """Both kinds of quotes delimit an item."""
    rows = C.array_rows(spark, d)
    parsed = X.parse_array_repr(F.col("words"), strict=True).alias("items")
    items = rows.select("doc_id", "line_no", parsed)
    return items.select(
        "doc_id", "line_no", joined("items", "|"), F.size("items").cast("bigint").alias("n")
    )


@query
def array_to_string(spark, d):
    """JSON text of the token arrays, read back for the comparison."""
    rows = C.document_lines(spark, d)
    cell = X.array_to_text(X.tokens_of(F.col("text"))).alias("cell")
    back = rows.select("doc_id", "line_no", cell).withColumn("items", X.text_to_array(F.col("cell")))
    return back.select("doc_id", "line_no", joined("items", "|"))


@query
def script_counts(spark, d):
    rows = C.document_lines(spark, d)
    counts = rows.select("doc_id", "line_no", X.script_counts(F.col("text")).alias("c"))
    return counts.select(
        "doc_id",
        "line_no",
        "c.devanagari",
        "c.latin",
        "c.total_alpha",
        X.round1_exact(F.col("c.deva_pct")).alias("deva_pct"),
        X.round1_exact(F.col("c.latin_pct")).alias("latin_pct"),
    )


@query
def script_label(spark, d):
    rows = C.document_lines(spark, d)
    return rows.select("doc_id", "line_no", X.script_label(F.col("text")).alias("script_type"))


@query
def previews(spark, d):
    rows = C.document_lines(spark, d)
    text = F.col("text")
    return rows.select(
        "doc_id",
        "line_no",
        X.text_preview(text, 80).alias("text_80"),
        X.ascii_preview(text, 70).alias("ascii_70"),
        F.array_join(X.token_preview(X.tokens_of(text), 10), "|").alias("tokens_10"),
    )


# Load, numbering and cleaning


@query
def unify_ids(spark, d):
    rows = unify(C.loaded_lines(spark, d), empty_source(spark), C.loaded_turns(spark, d))
    return rows.select(
        "sentence_id", "source", "split", "text", joined("tokens"), joined("lid_tags")
    )


@query
def dedup_first(spark, d):
    order = ("doc_id", "line_no")
    rows = cleaning.dedup_first(cleaning.cleaned(C.document_lines(spark, d)), order=order)
    return rows.select("doc_id", "line_no", "source", "split", "text")


@query
def length_filter(spark, d):
    rows = cleaning.length_filter(cleaning.cleaned(C.document_lines(spark, d)))
    return rows.select("doc_id", "line_no", "text")


@query
def cleaned_corpus(spark, d):
    rows = cleaning.apply_cleaning(C.raw_corpus(spark, d))
    return rows.select(
        "sentence_id", "source", "split", "text", joined("tokens"), joined("lid_tags")
    )


@query
def cleaning_report(spark, d):
    return cleaning.cleaning_report(C.document_lines(spark, d))


@query
def aligned_tags(spark, d):
    """The cleaned corpus with tags that follow their tokens."""
    rows = cleaning.apply_cleaning(C.raw_corpus(spark, d), align_tags=True)
    return rows.select("sentence_id", "text", joined("tokens", "|"), joined("lid_tags"))


@query
def misaligned_by_source(spark, d):
    """Rows out of step with their tags after cleaning, with tags as read and with tags that follow."""
    clean = cleaning.retokenised(cleaning.cleaned(C.loaded_lines(spark, d), align_tags=True, as_read="read_tags"))
    return cleaning.tag_alignments(clean, {"as_read": "read_tags", "aligned": "lid_tags"})


@query
def dropped_by_source(spark, d):
    return cleaning.dropped_by_source(C.document_lines(spark, d), kept_rows(spark, d))


# Reports


@query
def length_stats(spark, d):
    stats = reports.length_stats(kept_rows(spark, d))
    return stats.select(
        F.col("min_length").cast("bigint").alias("min_length"),
        F.col("max_length").cast("bigint").alias("max_length"),
        "mean_length",
        "median_length",
    )


@query
def length_sketch(spark, d):
    """Whether medians read from merged sketches are as near to the exact ones as stated, per source and split, per source, and overall."""
    rows = kept_rows(spark, d).select("source", F.coalesce("split", F.lit("")).alias("split"), "tokens")
    sketches = staged(reports.length_sketches(rows, "source", "split"), "sketches")
    exact = staged(rows.groupBy("source", "split", F.size("tokens").alias("length")).agg(F.count(F.lit(1)).alias("c")), "lengths")
    # a cell counts for itself, for its source and for the whole
    total, one, cell = F.lit(reports.TOTAL), F.col("source"), F.col("split")
    pairs = [F.struct(a.alias("source"), b.alias("split")) for a, b in ((one, cell), (one, total), (total, total))]
    sketches, exact = (df.withColumn("of", F.explode(F.array(*pairs))).drop("source", "split") for df in (sketches, exact))
    both = exact.join(reports.sketched_medians(sketches, "of"), "of")
    below = F.sum(F.when(F.col("length") < F.col("median_length"), F.col("c")).otherwise(0))
    upto = F.sum(F.when(F.col("length") <= F.col("median_length"), F.col("c")).otherwise(0))
    found = both.groupBy("of", "n").agg(below.alias("below"), upto.alias("upto"))
    slack = reports.SKETCH_ERROR * F.col("n") + 1
    near = (F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)
    return found.select("of.source", "of.split", "n", near.alias("near"))


@query
def ids_unique(spark, d):
    return reports.ids_unique(C.raw_corpus(spark, d))


@query
def counts_by_source(spark, d):
    return reports.ordered_counts(C.document_lines(spark, d), "source")


@query
def counts_by_split(spark, d):
    return reports.distribution(C.document_lines(spark, d), "split")


@query
def script_distribution(spark, d):
    return reports.distribution(labelled_rows(spark, d), "script_type")


@query
def source_by_script(spark, d):
    return reports.counts_by(labelled_rows(spark, d), "source", "script_type")


@query
def source_by_split_pct(spark, d):
    return reports.source_by_split(split_corpus(spark, d))


@query
def script_by_split(spark, d):
    return reports.script_by_split(split_corpus(spark, d))


@query
def load_counts_rollup(spark, d):
    """All rows count; ``level`` tells a row without split from a total."""
    return reports.load_counts(C.document_lines(spark, d))


@query
def summary(spark, d):
    return reports.summary(kept_rows(spark, d))


@query
def script_pivot(spark, d):
    return reports.script_pivot(labelled_rows(spark, d))


@query
def tag_vocab(spark, d):
    tokens = X.tokens_of(F.col("text"))
    return reports.tag_vocab(C.document_lines(spark, d).select(C.tags_of(tokens).alias("lid_tags")))


@query
def distinct_sources(spark, d):
    return reports.distinct_values(C.table(spark, d, "documents"), "source")


@query
def id_null_checks(spark, d):
    return reports.id_null_checks(C.raw_corpus(spark, d))


@query
def examples_per_script(spark, d):
    rows = reports.first_per_group(X.with_script(clean_corpus(spark, d), percents=True), "script_type", 3)
    return rows.select(
        "script_type",
        F.col("rn").cast("bigint").alias("rn"),
        "sentence_id",
        X.ascii_preview(F.col("text"), 70).alias("preview"),
        "deva_pct",
        "latin_pct",
    )


@query
def report_lines(spark, d):
    """The script distribution as formatted text."""
    rows = reports.distribution(labelled_rows(spark, d), "script_type")
    return rows.select(
        "script_type",
        X.thousands(F.col("n")).alias("n"),
        F.concat(X.one_decimal(X.round1(F.col("pct"))), F.lit("%")).alias("pct"),
        "bar",
    )


# Readers


@query
def conll_sentences(spark, d):
    """Token lines to sentences, numbered in file and line order."""
    sentences = lines_to_sentences(C.token_lines(spark, d), in_order=True)
    rows = dense_ids(sentences, ["rank", "file", "block"], ["pos"])
    return rows.select("sentence_id", "source", "text", joined("tokens", "|"), joined("lid_tags"))


def split_manifest(path: str, kind: str) -> list[SourceFile]:
    parts = [("train", "train"), ("validation", "validation"), ("test", "test"), (None, "none")]
    return [SourceFile("lines", split, f"{path}/part={part}", kind, False) for split, part in parts]


@query
def conll_files(spark, d):
    """The corpus written as CoNLL files and read back."""
    path = fresh_path(spark, "conll")
    C.write_conll(spark, d, path)
    sentences = read_conll(spark, split_manifest(path, "conll"))
    remove(spark, path)
    rows = unify(sentences)
    return rows.select("sentence_id", "split", "text", joined("tokens", "|"), joined("lid_tags"))


@query
def array_csv_rows(spark, d):
    rows = C.array_rows(spark, d).withColumns(
        {
            "rank": F.lit(0).cast("bigint"),
            "file": F.lit(""),
            "block": F.col("doc_id"),
            "pos": F.col("line_no"),
        }
    )
    parsed = rows_to_sentences(rows)
    return parsed.select(
        F.col("block").alias("doc_id"),
        F.col("pos").alias("line_no"),
        "text",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        joined("lid_tags"),
    )


def _csv_round_trip(spark, d, records):
    path = fresh_path(spark, "array-csv")
    C.write_array_csv(spark, d, path, records)
    sentences = read_array_csv(spark, split_manifest(path, "array_csv"))
    remove(spark, path)
    rows = unify(sentences)
    return rows.select("sentence_id", "split", "text", joined("tokens", "|"), joined("lid_tags"))


@query
def array_csv_files(spark, d):
    """The corpus written as multi-line CSV files and read back."""
    return _csv_round_trip(spark, d, records=0)


@query
def array_csv_split_files(spark, d):
    """The same, with the corpus split over many files, which are read in parallel."""
    return _csv_round_trip(spark, d, records=500)


@query
def manifest_loads(spark, d):
    """What each entry of a manifest gave: files, a folder, a pattern, a missing CSV, and missing CoNLL files."""
    path = fresh_path(spark, "manifest")
    manifest = [
        SourceFile("tagged", "train", f"{path}/conll/part=train"),
        SourceFile("tagged", "other", f"{path}/conll/part=[vn]*"),
        SourceFile("tagged", "gone", f"{path}/conll/part=gone", required=False),
        SourceFile("printed", "all", f"{path}/csv", "array_csv"),
        SourceFile("printed", "test", f"{path}/csv/part=test", "array_csv"),
        SourceFile("printed", "gone", f"{path}/csv/gone.csv", "array_csv"),
    ]
    entries = [*manifest, SourceFile("tagged", "needed", f"{path}/conll/needed.txt")]
    # one kind is written, read and listed after the other, so that their files are never there at once
    C.write_conll(spark, d, f"{path}/conll")
    tagged, listed = read_conll(spark, manifest), manifest_frame(spark, entries).filter("kind = 'conll'")
    remove(spark, f"{path}/conll")
    C.write_array_csv(spark, d, f"{path}/csv")
    printed, others = read_array_csv(spark, manifest), manifest_frame(spark, entries).filter("kind <> 'conll'")
    remove(spark, f"{path}/csv")
    report = load_report(spark, entries, tagged.unionByName(printed), listed.unionByName(others))
    return report.select("rank", "source", "split", "kind", "required", "present", "n", "status")


@query
def task_folders(spark, d):
    """Verdicts on real folders: one per language, an empty one and a missing one."""
    root = fresh_path(spark, "tasks")
    C.write_task_folders(spark, d, root)
    tasks = [f"task={name}" for name in (*EXPECTED, "void", "gone")]
    verdicts, _, _ = inspect_id_only(spark, root, tasks)
    return verdicts.select("task", "n_files", "n_id_files", "n_text_files", "status")


def _task_files(spark, d):
    lines = C.task_files(spark, d)
    files = lines.select("task", "file").distinct()
    return lines, file_kinds(lines, files.withColumn("name", F.substring_index("file", "/", -1)))


@query
def id_only_files(spark, d):
    return _task_files(spark, d)[1]


def _verdicts(spark, d):
    lines, kinds = _task_files(spark, d)
    present = lines.select("task").distinct().withColumn("present", F.lit(True))
    absent = spark.createDataFrame([("absent", False)], present.schema)
    return task_verdicts(kinds, present.unionByName(absent))


@query
def task_verdicts_(spark, d):
    return _verdicts(spark, d)


@query
def task_sample_ids(spark, d):
    lines, kinds = _task_files(spark, d)
    return sample_ids(lines, kinds).withColumn("line_no", F.col("line_no").cast("bigint"))


@query
def skip_decision(spark, d):
    return checks.skip_decision(_verdicts(spark, d), has_access=False)


@query
def missing_files(spark, d):
    """Those of 24 expected sources that the table does not have."""
    expected = spark.range(24).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("source"))
    return missing_from(expected, C.table(spark, d, "documents"), "source")


# Splits


@query
def stratum_sizes(spark, d):
    return splits.stratum_sizes(labelled_rows(spark, d))


@query
def assign_splits(spark, d):
    return split_corpus(spark, d).select("sentence_id", "source", "script_type", "split")


@query
def assign_splits_exact(spark, d):
    """Splits whose sizes are 80/10/10 over all rows without one."""
    rows = prepare(C.loaded_lines(spark, d), exact_totals=True)
    return rows.select("sentence_id", "source", "script_type", "split")


@query
def split_totals(spark, d):
    """Sizes of exact splits of the whole corpus, none of it split before."""
    unsplit = C.loaded_lines(spark, d).withColumn("split", F.lit(None).cast("string"))
    totals = splits.split_totals(prepare(unsplit, exact_totals=True))
    return totals.select("split", "n", (F.abs("off") <= 1).alias("exact"))


@query
def split_gate(spark, d):
    return checks.split_balance(split_corpus(spark, d))


# Gates




@query
def quality_gates(spark, d):
    """Gates over the numbered table and its cleaned texts: one pass each, besides the numbering's."""
    expected = spark.createDataFrame([(source,) for source in EXPECTED], "source string")
    facts = staged(checks.table_facts(C.raw_corpus(spark, d)), "facts")
    lines, label = C.document_lines(spark, d), X.script_label(F.col("text"))
    counts = staged(cleaning.cleaning_counts(lines, script_type=label), "counts")
    return checks.all_checks(
        checks.table_gates(expected, facts),
        checks.share_dropped(cleaning.report_of(counts)),
        checks.script_types_present(counts.filter("fits")),
    )


@query
def gate_verdict(spark, d):
    return checks.verdict(checks.split_balance(split_corpus(spark, d)))


# Whole job and sinks

FINAL_COLUMNS = ("sentence_id", "source", "split", "text")


def _final_view(df: DataFrame) -> DataFrame:
    return df.select(*FINAL_COLUMNS, joined("tokens"), joined("lid_tags"), "script_type")


@query
def final_dataset(spark, d):
    return _final_view(split_corpus(spark, d))


@query
def final_summary(spark, d):
    return reports.summary(split_corpus(spark, d))


@query
def parquet_roundtrip(spark, d):
    path = fresh_path(spark, "dataset")
    sinks.write_parquet(split_corpus(spark, d), path, partition_by=("source", "split"))
    return _final_view(sinks.read_parquet(spark, path))


@query
def csv_roundtrip(spark, d):
    path = fresh_path(spark, "dataset-csv")
    sinks.write_csv(split_corpus(spark, d), path)
    return _final_view(sinks.read_csv(spark, path))


@query
def outputs_check(spark, d):
    folder = fresh_path(spark, "outputs")
    sinks.write_outputs(split_corpus(spark, d), folder)
    return sinks.outputs_check(spark, folder).select("name", "status")




def _report_files(spark, d) -> str:
    folder = fresh_path(spark, "outputs")
    sinks.write_outputs(split_corpus(spark, d), folder)
    return folder


@query
def summary_file(spark, d):
    """The summary as its CSV file has it."""
    schema = "source string, split string, sentence_count bigint, avg_length double"
    return spark.read.schema(schema).option("header", True).csv(f"{_report_files(spark, d)}/summary.csv")


@query
def script_pivot_file(spark, d):
    """The table of scripts by source as its CSV file has it."""
    schema = ", ".join(["source string", *(f"{t} bigint" for t in SCRIPT_TYPES)])
    return spark.read.schema(schema).option("header", True).csv(f"{_report_files(spark, d)}/script_pivot.csv")
