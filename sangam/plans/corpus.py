"""Reader-shaped inputs derived from the given tables, whole tables each time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import tokens_of
from ..operators.ids import unify
from ..schema import LOADED
from ..session import computed, make_folder, shuffles_freed

DOCS_PER_BLOCK = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tags_of(tokens):
    """One tag per token, by whether it has an even number of characters."""
    return F.transform(tokens, lambda t: F.when(F.length(t) % 2 == 0, "lang1").otherwise("lang2"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of ``documents``, some changed so that every rule has work:
    letterless, Devanagari, mixed script, with a mention, with a URL."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    lines = documents.select(
        "doc_id",
        F.col("lang").alias("source"),
        F.expr(
            "CASE WHEN doc_id % 10 <= 5 THEN 'train' WHEN doc_id % 10 = 6 THEN 'validation' "
            "WHEN doc_id % 10 = 7 THEN 'test' WHEN doc_id % 10 = 8 THEN '' END"
        ).alias("split"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    )
    line, k = F.col("line"), F.col("doc_id") + F.col("line_no")
    text = (
        F.when(k % 19 == 0, "<3 <3 <3")
        .when(k % 17 == 0, F.regexp_replace(line, "[A-Za-z]", "\N{DEVANAGARI LETTER KA}"))
        .when(
            k % 13 == 0,
            F.translate(
                line,
                "aeiou",
                "\N{DEVANAGARI LETTER A}\N{DEVANAGARI LETTER E}\N{DEVANAGARI LETTER I}"
                "\N{DEVANAGARI LETTER U}\N{DEVANAGARI LETTER O}",
            ),
        )
        .when(k % 11 == 0, F.concat(F.lit("@user_"), F.col("doc_id") % 50, F.lit(" "), line))
        .when(k % 7 == 0, F.concat(line, F.lit(" https://ex.org/p/"), "doc_id", F.lit(" ok")))
        .otherwise(line)
    )
    return lines.select(
        "doc_id", F.col("line_no").cast("bigint").alias("line_no"), "source", "split", text.alias("text")
    )


def _loaded(rows: DataFrame, item: str, sub: str) -> DataFrame:
    """Rows ordered by (``item``, ``sub``) in the schema that readers return."""
    tokens = tokens_of(F.col("text"))
    return rows.select(
        F.lit(0).cast("bigint").alias("rank"),
        F.lit("").alias("file"),
        F.floor(F.col(item) / DOCS_PER_BLOCK).alias("block"),
        (F.shiftleft(F.col(item) % DOCS_PER_BLOCK, 32) + F.col(sub)).alias("pos"),
        "source",
        "split",
        "text",
        tokens.alias("tokens"),
        tags_of(tokens).alias("lid_tags"),
    ).select(*LOADED.fieldNames())


def loaded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(document_lines(spark, sf_dir), "doc_id", "line_no")


def loaded_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("chat_"), "role").alias("source"), "text"
    )
    return _loaded(turns.withColumn("split", F.lit(None).cast("string")), "conv_id", "turn")


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered sentence table of the document lines."""
    return unify(loaded_lines(spark, sf_dir))


def token_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as token lines with an empty line after each sentence.

    A document is a block, or two: the first five lines of every 64th form one of their own, so that
    sentences run across blocks. Lines of a block follow one another in one task.
    """
    rows = document_lines(spark, sf_dir)
    tokens = tokens_of(F.col("text"))
    pairs = F.transform(
        tokens,
        lambda t: F.concat(t, F.lit("\t"), F.when(F.length(t) % 2 == 0, "lang1").otherwise("lang2")),
    )
    doc, line = F.col("doc_id"), F.col("line_no")
    first = (doc % 64 == 0) & (line == 0) & (F.col("i") < 5)
    return rows.select(
        "doc_id", "line_no", "source", F.posexplode(F.concat(pairs, F.array(F.lit("")))).alias("i", "value")
    ).select(
        F.lit(0).cast("bigint").alias("rank"),
        "source",
        F.lit("train").alias("split"),
        F.col("source").alias("file"),
        (doc * 2 + F.when(first, 0).otherwise(1)).alias("block"),
        (F.shiftleft(line, 32) + F.col("i")).alias("pos"),
        "value",
    )


def part_of_split():
    return F.when(F.coalesce("split", F.lit("")) == "", "none").otherwise(F.col("split"))


def write_conll(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The corpus as CoNLL text files, one folder per split, in corpus order."""
    tokens = tokens_of(F.col("text"))
    lines = F.transform(
        tokens,
        lambda t: F.concat(t, F.lit("\t"), F.when(F.length(t) % 2 == 0, "lang1").otherwise("lang2")),
    )
    rows = (
        document_lines(spark, sf_dir)
        .withColumn("part", part_of_split())
        .repartitionByRange("doc_id", "line_no")
        .sortWithinPartitions("part", "doc_id", "line_no")
        .select("part", F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("value"))
    )
    with shuffles_freed(spark):
        rows.write.partitionBy("part").text(path)


def printed(item):
    """An item as arrays of strings print it: double quotes round an apostrophe, backslashes doubled."""
    plain = F.replace(item, F.lit("\\"), F.lit("\\\\"))
    single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), plain, F.lit('"'))
    return F.when(F.contains(item, F.lit("'")) & ~F.contains(item, F.lit('"')), double).otherwise(single)


def array_cell(items):
    """Items as a printed array, two items to a line."""
    quoted = F.transform(
        items,
        lambda t, i: F.concat(F.when(i == 0, "").when(i % 2 == 0, "\n ").otherwise(" "), printed(t)),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ""), F.lit("]"))


def hard_tokens(tokens, k):
    """Some tokens with the characters that printed arrays quote: apostrophe, quote, both, backslash."""
    return F.transform(
        tokens,
        lambda t, i: F.when((k + i) % 23 == 0, F.concat(t, F.lit("'s")))
        .when((k + i) % 29 == 0, F.concat(F.lit('"'), t, F.lit('"')))
        .when((k + i) % 31 == 0, F.concat(F.lit("'"), t, F.lit('"')))
        .when((k + i) % 37 == 0, F.concat(t, F.lit("\\"), t))
        .otherwise(t),
    )


def _with_cells(lines: DataFrame) -> DataFrame:
    """``lines`` with their text as array cells, some with hard characters."""
    tokens = hard_tokens(tokens_of(F.col("text")), F.col("doc_id") + F.col("line_no"))
    rows = computed(lines, "tokens", tokens).drop("text")
    cells = {"words": array_cell(F.col("tokens")), "lid": array_cell(tags_of(F.col("tokens")))}
    return rows.withColumns(cells).drop("tokens")


def array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as CSV rows with array cells, some with hard characters."""
    return _with_cells(document_lines(spark, sf_dir))


def write_array_csv(spark: SparkSession, sf_dir: str, path: str, records: int = 0) -> None:
    """The array rows as multi-line CSV files, one folder per split, in corpus order.

    With ``records``, a file has so many at most. Cells are made after the shuffle, whose sampling reads all rows.
    """
    lines = document_lines(spark, sf_dir).withColumn("part", part_of_split()).repartitionByRange("doc_id", "line_no")
    rows = _with_cells(lines).sortWithinPartitions("part", "doc_id", "line_no").select("part", "source", "words", "lid")
    with shuffles_freed(spark):
        rows.write.partitionBy("part").options(header=True, quote='"', escape='"', maxRecordsPerFile=records).csv(path)


def task_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of ID files: task (language), file, value; outside English every
    fifth source holds texts instead of ids."""
    fifth = F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 5 == 0
    value = F.when(fifth & (F.col("lang") != "en"), F.col("text")).otherwise(
        F.col("doc_id").cast("string")
    )
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("task"),
        F.concat_ws("/", "lang", "source").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("doc_id").alias("pos"),
        value.alias("value"),
    )


def write_task_folders(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The files of ``task_files`` as folders ``root/task=<language>/source=<source>`` with a file each.

    French has a hidden folder too, with a file of ids and the empty mark of a finished job; the task ``void`` is
    an empty folder.
    """
    lines = task_files(spark, sf_dir).withColumn("source", F.substring_index("file", "/", -1))
    rows = lines.select("task", "source", "value").repartition("task", "source")
    rows.write.partitionBy("task", "source").text(root)
    ids = table(spark, sf_dir, "documents").filter("lang = 'fr'").select(F.col("doc_id").cast("string").alias("value"))
    ids.repartition(1).write.text(f"{root}/task=fr/_ids")
    make_folder(spark, f"{root}/task=void")
