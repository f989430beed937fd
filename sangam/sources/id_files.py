"""Folders that may hold bare record numbers instead of text."""

from __future__ import annotations

import io
import re
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import is_digits, strip_ws
from ..session import expanded, file_uri, files_below, find_package, staged

LISTED = "task string, file string, name string, folder boolean, length bigint"
#: Schemes of which tasks can list folders themselves.
LISTED_BY_TASKS = ("file", "hdfs", "s3", "gs")
#: Characters that stay as they are in the path of a URI, besides letters and digits.
_PLAIN = "_-!.~'()*,;:$&+=@"
_ROWS = 10_000


def file_kinds(lines: DataFrame, files: DataFrame) -> DataFrame:
    """One row per file: what ``files`` has, and id_only.

    ``lines`` has file and value, and may have task; ``files`` lists every file with its task. A file is ID-only if
    it has a non-empty line and all such lines are digits. Every file counts, also an empty one, which is text,
    as nothing shows that it holds ids.
    """
    on = [c for c in ("task", "file") if c in lines.columns]
    value = strip_ws(F.col("value"))
    seen = (
        lines.withColumn("value", value)
        .filter(F.col("value") != "")
        .groupBy(*on)
        .agg(F.bool_and(is_digits(F.col("value"))).alias("id_only"))
    )
    return files.join(seen, on, "left").withColumn("id_only", F.coalesce("id_only", F.lit(False)))


def task_verdicts(kinds: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row per expected task: file counts and status.

    ``tasks`` has task and present (the folder exists).  The file names stay in
    ``kinds``, one row each, rather than in one array per task.
    """
    counts = kinds.groupBy("task").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if("id_only").alias("n_id_files"),
        F.count_if(~F.col("id_only")).alias("n_text_files"),
        F.min(F.when(F.col("id_only"), F.col("file"))).alias("first_id_file"),
    )
    status = (
        F.when(~F.col("present"), "missing")
        .when(F.col("n_text_files") > 0, "has_text")
        .when(F.col("n_id_files") > 0, "id_only")
        .otherwise("empty")
    )
    zero = {"n_files": 0, "n_id_files": 0, "n_text_files": 0}
    return tasks.join(counts, "task", "left").na.fill(zero).withColumn("status", status).drop("present")


def sample_ids(lines: DataFrame, kinds: DataFrame, n: int = 3) -> DataFrame:
    """Non-empty ones among the first ``n`` lines of an ID file of each task.

    That is the first file, by its path, whose first ``n`` lines aren't all empty.
    ``lines`` also carries block and pos.
    """
    files = kinds.filter("id_only").select("task", "file")
    order = Window.partitionBy("task", "file").orderBy("block", "pos")
    heads = (
        lines.join(files, [c for c in ("task", "file") if c in lines.columns])
        .withColumn("line_no", F.row_number().over(order))
        .filter(F.col("line_no") <= n)
        .select("task", "file", "line_no", strip_ws(F.col("value")).alias("value"))
        .filter(F.col("value") != "")
    )
    first = F.dense_rank().over(Window.partitionBy("task").orderBy("file"))
    return heads.withColumn("_place", first).filter("_place = 1").drop("_place")


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; ``file:/x`` is written with three slashes."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def _child(folder: str, name: str) -> str:
    """URI of a file, as readers write it: characters outside ASCII stay, but for white space."""
    return folder + "/" + "".join(c if c > "\x7f" and not c.isspace() else quote(c, safe=_PLAIN) for c in name)


def _is_checksum(name: str) -> bool:
    """Files that Hadoop's local file system keeps beside others and doesn't list."""
    return name.startswith(".") and name.endswith(".crc")


def is_hidden(path):
    """Whether Spark's readers leave out a file below its task's folder, by the names on its path."""
    return path.rlike(r"(^|/)(\.|_[^/=]*(/|$))|\._COPYING_(/|$)")


def _children(folders: DataFrame) -> DataFrame:
    """What lies directly in each folder, listed where the row is."""

    def listed(batches):
        for batch in batches:
            rows = []
            for task, folder in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = _opened(folder)
                for found in system.get_file_info(fs.FileSelector(path)):
                    inner = found.type == fs.FileType.Directory
                    if inner or not _is_checksum(found.base_name):
                        rows.append((task, _child(folder, found.base_name), found.base_name, inner, found.size or 0))
                    if len(rows) == _ROWS:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows):
        types = [pa.string()] * 3 + [pa.bool_(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, names=["task", "file", "name", "folder", "length"])

    return folders.repartition("file").mapInArrow(listed, LISTED)


def list_files(spark: SparkSession, folders: DataFrame) -> DataFrame:
    """Every file at any depth below ``folders`` (task, file: a folder's URI), hidden and empty ones too: task, file, name, length.

    A frontier of folders is listed by tasks, a level at a time; the driver only learns whether there are folders below. Runs
    jobs when called.
    """
    find_package(spark)
    levels = []
    while True:
        level = staged(_children(folders.select("task", "file")), f"level-{len(levels)}")
        levels.append(level)
        folders = level.filter("folder")
        if folders.isEmpty():
            break
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    return files.filter("not folder").drop("folder")


def _walked(spark: SparkSession, found: list[tuple[str, str]]) -> DataFrame:
    """As ``list_files``, for file systems that only Spark can open: the driver asks for all paths."""
    rows = [(task, uri, uri.rsplit("/", 1)[-1], n) for task, folder in found for uri, n in files_below(spark, folder)]
    return spark.createDataFrame(rows, "task string, file string, name string, length bigint")


def _lines_of(files: DataFrame) -> DataFrame:
    """Lines of files that Spark's readers leave out, each file read by one task, a batch of lines at a time."""

    def batch(rows):
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int64(), pa.int64(), pa.string()])]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "block", "pos", "value"])

    def read(batches):
        for incoming in batches:
            for uri in incoming.column(0).to_pylist():
                system, path = _opened(uri)
                rows = []
                with system.open_input_stream(path, compression=None) as stream:
                    for pos, line in enumerate(io.TextIOWrapper(stream, "utf-8", "replace", newline=None)):
                        rows.append((uri, 0, pos, line.rstrip("\n")))
                        if len(rows) == _ROWS:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    return files.select("file").distinct().repartition("file").mapInArrow(read, "file string, block bigint, pos bigint, value string")


def read_task_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of all files that Spark's readers open below some folders, in one scan: file, block, pos, value."""
    return spark.read.option("recursiveFileLookup", "true").text(paths).select(
        file_uri().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.make_valid_utf8("value").alias("value"),
    )


def inspect_id_only(
    spark: SparkSession, root: str, tasks: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verdict per task, kind per file and sample IDs of the folders ``root/<task>``.

    Hidden files (names beginning with ``_`` or ``.``) count like others, but for checksum files of the local file
    system. Where tasks can't list a file system, hidden files count as text, as only Spark opens files there.
    """
    found = [(task, *e) for task in tasks for e in expanded(spark, f"{root}/{task}") if e[2]]
    present = {task for task, *_ in found}
    expected = spark.createDataFrame([(t, t in present) for t in tasks], "task string, present boolean")
    if not found:
        lines = spark.createDataFrame([], "file string, block bigint, pos bigint, value string")
        kinds = spark.createDataFrame([], "task string, file string, name string, length bigint, id_only boolean")
        return task_verdicts(kinds, expected), kinds, sample_ids(lines, kinds)
    folders = spark.createDataFrame([(task, uri) for task, uri, _, _ in found], "task string, file string")
    lines = read_task_lines(spark, list(dict.fromkeys(path for _, _, path, _ in found)))
    if all(uri.partition(":")[0] in LISTED_BY_TASKS for _, uri, _, _ in found):
        files = staged(list_files(spark, folders), "files")
        below = F.expr("substring(file, length(root) + 2)")
        rooted = files.join(folders.withColumnRenamed("file", "root"), "task")
        lines = lines.unionByName(_lines_of(rooted.filter(is_hidden(below))))
    else:
        files = _walked(spark, [(task, uri) for task, uri, _, _ in found])
    kinds = file_kinds(lines, files)
    return task_verdicts(kinds, expected), kinds, sample_ids(lines, kinds)
