"""Which files make up a corpus, in load order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import LOADED, SPLITS
from ..session import expanded, file_uri, path_exists


#: What follows a folder in the path of a file that belongs to it: its name, or partition folders and its name.
BELOW = "(/[^/]*=[^/]*)*/[^/]+$"
#: So many files that no entry lists are left out by name; if there are more, each line is judged.
MOST_NAMED = 10_000


@dataclass(frozen=True)
class SourceFile:
    """One manifest entry; ``path`` is a file, a folder or a glob.

    A missing CoNLL file is an error unless ``required`` says otherwise, a
    missing CSV is skipped.
    """

    source: str
    split: str | None
    path: str
    kind: str = "conll"
    required: bool | None = None

    @property
    def must_exist(self) -> bool:
        return self.kind == "conll" if self.required is None else self.required


@dataclass(frozen=True)
class Located:
    """What a manifest stands for: ``paths`` to read, which of them are folders, and a table of its entries' files and folders.

    ``inner`` are files named by an entry that lie somewhere below a folder of another.
    """

    paths: list[str]
    folders: list[str]
    inner: list[str]
    roots: DataFrame

    def lists(self, file: Column) -> Column:
        """Whether an entry lists a file that reading all paths to any depth comes upon; judged before it is opened."""
        if not self.folders:
            return F.lit(True)
        folders = F.array(*map(F.lit, self.folders))

        def below(folder: Column) -> Column:
            return file.startswith(F.concat(folder, F.lit("/")))

        def directly(folder: Column) -> Column:
            return below(folder) & F.substr(file, F.length(folder) + 1).rlike("^" + BELOW)

        return ~F.exists(folders, below) | F.exists(folders, directly) | file.isin(self.inner)

    def wanted(self, spark: SparkSession) -> Column:
        """``lists`` for the rows of a reader of all paths. Runs a job when called if there are folders.

        Reading all paths seldom comes upon files that no entry lists. They are looked for among the names of the files,
        so that rows are tested against those found only: judging a path takes longer than reading a line.
        """
        if not self.folders:
            return F.lit(True)
        files = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(self.paths)
        others = files.filter(~self.lists(file_uri())).select(F.col("_metadata.file_path").alias("file"))
        names = [row["file"] for row in others.limit(MOST_NAMED + 1).collect()]
        if len(names) > MOST_NAMED:
            return self.lists(file_uri())
        return ~F.col("_metadata.file_path").isin(names) if names else F.lit(True)


def split_files(source: str, pattern: str, kind: str = "conll", splits=SPLITS) -> list[SourceFile]:
    """Entries of a source with one file per split, e.g. ``data/{split}.txt``."""
    return [SourceFile(source, s, pattern.format(split=s), kind) for s in splits]


def locate(spark: SparkSession, manifest: list[SourceFile], kind: str) -> Located | None:
    """Expand the entries of a kind once; None if none of them exists.

    A reader scans all ``paths`` at once, whatever the number of entries, and learns from
    ``entry_of`` which entry a file belongs to.
    """
    rows, read, folders = [], {}, set()
    for rank, entry in enumerate(manifest):
        if entry.kind != kind:
            continue
        found = expanded(spark, entry.path)
        if not found and entry.must_exist:
            raise FileNotFoundError(entry.path)
        for root, path, folder in found:
            rows.append((root, rank, entry.source, entry.split))
            read[root] = path
            if folder:
                folders.add(root)
    if not rows:
        return None
    inner = [root for root in read if root not in folders and any(root.startswith(f"{folder}/") for folder in folders)]
    roots = spark.createDataFrame(rows, "root string, rank bigint, source string, split string")
    return Located(list(read.values()), sorted(folders), inner, roots)


def entry_of(files: DataFrame, roots: DataFrame) -> DataFrame:
    """file, rank, source and split of each of ``files`` (file), once per entry that lists it.

    An entry lists its file, or the files that lie in its folder or in partition folders (``key=value``) below it.
    """
    parts = F.split("file", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    below = F.expr("substring(file, length(root) + 1)")
    listed = files.select("file", F.explode(above).alias("root")).join(roots, "root")
    return listed.filter((below == "") | below.rlike("^" + BELOW)).drop("root")


def empty_source(spark: SparkSession) -> DataFrame:
    """What a source without text, such as one of bare ids, adds to the corpus."""
    return spark.createDataFrame([], LOADED)


def manifest_frame(spark: SparkSession, manifest: list[SourceFile]) -> DataFrame:
    rows = [
        (rank, e.source, e.split, e.path, e.kind, e.must_exist, path_exists(spark, e.path))
        for rank, e in enumerate(manifest)
    ]
    schema = "rank int, source string, split string, path string, kind string, required boolean, present boolean"
    return spark.createDataFrame(rows, schema)


def missing_from(expected: DataFrame, present: DataFrame, on: str | list[str]) -> DataFrame:
    """Expected names that do not occur in ``present``.

    ``present`` may be a whole table: it is reduced to its distinct names first.
    """
    names = [on] if isinstance(on, str) else list(on)
    return expected.join(present.select(*names).distinct(), names, "left_anti")


def missing_files(spark: SparkSession, manifest: list[SourceFile]) -> DataFrame:
    return manifest_frame(spark, manifest).filter(~F.col("present")).drop("present")


def load_report(spark: SparkSession, manifest: list[SourceFile], loaded: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Manifest entries with the sentences of ``loaded`` that came from each, and a status.

    A missing file is ``missing``, or ``failed`` if it must exist; one that is there but gave nothing is ``empty``.
    ``listed`` is the ``manifest_frame`` of the entries as they were read, for whoever has removed files since.
    """
    counts = loaded.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    status = (
        F.when(~F.col("present"), F.when(F.col("required"), "failed").otherwise("missing"))
        .when(n == 0, "empty")
        .otherwise("loaded")
    )
    listed = manifest_frame(spark, manifest) if listed is None else listed
    return listed.join(counts, "rank", "left").withColumn("status", status).withColumn("n", n)
