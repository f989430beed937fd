"""Session helpers: local sessions for tests and bench, and the shared work folder."""

from __future__ import annotations

import os
import pathlib
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def local_session(cores="*", shuffle_partitions=8, app="sangam", **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read, as named by ``spark.checkpoint.dir``.

    Only a session of one process may fall back to a temporary folder, and its own
    checkpoint setting stays as it is: on a cluster a machine-local path would be lost
    together with its executor, so there the setting is required and ``file:`` folders
    are up to the caller to share.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^,]*(, *\d+)?\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        folder = _own_folders.setdefault(context.applicationId, None) or tempfile.mkdtemp(prefix="sangam-")
        _own_folders[context.applicationId] = folder
    return folder.rstrip("/")


#: Per application: the fallback folder of a one-process session, and the folder of this job.
_own_folders: dict[str, str | None] = {}
_job_folders: dict[str, str] = {}


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def job_folder(spark: SparkSession) -> str:
    """One folder per application below the shared folder; it goes when the session's JVM ends."""
    application = spark.sparkContext.applicationId
    if application not in _job_folders:
        folder = f"{shared_folder(spark)}/sangam-{uuid.uuid4().hex}"
        fs, hadoop_path = _hadoop(spark, folder)
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
        _job_folders[application] = folder
    return _job_folders[application]


@contextmanager
def staging(spark: SparkSession):
    """Within this block, tables are staged below a folder of its own, which goes at its end.

    What is returned from the block must not read them any more.
    """
    application = spark.sparkContext.applicationId
    outer = job_folder(spark)
    folder = _job_folders[application] = f"{outer}/job-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        _job_folders[application] = outer
        remove(spark, folder)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{job_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that this job wrote below its own folder."""
    if not path.startswith(job_folder(spark) + "/"):
        raise ValueError(f"{path} is not below the folder of this job")
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def remove_all(spark: SparkSession) -> None:
    """Delete every table this job staged; results that still read them can't be read again."""
    folder = _job_folders.pop(spark.sparkContext.applicationId, None)
    if folder:
        fs, hadoop_path = _hadoop(spark, folder)
        fs.delete(hadoop_path, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of what is written within this block go as each write ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the written table.

    Cuts the lineage, so that an operator that needs several passes neither
    recomputes its input nor depends on blocks held by one executor.
    """
    path = fresh_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set column ``name``, evaluated once per row.

    Spark would copy a costly expression into every filter on the column that it
    pushes down; it does not push filters on generated columns below the generator.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def expanded(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """Files and folders that a path or pattern stands for: URI as ``file_uri`` has it, path to read it by, is a folder.

    The path to read has the characters escaped that would make a pattern of it.
    """
    fs, hadoop_path = _hadoop(spark, path)
    found = []
    for status in fs.globStatus(hadoop_path) or []:
        plain = status.getPath()
        literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", plain.toString())
        found.append((_one_slash(plain.toUri().toString()), literal, status.isDirectory()))
    return found


def _one_slash(uri: str) -> str:
    return uri.replace(":///", ":/", 1)


def one_form(path: Column) -> Column:
    """A file's path as Spark's readers name it, as a URI in one form: no slashes for an empty authority."""
    return F.replace(path, F.lit(":///"), F.lit(":/"))


def file_uri() -> Column:
    """URI of the file that a row was read from, as ``one_form`` has it."""
    return one_form(F.col("_metadata.file_path"))


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(expanded(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it; one that exists stays as it is."""
    fs, hadoop_path = _hadoop(spark, path)
    fs.mkdirs(hadoop_path)


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.

    Executors elsewhere need it installed, or sent with ``addPyFile``.
    """
    root = str(pathlib.Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def files_below(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """URIs and lengths of all files at any depth, hidden and empty ones too."""
    fs, hadoop_path = _hadoop(spark, folder)
    found, files = [], fs.listFiles(hadoop_path, True)
    while files.hasNext():
        status = files.next()
        found.append((_one_slash(status.getPath().toUri().toString()), status.getLen()))
    return found
