"""Text lines in file order, and runs of lines folded split by split."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import find_package
from .manifest import Located


def read_lines(spark: SparkSession, found: Located, line_sep: str | None = None) -> DataFrame:
    """Lines of all files of a manifest, in one scan: file, block, pos, value.

    A block is the part of a file that one task reads, named by its byte offset. Its lines follow one another in their task,
    and ``pos`` grows along them. Invalid UTF-8 becomes U+FFFD. CR, LF and CRLF end a
    line unless ``line_sep`` names the one to use. ``file`` is the path as Spark has it: ``one_form`` of it is
    for whoever folds the lines, as there are far fewer rows then. May run a job when called.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.option("lineSep", line_sep) if line_sep else reader
    lines = reader.text(found.paths)
    lines = lines.filter(found.wanted(spark))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.make_valid_utf8("value").alias("value"),
    )


def split_starts(batch: pa.RecordBatch, key: list[str]) -> np.ndarray:
    """Places of a batch, but for the first, where the values of ``key`` change."""
    n = batch.num_rows
    differs = np.zeros(max(n - 1, 0), dtype=bool)
    for name in key:
        column = batch.column(name)
        differs |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(differs) + 1


def _folded(batches, key: list[str], carry: list[str], items: list[str], schema: pa.Schema, read):
    """Runs of the rows of a task as Arrow batches; see ``runs_of``."""
    held, identity, number = None, None, 0

    def made(lists, carried, numbers, closed):
        inner = (numbers > 0) & closed
        columns = [*carried, numbers, closed, inner, *lists]
        arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
        out = pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)
        # a run within a split that has no items is nothing; at a split's ends it may still end a sentence
        filled = pc.greater(pc.list_value_length(out.column(len(columns) - 1)), 0).to_numpy(zero_copy_only=False)
        return out.filter(pa.array(filled | ~inner))

    def held_run(more, closed):
        pieces = [pa.concat_arrays([*(p[i] for p in held["pieces"]), *([more[i]] if more else [])]) for i in range(len(items))]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(p)], pa.int32()), p) for p in pieces]
        return made(lists, held["carried"], np.array([number]), np.array([closed]))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends, keep, values = read(batch.column("value"))
        before = np.r_[0, np.cumsum(keep)]
        changes = split_starts(batch, key)
        first = tuple(batch.column(c)[0] for c in key)
        if identity is not None and first != identity:
            if held:
                yield held_run(None, False)
                held = None
            number = 0
        last = ends.copy()
        last[changes - 1] = True
        stops = np.flatnonzero(last)
        starts = np.r_[0, stops + 1]
        k = len(stops)
        fresh = np.isin(starts[:k], changes)
        since = np.maximum.accumulate(np.where(fresh, np.arange(k), -1)) if k else np.empty(0, dtype=int)
        offsets = before[starts]
        # runs that ``made`` leaves out have no number
        stay = fresh | (np.diff(offsets) > 0) | ~ends[stops]
        if k:
            stay[0] |= number == 0 or bool(held and sum(len(p[0]) for p in held["pieces"]))
        ahead = np.r_[0, np.cumsum(stay)]
        numbers = ahead[:k] - np.where(since >= 0, ahead[since], -number)
        done = 0
        if held and k:
            yield held_run([v.slice(0, offsets[1]) for v in values], bool(ends[stops[0]]))
            held, done = None, 1
        if k > done:
            lists = [pa.ListArray.from_arrays(pa.array(offsets[done:], pa.int32()), v) for v in values]
            carried = [batch.column(c).take(pa.array(starts[done:k])) for c in carry]
            yield made(lists, carried, numbers[done:], ends[stops[done:]])
        if k:
            number = int(numbers[-1]) + int(stay[-1]) if starts[k] == n or starts[k] not in changes else 0
        if starts[k] < n:
            rest = [v.slice(offsets[k]) for v in values]
            if held:
                held["pieces"].append(rest)
            else:
                held = {"pieces": [rest], "carried": [batch.column(c).slice(int(starts[k]), 1) for c in carry]}
        identity = tuple(batch.column(c)[n - 1] for c in key)
    if held:
        yield held_run(None, False)


def runs_of(rows: DataFrame, key: list[str], carry: list[str], items: list[str], read) -> DataFrame:
    """Runs of rows up to and including one that ``ends``, within each split, with no shuffle.

    ``read`` takes the ``value`` column of an Arrow batch and returns which rows end a run, which are kept (both as numpy arrays), and the
    ``items``, strings, of those kept. Rows of a split (equal ``key``) must follow one another in
    one task, in order, as files are read. Returns ``carry``, ``pos`` (number of the run in its
    split, without gaps but for what a first run adds to another split), ``closed`` (it ended there), ``inner`` (all of it lies in
    the split for sure) and the ``items`` of the rows to keep as arrays. Runs go out as they end; a task holds an Arrow batch and one open run.
    """
    find_package(rows.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    ddl = [f"{c} {types[c]}" for c in carry] + ["pos bigint", "closed boolean", "inner boolean"]
    schema = StructType.fromDDL(", ".join([*ddl, *(f"{c} array<string>" for c in items)]))
    arrow = to_arrow_schema(schema)
    return rows.select(*carry, "value").mapInArrow(
        lambda batches: _folded(batches, key, carry, items, arrow, read), schema
    )


def chains_of(edges: DataFrame, file: list[str], opens) -> DataFrame:
    """Number the chains of pieces that go on across splits: ``edges``' keys with ``chain``; ``opens`` tells where one begins.

    ``edges`` has about two thin rows for every split of a file.
    """
    order = Window.partitionBy(*file).orderBy("block", "pos")
    opened = edges.withColumn("_opens", opens(order).cast("bigint"))
    chain = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return opened.select(*file, "block", "pos", chain.alias("chain"))


def whole_runs(runs: DataFrame, file: list[str], carry: list[str], items: list[str]) -> DataFrame:
    """Runs of all files: those within a split as they are, the others chained in file order.

    Only the first and the last run of a split can go on in another one. They are chained by their keys alone; the items
    follow by a join, spread over all tasks. ``runs`` are read more than once, so pass a written table.
    """
    whole = runs.filter("inner").select(*carry, "block", "pos", *items)
    edges = runs.filter("not inner")

    def opens(order):
        return F.coalesce(F.lag("closed").over(order), F.lit(True))

    chains = chains_of(edges.select(*file, "block", "pos", "closed"), file, opens)
    others = [c for c in carry if c not in file]
    chained = edges.join(chains, [*file, "block", "pos"]).groupBy(*file, *others, "chain")
    parts = F.sort_array(F.collect_list(F.struct("block", "pos", *items)))
    chained = chained.agg(parts.alias("parts"), F.sum(F.size(items[0])).alias("n")).filter("n > 0")
    first = F.col("parts")[0]
    chained = chained.select(
        *carry,
        first["block"].alias("block"),
        first["pos"].alias("pos"),
        *(F.flatten(F.col("parts")[c]).alias(c) for c in items),
    )
    return whole.unionByName(chained)
