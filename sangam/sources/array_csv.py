"""CSV files whose cells hold printed arrays, possibly over several lines."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.arrays import parse_array_repr
from ..functions.text import text_of
from ..operators.ids import gapless
from ..session import find_package, one_form, staged
from .lines import chains_of, read_lines, split_starts
from .manifest import Located, SourceFile, empty_source, entry_of, locate

# A whole field, and lines that leave no quote open: begun outside quotes, and inside.
_FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+)'
_WHOLE = re.compile(rf"{_FIELD}(?:,{_FIELD})*+")
_CLOSING = re.compile(rf'(?:[^"]++|"")*+"[^,]*+(?:,{_FIELD})*+')
#: A header must end in a split that begins among so many first bytes of its file.
HEADER_REACH = 1 << 20
#: The state of a split takes some 200 bytes; of so many the table is broadcast, of more joined by a shuffle.
MOST_BROADCAST = 1 << 18
#: Of so many, the table goes to the Python workers as a whole, rather than along with every line.
MOST_HELD = 1 << 16


#: The state of a split, as it is needed to parse it.
STATE = ("quoted", "started", "words_at", "tags_at")


def rows_to_sentences(rows: DataFrame, words="words", tags="lid", strict=False) -> DataFrame:
    """Parse the array cells of already loaded CSV rows; a missing column counts as empty."""

    def items(name: str):
        cell = F.col(name) if name in rows.columns else F.lit(None).cast("string")
        return parse_array_repr(cell, strict)

    tokens = items(words)
    return rows.select(
        "rank",
        "file",
        "block",
        "pos",
        "source",
        "split",
        text_of(tokens).alias("text"),
        tokens.alias("tokens"),
        items(tags).alias("lid_tags"),
    )


def ended_lines(values: list[str]) -> list[str]:
    """Lines cut at LF, with their ends, cut again at a CR that stands alone."""
    out = []
    for value in values:
        if "\r" not in value[:-1]:
            out.append(value + "\n")
            continue
        parts = value.split("\r")
        out += [part + "\r" for part in parts[:-1]]
        if parts[-1]:
            out.append(parts[-1] + "\n")
        else:
            out[-1] += "\n"
    return out


def stays_quoted(line: str, quoted: bool) -> bool:
    """Whether a quote is open at the end of a line, given whether one is at its start.

    A quote opens only at the start of a field; a doubled one inside quotes stands for itself.
    """
    if '"' not in line:
        return quoted
    return (_CLOSING if quoted else _WHOLE).fullmatch(line[:-1]) is None


def _is_blank(line: str) -> bool:
    return not line.strip(" \t\r\n")


def parsed(lines: list[str]) -> Iterator[tuple[list[str] | None, int, int]]:
    """Records of lines with their ends, and between which lines each lies; None for blank lines between records."""
    csv.field_size_limit(sys.maxsize)
    reader, last = csv.reader(lines), 0
    for row in reader:
        blank = not row or (len(row) == 1 and _is_blank(row[0]) and not any('"' in line for line in lines[last : reader.line_num]))
        yield None if blank else row, last, reader.line_num
        last = reader.line_num


def first_record(text: str) -> list[str]:
    """The fields of the first record of a text; none if there is no record."""
    return next((row for row, _, _ in parsed(list(io.StringIO(text, newline=""))) if row), [])


def _cell(row: list[str], place: int | None) -> str | None:
    return row[place] if place is not None and place < len(row) else None


def _segments(batch: pa.RecordBatch, names) -> Iterator[pa.RecordBatch]:
    starts = [0, *split_starts(batch, names).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(starts, starts[1:]) if b > a)


def _by_split(batches, begin, go_on, end, names=("file", "block")):
    """Call ``begin`` for the first rows of a split, ``go_on`` for its values batch by batch, ``end`` after its last."""
    identity, state = None, None
    for batch in batches:
        for part in _segments(batch, names):
            key = tuple(part.column(name)[0].as_py() for name in names)
            if key != identity:
                if state is not None:
                    yield from end(state)
                identity, state = key, begin(key, part)
            yield from go_on(state, part.column("value"))
    if state is not None:
        yield from end(state)


class _Guess:
    """What a split does if it begins inside quotes, or outside: state at its end, whether a record ends, text up to there."""

    def __init__(self, quoted: bool, near: bool):
        self.quoted, self.ended, self.head = quoted, False, [] if near else None
        self._begun = quoted

    def read(self, line: str) -> None:
        self.quoted = stays_quoted(line, self.quoted)
        if not self.ended:
            if self.head is not None:
                self.head.append(line)
            self._begun = self._begun or not _is_blank(line)
            self.ended = self._begun and not self.quoted


def _split_maps(lines: DataFrame) -> DataFrame:
    """Per split: the state after it, and whether a record ends in it, for either state before it; and text for the header."""

    def begin(key, part):
        near = key[1] < HEADER_REACH
        return key, (_Guess(False, near), _Guess(True, near and key[1] > 0))

    def go_on(state, values):
        _, guesses = state
        at = 0
        while at < len(values) and not all(g.ended or (g.quoted and g.head is None) for g in guesses):
            some = ended_lines(values.slice(at, 64).to_pylist())
            for line in some:
                for guess in guesses:
                    guess.read(line)
            at += 64
        rest = values.slice(at)
        # from here on only quotes change anything
        for line in ended_lines(rest.filter(pc.match_substring(rest, '"')).to_pylist()):
            for guess in guesses:
                guess.read(line)
        return ()

    def end(state):
        key, guesses = state
        heads = [None if g.head is None else "".join(g.head) for g in guesses]
        values = [*key, *(g.quoted for g in guesses), *(g.ended for g in guesses), *heads]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    names = ["file", "block", "after_plain", "after_quoted", "ended_plain", "ended_quoted", "head_plain", "head_quoted"]
    types = [pa.string(), pa.int64(), *[pa.bool_()] * 4, *[pa.string()] * 2]
    schema = "file string, block bigint, after_plain boolean, after_quoted boolean, ended_plain boolean, ended_quoted boolean"
    return lines.select("file", "block", "value").mapInArrow(
        lambda batches: _by_split(batches, begin, go_on, end), f"{schema}, head_plain string, head_quoted string"
    )


def split_states(maps: DataFrame) -> DataFrame:
    """``maps`` with ``quoted``, the state before each split, and ``started``, whether a record ended before it.

    The maps of a file's splits are composed by running aggregates: a split that leads to one state whatever
    came before settles it, one that swaps the states turns it over, any other leaves it.
    """
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    constant = F.when(F.col("after_plain") == F.col("after_quoted"), F.col("after_plain").cast("int"))
    swap = (F.col("after_plain") & ~F.col("after_quoted")).cast("int")
    swaps = F.sum("_swap").over(order.rowsBetween(Window.unboundedPreceding, 0))
    known = maps.withColumns({"_constant": constant, "_swap": swap}).withColumn("_swaps", swaps)
    settled = F.struct(F.col("_constant").alias("state"), F.col("_swaps").alias("swaps"))
    last = F.last(F.when(F.col("_constant").isNotNull(), settled), ignorenulls=True).over(before)
    known = known.withColumns({"_last": last, "_turned": F.coalesce(F.lag("_swaps").over(order), F.lit(0))})
    turned = F.col("_turned") - F.coalesce(F.col("_last.swaps"), F.lit(0))
    known = known.withColumn("quoted", (F.coalesce(F.col("_last.state"), F.lit(0)) + turned) % 2 == 1)
    ended = F.when(F.col("quoted"), F.col("ended_quoted")).otherwise(F.col("ended_plain"))
    known = known.withColumn("_ended", ended).withColumn("started", F.coalesce(F.max("_ended").over(before), F.lit(False)))
    return known.drop("_constant", "_swap", "_swaps", "_last", "_turned")


def _headers(states: DataFrame, words: str, tags: str) -> DataFrame:
    """Per file the places of two columns in its records, null for a column that it doesn't have."""
    piece = F.when(F.col("quoted"), F.col("head_quoted")).otherwise(F.col("head_plain"))
    pieces = F.array_sort(F.collect_list(F.struct("block", F.coalesce(piece, F.lit("")).alias("piece"))))
    head = states.filter("not started").groupBy("file").agg(
        F.array_join(pieces["piece"], "").alias("head"), F.count_if(piece.isNull()).alias("far")
    )

    def places(batches):
        for batch in batches:
            found = [[], []]
            for file, head, far in zip(*(c.to_pylist() for c in batch.columns)):
                if far:
                    raise ValueError(f"the header of {file} is longer than {HEADER_REACH} bytes")
                row = [name.removeprefix("\ufeff") for name in first_record(head)]
                for place, name in zip(found, (words, tags)):
                    place.append(row.index(name) if name in row else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(f, pa.int32()) for f in found)], names=["file", "words_at", "tags_at"]
            )

    return head.mapInArrow(places, "file string, words_at int, tags_at int")


class _Records:
    """Records of a split whose first state is known; what crosses its ends is kept as text."""

    names = ["file", "block", "pos", "begins", "words", "lid", "text"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.string()] * 3]

    def __init__(self, key, quoted: bool, started: bool, places: tuple[int | None, int | None]):
        self.key, self.places, self.pos = key, places, 0
        self.header = None if started else _Guess(quoted, False)
        self.open, self.quoted, self.own = [], quoted, False

    def _row(self, words, lid, text=None, begins=None):
        self.pos += 1
        return self.pos - 1, begins, words, lid, text

    def _whole(self, row):
        return self._row(*(_cell(row, place) for place in self.places))

    def read(self, lines: list[str]) -> list[tuple]:
        out, at = [], 0
        if self.header:
            while at < len(lines) and not self.header.ended:
                self.header.read(lines[at])
                at += 1
            self.quoted = False
            if not self.header.ended:
                return out
            self.header = None
        while self.quoted and at < len(lines):
            self.open.append(lines[at])
            self.quoted = stays_quoted(lines[at], True)
            at += 1
            if not self.quoted:
                out += self._closed()
        rest, row, last, read = lines[at:], None, 0, 0
        for row, last, read in parsed(rest):
            if row:
                out.append(self._whole(row))
        if self._left_open(rest[last:read]):
            if row:
                out.pop()
                self.pos -= 1
            self.open, self.quoted, self.own = rest[last:], True, True
        return out

    @staticmethod
    def _left_open(lines: list[str]) -> bool:
        quoted = False
        for line in lines:
            quoted = stays_quoted(line, quoted)
        return quoted

    def _closed(self) -> list[tuple]:
        lines, self.open = self.open, []
        if self.own:
            self.own = False
            return [self._whole(row) for row, _, _ in parsed(lines) if row]
        return [self._row(None, None, "".join(lines), False)]

    def rest(self) -> list[tuple]:
        """What is open at the split's end."""
        if not self.open:
            return []
        return [self._row(None, None, "".join(self.open), self.own)]


def _split_key():
    """The split of a line as one long, which is passed on in less time than the path of its file."""
    return F.xxhash64("file", "block").alias("split")


def _held(spark: SparkSession, thin: DataFrame):
    """The states of few splits by ``_split_key``, for every Python worker; None if there are too many, or two of one key."""
    rows = thin.select(_split_key(), "file", "block", *STATE).limit(MOST_HELD + 1).collect()
    states = {row[0]: tuple(row[1:]) for row in rows}
    return spark.sparkContext.broadcast(states) if len(states) == len(rows) <= MOST_HELD else None


def _records(lines: DataFrame, held=None) -> DataFrame:
    """Records of lines with the state of their split: cells of those within it, text of those that cross its ends.

    The state comes with each line, or is ``held`` by split.
    """

    def begin(key, part):
        if held is not None:
            file, block, quoted, started, words_at, tags_at = held.value[key[0]]
            return _Records((file, block), quoted, started, (words_at, tags_at))
        quoted, started, words_at, tags_at = (part.column(c)[0].as_py() for c in STATE)
        return _Records(key, quoted, started, (words_at, tags_at))

    def batch_of(state, rows):
        if rows:
            n = len(rows)
            columns = [[state.key[0]] * n, [state.key[1]] * n, *zip(*rows)]
            arrays = [pa.array(c, t) for c, t in zip(columns, _Records.types)]
            yield pa.RecordBatch.from_arrays(arrays, names=_Records.names)

    def go_on(state, values):
        yield from batch_of(state, state.read(ended_lines(values.to_pylist())))

    def end(state):
        yield from batch_of(state, state.rest())

    schema = "file string, block bigint, pos bigint, begins boolean, words string, lid string, text string"
    if held is not None:
        return lines.select(_split_key(), "value").mapInArrow(lambda batches: _by_split(batches, begin, go_on, end, ["split"]), schema)
    return lines.select("file", "block", "value", *STATE).mapInArrow(lambda batches: _by_split(batches, begin, go_on, end), schema)


def _joined(edges: DataFrame, headers: DataFrame) -> DataFrame:
    """Records whose text lies in several splits, from its pieces."""
    chains = chains_of(edges.select("file", "block", "pos", "begins"), ["file"], lambda order: F.col("begins"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "pos", "text")))
    whole = edges.join(chains, ["file", "block", "pos"]).groupBy("file", "chain").agg(pieces.alias("pieces"))
    first = F.col("pieces")[0]
    whole = whole.select("file", first["block"].alias("block"), first["pos"].alias("pos"), F.array_join("pieces.text", "").alias("text"))

    def cells(batches):
        for batch in batches:
            texts, places = batch.column("text").to_pylist(), zip(*(batch.column(c).to_pylist() for c in ("words_at", "tags_at")))
            found = [[_cell(first_record(text), place) for place in two] for text, two in zip(texts, places)]
            words, lid = zip(*found) if found else ((), ())
            columns = [*batch.columns[:3], pa.array(words, pa.string()), pa.array(lid, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "pos", "words", "lid"])

    placed = whole.join(headers, "file").select("file", "block", "pos", "text", "words_at", "tags_at")
    return placed.mapInArrow(cells, "file string, block bigint, pos bigint, words string, lid string")


def csv_cells(spark: SparkSession, found: Located, words: str = "words", tags: str = "lid") -> tuple[DataFrame, DataFrame]:
    """file, block, pos, words and lid of every record of CSV files with a header, each file read by all tasks; and the files.

    No split of a file shows by itself whether it begins inside quotes. So it is first read for what it does to
    either state; the maps of a file's splits, a thin row each, are composed in file order; then every split is
    parsed from its true state. A record that crosses splits is put together from its pieces. Quotes inside an
    unquoted field are characters, lines end in LF, CRLF or CR, blank lines between records are skipped. A file
    whose lines end in CR alone, or that is compressed, is one split. Runs jobs when called.
    """
    find_package(spark)
    lines = read_lines(spark, found, line_sep="\n")
    states = staged(split_states(staged(_split_maps(lines), "csv-maps")), "csv-states")
    headers = staged(_headers(states, words, tags), "csv-headers")
    thin = staged(states.select("file", "block", "quoted", "started").join(headers, "file"), "csv-splits")
    splits = thin.count()
    held = _held(spark, thin) if splits <= MOST_HELD else None
    if held is not None:
        known = lines
    elif splits <= MOST_BROADCAST:
        known = lines.join(F.broadcast(thin), ["file", "block"])
    else:
        known = lines.join(thin, ["file", "block"]).sortWithinPartitions("file", "block", "pos")
    records = staged(_records(known, held), "csv-records")
    whole = records.filter("text is null").select("file", "block", "pos", "words", "lid")
    cells = whole.unionByName(_joined(records.filter("text is not null"), headers))
    uri = one_form(F.col("file"))
    return cells.withColumn("file", uri), headers.select(uri.alias("file"))


def read_array_csv(
    spark: SparkSession,
    manifest: list[SourceFile],
    words: str = "words",
    tags: str = "lid",
    strict: bool = False,
) -> DataFrame:
    """Sentences of the CSV entries of a manifest, in the ``LOADED`` schema.

    Columns are found by name in each file, however many it has. A file without one of them has empty arrays
    there. All entries are read in one scan, and a large file by many tasks. Runs jobs when called; after them the files aren't read again.
    """
    found = locate(spark, manifest, "array_csv")
    if found is None:
        return empty_source(spark)
    cells, files = csv_cells(spark, found, words, tags)
    entries = staged(entry_of(files, found.roots), "entries")
    return gapless(rows_to_sentences(cells.join(entries, "file"), "words", "lid", strict))
