"""Fill-in-the-middle over seekable compressed frames.

A text is held as zstandard frames that don't depend on each other, each of at most
``UNITS`` code points, with the number of code points up to the end of every frame. A cut
is found in the counts, and only the frame it falls in is decompressed and split; frames
between cuts pass on as they are, so that the transformed text is made of the stored frames, a
split frame or two and the marks. Digests are taken frame by frame in order. Restoring finds the marks in
one pass over the frames and then reads the three parts in their first order. Beside the text
that Spark hands over, a task holds one frame of plain text.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable, Iterator

import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import Scratch, arrow_rows, table

#: Code points in a frame at most.
UNITS = 1 << 13
#: What precedes the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: Percent of texts that stay plain, and percent of the others whose suffix comes first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
_LEVEL = 1

STORE = "doc_id long, ends array<long>, frames array<binary>"


class Frames:
    """Text as independent compressed frames; ``ends[i]`` counts the units up to the end of frame i."""

    def __init__(self, ends: Iterable[int] = (), frames: Iterable[bytes] = ()):
        self.ends, self.frames = list(ends), list(frames)
        self._pack = zstandard.ZstdCompressor(level=_LEVEL)
        self._unpack = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    @classmethod
    def of(cls, text: str, units: int = UNITS) -> Frames:
        made = cls()
        for at in range(0, len(text), units):
            made.append(text[at : at + units])
        return made

    def append(self, text: str) -> None:
        """Add a frame with this text; none for an empty one."""
        if text:
            self._add(len(text), self._pack.compress(text.encode("utf-8", "surrogatepass")))

    def _add(self, units: int, frame: bytes) -> None:
        self.ends.append(len(self) + units)
        self.frames.append(frame)

    def plain(self, i: int) -> str:
        return self._unpack.decompress(self.frames[i]).decode("utf-8", "surrogatepass")

    def _touched(self, start: int, stop: int) -> Iterator[tuple[int, int, int, bool]]:
        """Frames that hold units start to stop, and from where to where in them, and whether that is all of the frame."""
        i = bisect.bisect_right(self.ends, start)
        while start < stop:
            first, last = (self.ends[i - 1] if i else 0), self.ends[i]
            end = min(stop, last)
            yield i, start - first, end - first, start == first and end == last
            start, i = end, i + 1

    def copy(self, source: Frames, start: int, stop: int) -> None:
        """Add units start to stop of another text; only frames that are cut are decompressed."""
        for i, a, b, whole in source._touched(start, stop):
            if whole:
                self._add(b, source.frames[i])
            else:
                self.append(source.plain(i)[a:b])

    def read(self, start: int, stop: int) -> Iterator[str]:
        """Units start to stop, a frame's part at a time."""
        for i, a, b, _ in self._touched(start, stop):
            yield self.plain(i)[a:b]

    def find(self, marks: tuple[str, ...]) -> list[int]:
        """First place of each mark, all of three units, -1 for none; a frame at a time, the ends of frames joined."""
        places, tail, at = [-1] * len(marks), "", 0
        for piece in self.read(0, len(self)):
            piece = tail + piece
            for k, mark in enumerate(marks):
                if places[k] < 0 and (found := piece.find(mark)) >= 0:
                    places[k] = at + found
            tail = piece[-2:]
            at += len(piece) - len(tail)
        return places


def sha256_of(pieces: Iterable[str]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece.encode("utf-8", "surrogatepass"))
    return digest.hexdigest()


def draws(doc_id: int | None, seed: int = 1) -> list[int]:
    """Four unsigned integers from the seed and the document's number; a null number counts as no digits."""
    hexadecimal = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hexadecimal[8 * i : 8 * i + 8], 16) for i in range(4)]


def transform(text: Frames, doc_id: int | None, seed: int = 1) -> tuple[str, int, int, Frames]:
    """Form (plain, psm or spm), the two cuts, and the transformed text."""
    n = len(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if n == 0 or h3 % 100 >= 100 - PLAIN_PERCENT or max(text.find(MARKS)) >= 0:
        return "plain", 0, 0, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "spm" if h4 % 100 < SUFFIX_FIRST_PERCENT else "psm"
    parts = {PREFIX: (0, first), MIDDLE: (first, second), SUFFIX: (second, n)}
    made = Frames()
    for mark in (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE):
        made.append(mark)
        made.copy(text, *parts[mark])
    return form, first, second, made


def restored(made: Frames, form: str) -> Iterator[str]:
    """The text before ``transform``, from the transformed one and its form alone.

    No part holds a mark, and no mark begins inside another, so each mark's first place is its own.
    """
    if form == "plain":
        yield from made.read(0, len(made))
        return
    places = dict(zip(MARKS, made.find(MARKS)))
    order = sorted(places, key=places.get)
    stops = {mark: places[after] for mark, after in zip(order, order[1:])} | {order[-1]: len(made)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from made.read(places[mark] + len(mark), stops[mark])


def store_frames(docs: DataFrame, units: int = UNITS) -> DataFrame:
    """doc_id, ends and frames of every row of ``docs`` (doc_id, text); null texts have no frames, like empty ones."""

    def stored(batch):
        texts = [Frames.of(text or "", units) for text in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "ends": [t.ends for t in texts], "frames": [t.frames for t in texts]}

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_rows(docs, stored, STORE)


def fill_in_middle(store: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, ends and frames of the transformed text of every stored row.

    Cuts depend on doc_id, the length and the seed alone: repeated rows get equal results, a null doc_id
    counts as a number without digits. Empty texts, and texts that hold a mark, stay plain; so does one in ten of
    the others. Prefix, middle and suffix may be empty. No cut depends on other rows, so an empty table gives an empty result.
    """

    def made(batch):
        ids, ends, frames = (batch.column(i).to_pylist() for i in range(3))
        out = {name: [] for name in ("n", "form", "prefix_chars", "middle_chars", "ends", "frames")}
        for doc_id, e, f in zip(ids, ends, frames):
            text = Frames(e or (), f or ())
            form, first, second, whole = transform(text, doc_id, seed)
            plain = form == "plain"
            values = (len(text), form, None if plain else first, None if plain else second - first, whole.ends, whole.frames)
            for name, value in zip(out, values):
                out[name].append(value)
        return {"doc_id": batch.column(0)} | out

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, ends array<long>, frames array<binary>"
    return arrow_rows(store.select("doc_id", "ends", "frames"), made, schema)


def texts_of(made: DataFrame, restore: bool = False) -> DataFrame:
    """doc_id, form and the text of every row of ``fill_in_middle``, or the text that was there before."""

    def read(batch):
        rows = [Frames(e, f) for e, f in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        forms = batch.column(1).to_pylist()
        pieces = (restored(t, form) if restore else t.read(0, len(t)) for t, form in zip(rows, forms))
        return {"doc_id": batch.column(0), "form": batch.column(1), "text": ["".join(p) for p in pieces]}

    return arrow_rows(made.select("doc_id", "form", "ends", "frames"), read, "doc_id long, form string, text string")


def digests(made: DataFrame) -> DataFrame:
    """Rows of ``fill_in_middle`` without their frames, with digests of the transformed and of the restored text."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def digested(batch):
        out = {name: batch.column(i) for i, name in enumerate(names)} | {"output_sha256": [], "restored_sha256": []}
        for form, e, f in zip(*(batch.column(i).to_pylist() for i in (2, 5, 6))):
            whole = Frames(e, f)
            out["output_sha256"].append(sha256_of(whole.read(0, len(whole))))
            out["restored_sha256"].append(sha256_of(restored(whole, form)))
        return out

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return arrow_rows(made.select(*names, "ends", "frames"), digested, schema)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "fill-in-middle")
    store = scratch.keep(store_frames(table(spark, sf_dir, "documents")), "store")
    return digests(fill_in_middle(store))
