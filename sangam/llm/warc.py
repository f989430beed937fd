"""WARC archives: written as one gzip stream per file, normalised to a member per record, read back.

Everything that touches files is Spark's: the text sink and source carry bytes as they
are, decode and encode gzip as streams, and work on any file system that Spark knows. A row
ended by CR LF is a line of an archive, so a whole-file stream is inflated once, line
by line, by one task, whose memory holds the record it is reading.

The normaliser writes every record as its own gzip member. The text sink ends each row with a
separator; the separator is one zero byte, which is the last byte of every member whose record
has less than 16 MiB (the highest byte of its length), so the member is handed over without it.
A longer record is followed by an empty member, which ends in a zero byte, too. Files are plain
concatenations of members, as any WARC reader takes them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import Scratch, table

#: Fixed values of the format.
VERSION = b"WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Bytes of payload per archive, about; a larger record has an archive for itself.
ARCHIVE_BYTES = 32 << 20
_EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()
_ONE_BYTE_SHORT = 1 << 24


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from 20 bits (five hexadecimal digits) at a time."""
    digits = F.sha1(data)
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        for place in range(4):
            five = F.shiftright(bits, 15 - 5 * place).bitwiseAND(31)
            letters.append(F.substring(F.lit(BASE32), five + 1, F.lit(1)))
    return F.concat(*letters)


def with_revisits(pages: DataFrame, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    The smallest page_id of each payload of at least ``min_bytes`` bytes is counted out by a
    partial aggregate, so equal payloads, however many, meet as one row per task; the
    join back may be split by the adaptive planner, as the table of firsts is a written one.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    keys = rows.select("payload_digest", "payload_bytes", "page_id")
    firsts = keys.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
    firsts = firsts.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    firsts = scratch.keep(firsts, "firsts")
    # only pages whose payload occurs twice need to know; thin rows meet, payloads stay where they are
    revisits = keys.join(firsts, ["payload_digest", "payload_bytes"]).filter("page_id > first or page_id is null and first is not null")
    revisits = revisits.select(F.col("page_id").alias("__page"), "payload_digest", F.col("first").alias("refers_to")).distinct()
    revisits = scratch.keep(revisits, "revisits").withColumnRenamed("payload_digest", "__digest")
    rows = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("payload_digest") == F.col("__digest")), "left")
    return rows.drop("__page", "__digest").withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def _uuid(digits: Column) -> Column:
    cuts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def warc_records(pages: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """``record``, the bytes of a WARC record but for its last CR LF, of each row of ``with_revisits``.

    The page id stands in the record id and in WARC-Page-ID. The block is an HTTP response;
    of a revisit it has the headers only, whose Content-Length is that of the full payload. Control
    characters and blanks in a URL are written as %20; a null URL becomes urn:page:<id>.
    """

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def record_id(page: str) -> Column:
        return _uuid(F.md5(F.concat_ws("|", F.col("payload_digest"), F.col(page).cast("string"))))

    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(F.encode(http, "UTF-8"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    url = F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))), r"[\x00-\x20\x7f]", "%20")
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", record_id("refers_to")), line("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string")))).otherwise(""),
        F.when(F.col("page_id").isNotNull(), line("WARC-Page-ID", F.col("page_id").cast("string"))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return pages.select(F.concat(F.encode(head, "UTF-8"), block, F.lit(b"\r\n")).alias("record"))


def write_monolithic(records: DataFrame, path: str) -> None:
    """One gzip stream per task: records one after the other, compressed as a whole."""
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n").text(path, compression="gzip")


def _header(lines: list[bytes]) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class RecordReader:
    """Takes the CR LF lines of one archive in order and returns each record as it ends."""

    def __init__(self):
        self.head: list[bytes] = []
        self.block: list[bytes] | None = None
        self.size = 0

    def line(self, line: bytes) -> tuple[list[bytes], bytes] | None:
        if self.block is None:
            if line:
                if not self.head and line != VERSION and not line.startswith(b"WARC/"):
                    raise ValueError(f"no WARC record begins with {line[:40]!r}")
                self.head.append(line)
            elif self.head:
                length = _header(self.head[1:]).get(b"content-length")
                if length is None:
                    raise ValueError(f"a record has no Content-Length: {self.head[:3]!r}")
                self.block, self.size, self.left = [], int(length), int(length) + 2
            return None
        self.block.append(line)
        self.left -= len(line) + 2
        if self.left > 0:
            return None
        if self.left < 0:
            raise ValueError(f"a record is longer than its Content-Length: {self.head[:3]!r}")
        record = self.head, b"\r\n".join(self.block)
        self.head, self.block = [], None
        return record

    def end(self) -> None:
        if self.head or self.block is not None:
            raise ValueError("an archive ends within a record")


def member(record: bytes, level: int = 6) -> bytes:
    """The record as a gzip member that ends in a zero byte."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed = packer.compress(record) + packer.flush()
    return packed if len(record) < _ONE_BYTE_SHORT else packed + _EMPTY_MEMBER


MEMBERS = "archive string, seq long, member binary"


def normalised(spark: SparkSession, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Members of all records of the monolithic archives below ``path``, in order by archive.

    A gzip stream can't be entered in the middle, so a file is one task's; the task reads
    lines and holds one record. Files without records give none; broken ones raise.
    """
    lines = spark.read.option("lineSep", "\r\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))

    def rewritten(incoming):
        file, reader, rows, held = None, RecordReader(), [], 0
        name, archive, seq, raw = "", 0, 0, 0
        fields = [x.split()[0] for x in MEMBERS.split(", ")]

        def out():
            columns = list(zip(*rows))
            kinds = [pa.string(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=fields)

        for batch in incoming:
            for one, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if one != file:
                    reader.end()
                    file, reader, archive, seq, raw = one, RecordReader(), 0, 0, 0
                    name = re.sub(r"[^A-Za-z0-9-]", "_", one.rpartition("/")[2].partition(".")[0])
                found = reader.line(line)
                if found is None:
                    continue
                head, block = found
                whole = b"\r\n".join([*head, b"", block, b"", b""])
                if raw and raw + len(whole) > archive_bytes:
                    archive, seq, raw = archive + 1, 0, 0
                packed = member(whole)
                rows.append((f"{name}-{archive:05}", seq, packed))
                seq, raw, held = seq + 1, raw + len(whole), held + len(packed)
                if held > 8 << 20:
                    yield out()
                    rows, held = [], 0
        reader.end()
        if rows:
            yield out()

    return lines.mapInArrow(rewritten, MEMBERS)


def normalise(spark: SparkSession, path: str, out: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Rewrite the archives of ``path`` as ``out``/archives/archive=<name>/, indexed in ``out``/index (Parquet).

    Members go from the stream that is inflated to the file without a shuffle. The index is
    written from the finished archives, read back: archive, offset and length of every record, and what it
    holds, with payloads checked against their digests. Returns the index.
    """
    shortened = F.expr("substring(member, 1, length(member) - 1)").cast("string").alias("value")
    # rows come in this order; saying so keeps the writer from sorting by archive alone
    ordered = normalised(spark, path, archive_bytes).sortWithinPartitions("archive", "seq").select("archive", shortened)
    ordered.write.option("lineSep", "\x00").partitionBy("archive").text(f"{out}/archives")
    found = read_archives(spark, out)
    found.write.parquet(f"{out}/index")
    return spark.read.schema(found.schema).parquet(f"{out}/index")


def parse_record(whole: bytes) -> tuple:
    """record_type, page_id, refers_to, payload_bytes, payload_digest, payload of a record's bytes."""
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = _header(head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
    kind = fields[b"warc-type"].decode()
    page, refers = (int(fields[f]) if f in fields else None for f in (b"warc-page-id", b"warc-refers-to-page-id"))
    if kind == "revisit":
        return kind, page, refers, int(_header(http.split(b"\r\n")[1:])[b"content-length"]), digest, None
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if found != digest:
        raise ValueError(f"payload of page {page} has digest {found}, its record says {digest}")
    return kind, page, refers, len(payload), digest, payload


def members_of(content: bytes):
    """(offset, length, bytes) of each member of a normalised archive; empty members belong to the one before.

    A member is fed in growing pieces, so what is read beyond its end, and copied, is no more than the member itself.
    """
    view, at, held = memoryview(content), 0, None
    while at < len(content):
        unpacker, parts, end, step = zlib.decompressobj(31), [], at, 512
        while not unpacker.eof:
            if end >= len(content):
                raise ValueError(f"the member at byte {at} is cut short")
            piece = view[end : end + step]
            parts.append(unpacker.decompress(piece))
            end, step = end + len(piece), min(2 * step, 1 << 20)
        end -= len(unpacker.unused_data)
        raw = b"".join(parts)
        if raw or held is None:
            if held is not None:
                yield held
            held = (at, end - at, raw)
        else:
            held = (held[0], end - held[0], held[2])
        at = end
    if held is not None:
        yield held


RECORDS = "archive string, offset long, length long, record_type string, page_id long, refers_to long, payload_bytes long, payload_digest string"


def read_archives(spark: SparkSession, out: str, payloads: bool = False) -> DataFrame:
    """All records of the normalised archives; with ``payloads`` their bytes, too (null for revisits)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out}/archives")
    schema = RECORDS + (", payload binary" if payloads else "")
    files = files.select(F.regexp_extract("path", r"archive=([^/]+)/", 1).alias("archive"), "content")
    kinds = [pa.string(), *[pa.int64()] * 2, pa.string(), *[pa.int64()] * 3, pa.string(), pa.binary()][: 8 + payloads]
    names = [x.split()[0] for x in schema.split(", ")]

    def records(incoming):
        for batch in incoming:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for offset, length, whole in members_of(content.as_py()):
                    rows.append((archive, offset, length, *parse_record(whole)[: 5 + payloads]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return files.mapInArrow(records, schema)


def fetch(spark: SparkSession, out: str, wanted: DataFrame) -> DataFrame:
    """Payloads of some records by index: ``wanted`` has archive, offset and length.

    Each archive is read by one task, which inflates the wanted members alone.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{out}/archives")
    files = files.select(F.regexp_extract("path", r"archive=([^/]+)/", 1).alias("archive"), "content")
    # an archive's size bounds the list of its places
    places = wanted.groupBy("archive").agg(F.collect_set(F.struct("offset", "length")).alias("places"))

    def payloads(batch):
        columns = {"archive": [], "offset": [], "payload": []}
        for archive, content, spots in zip(*(c.to_pylist() for c in batch.columns)):
            for spot in spots:
                whole = zlib.decompress(content[spot["offset"] : spot["offset"] + spot["length"]], 31)
                for name, value in zip(columns, (archive, spot["offset"], parse_record(whole)[5])):
                    columns[name].append(value)
        return columns

    from .common import arrow_rows

    return arrow_rows(files.join(places, "archive").select("archive", "content", "places"), payloads, "archive string, offset long, payload binary")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    pages = with_revisits(table(spark, sf_dir, "pages"), scratch)
    write_monolithic(warc_records(pages), f"{scratch.root}/monolithic")
    records = normalise(spark, f"{scratch.root}/monolithic", f"{scratch.root}/normal")
    scratch.drop("monolithic", "revisits", "firsts")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
