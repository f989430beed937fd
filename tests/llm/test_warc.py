import base64
import gzip
import hashlib
import pathlib
import time

from sangam.llm import warc
from sangam.llm.common import Scratch

ROWS = [
    (1, "u", "a\r\nb"), (2, "u", "a\r\nb"), (3, None, None), (4, "x y\r\nz", ""), (5, "u", "a\r\r\n\r\n"), (6, "u", "\r\n"),
    (7, "u", "\r"), (8, "u", "\n\r\n\r\n"), (None, "u", "q"), (9, "u", "q"), (9, "u", "q"), (10, "u", "x" * (17 << 20)),
    (11, "u", "WARC/1.0\r\n\r\n"), (12, "u", "é"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def archives(spark, rows, archive_bytes=warc.ARCHIVE_BYTES):
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string")
    scratch = Scratch(spark, "warc-test")
    warc.write_monolithic(warc.warc_records(warc.with_revisits(pages, scratch)), f"{scratch.root}/m")
    warc.normalise(spark, f"{scratch.root}/m", f"{scratch.root}/n", archive_bytes)
    return f"{scratch.root}/n"


def test_round_trip(spark):
    out = archives(spark, ROWS)
    got = warc.read_archives(spark, out, payloads=True).collect()
    first = {}
    for page, _, html in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", page)
    want = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        response = first[html or ""] == page
        want.append((page, "response" if response else "revisit", None if response else first[html or ""], len(data), digest(html), data if response else None))
    rows = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(rows, key=lambda r: str(r[:5])) == sorted(want, key=lambda r: str(r[:5]))


def test_every_record_is_a_member_of_its_own(spark):
    out = archives(spark, [r for r in ROWS if r[0] != 10], archive_bytes=900)
    index = spark.read.parquet(f"{out}/index").orderBy("archive", "offset").collect()
    files = {p.parent.name.removeprefix("archive="): p.read_bytes() for p in pathlib.Path(f"{out}/archives").rglob("part-*")}
    assert len(files) > 4
    end = {}
    for r in index:
        assert r.offset == end.get(r.archive, 0)
        end[r.archive] = r.offset + r.length
        assert gzip.decompress(files[r.archive][r.offset : end[r.archive]]).startswith(b"WARC/1.0\r\nWARC-Type: " + r.record_type.encode())
    assert end == {name: len(data) for name, data in files.items()}
    wanted = spark.createDataFrame([tuple(index[0])[:3], tuple(index[-1])[:3]], "archive string, offset long, length long")
    assert warc.fetch(spark, out, wanted).count() == 2


def test_empty_table(spark):
    assert warc.read_archives(spark, archives(spark, [ROWS[0]])).count() == 1
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_records(warc.with_revisits(pages, Scratch(spark, "none"))).count() == 0


def test_members_are_read_in_proportion_to_their_number():
    took = {}
    for n in (2000, 16000):
        content = b"".join(warc.member(b"record %d " % i + b"x" * (i % 700)) for i in range(n))
        start = time.process_time()
        found = list(warc.members_of(content))
        took[n] = time.process_time() - start
        assert [raw[:8] for _, _, raw in found] == [(b"record %d " % k)[:8] for k in range(n)]
        assert sum(length for _, length, _ in found) == len(content)
    assert took[16000] < 24 * took[2000]


def test_archives_without_records(spark):
    out = archives(spark, [])
    assert warc.read_archives(spark, out).collect() == [] if pathlib.Path(f"{out}/archives").exists() else True
    assert spark.read.parquet(f"{out}/index").count() == 0
