"""WARC archives: an independent reading, the same bytes on any cluster, rolled files, the commit."""

import base64
import gzip
import hashlib
import re

import pytest

from utterlake.llm import warc
from utterlake.llm.common import shared_dir

BIG = "<p>long</p>" * 60_000
ROWS = [
    (5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, None, "same"), (1, "http://a/ü b\r\nX-Evil: 1", "<html>ünï</html>"), (2, "http://a/2", None), (4, "http://a/4", ""),
    (7, "http://a/7", BIG), (8, "http://a/8", BIG), (None, "http://n/2", "lone"), (None, "http://n/1", "lone"), (None, "http://n/3", "same"), (6, "u", "again"), (6, "u", "again"), (6, "t", "again"),
]


def pages(spark, rows=ROWS, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, row int").repartition(parts)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    out = []
    for page_id, url, html in rows:
        key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
        first = min((r for r in rows if (r[2] or "") == (html or "")), key=key)
        same = key(first) == key((page_id, url))
        out.append((str(page_id), len((html or "").encode()), digest(html), "response" if same else "revisit", str(None if same else first[0])))
    return sorted(out)


def told(df):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in df.collect())


def test_round_trip(spark):
    df = warc.warc_round_trip(pages(spark))
    assert told(df) == expected(ROWS)
    assert df.filter("not intact").isEmpty() and df.select("record_id").distinct().count() == len(ROWS) - 1  # of two equal rows the records are equal
    assert {r.target_uri for r in df.filter("page_id = 1").collect()} == {"http://a/%C3%BC%20b%0D%0AX-Evil:%201"}


def test_another_reader_sees_the_same(spark):
    path = shared_dir(spark, "warc-test").removeprefix("file:")
    m = warc.write_archive(pages(spark), f"file:{path}", least=2000, files=10**9).orderBy("file").collect()
    assert len(m) > 2 and sum(r.n_records for r in m) == len(ROWS)
    seen, ids = [], []
    for r in m:
        data = gzip.open(f"{path}/{r.name}").read()
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        at = 0
        while at < len(data):
            head, _, rest = data[at:].partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            block = rest[: int(fields["Content-Length"])]
            at += len(head) + 4 + len(block) + 4
            if fields["WARC-Type"] == "warcinfo":
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            n = int(re.search(rb"Content-Length: (\d+)", http)[1])
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
            assert len(payload) == (n if fields["WARC-Type"] == "response" else 0)
            seen.append((fields.get("X-Page-ID", "None"), n, fields["WARC-Payload-Digest"][5:], fields["WARC-Type"], fields.get("X-Refers-To-Page-ID", "None")))
            ids.append(int(fields.get("X-Page-ID", 10**9)))
    assert sorted(seen) == expected(ROWS) and ids == sorted(ids)


def test_same_bytes_on_any_partitions(spark):
    sums = lambda n: [(r.name, r.sha256, r.n_bytes) for r in warc.write_archive(pages(spark, parts=n), least=1500, files=10**9).orderBy("file").collect()]
    assert sums(1) == sums(5) and len(sums(2)) > 2


def test_roll_size():
    assert warc.roll_size(0) == warc.LEAST and warc.roll_size(10**15) == warc.MOST and warc.roll_size(64 * 5 * 2**20 + 1) == 5 * 2**20 + 1


def test_commit_again_and_damage(spark):
    path = shared_dir(spark, "warc-test").removeprefix("file:")
    written = warc.write_archive(pages(spark), f"file:{path}").drop("path")
    rows = [(r.file, r.name, "temporary/gone", r.n_records, r.n_bytes, r.sha256, r.first_page_id, r.last_page_id) for r in written.collect()]
    again = warc.commit(spark.createDataFrame(rows, warc.MANIFEST), f"file:{path}")
    assert told(warc.read_records(again)) == expected(ROWS)
    name = again.first().name
    data = bytearray(open(f"{path}/{name}", "rb").read())
    data += gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    open(f"{path}/{name}", "wb").write(data)
    with pytest.raises(Exception, match="isn't as its manifest says"):
        warc.read_records(again).collect()


def test_revisits_only_from_a_size(spark):
    got = warc.read_records(warc.write_archive(pages(spark), revisit_from=6))
    assert {r.page_id for r in got.filter("record_type = 'revisit'").collect()} == {8}


def test_empty(spark):
    assert warc.warc_round_trip(pages(spark, [])).count() == 0


def test_members_in_small_chunks():
    data = b"".join(gzip.compress(x) for x in (b"one", b"", b"three" * 1000))
    for n in (1, 7, 100_000):
        found = list(warc.members(data[i : i + n] for i in range(0, len(data), n)))
        assert [d for _, d in found] == [b"one", b"", b"three" * 1000] and found[0][0] == 0 and gzip.decompress(data[found[2][0] :]) == b"three" * 1000
