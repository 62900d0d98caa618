"""WARC archives: a deterministic sharded writer, and a reader of what it has written.

Writing, in four steps:

1. Each page becomes a response record with headers and digests (SHA-1) made anew, a gzip member of its own. At first only its
   key, digest and compressed size are kept (a narrow table); making it once more in step 3 costs less than storing it in between.
2. Keys, digests and sizes alone go on. Of the records with one digest and at least `revisit_from` bytes, that with the smallest page_id
   stays a response, the others become revisits of it (headers only). What is left is range-sorted by (page_id, url, digest). Running
   sums of sizes give each record its place in the whole archive; files roll over at multiples of a size. So a record's file depends
   on the data, not on partitions.
3. Records are dealt by file, in one shuffle: the files' first keys (a row each, however many records) tell where a record goes, and
   the revisit that takes its place, if any, goes there as well. A task writes a file from its sorted rows to a temporary name, and
   reports a manifest row.
4. The manifest is stored; then each temporary file is renamed to its final name (once more after a lost task is no harm), and the
   manifest is written beside the files. An archive without its manifest doesn't count. Files that lost attempts have
   left behind have other temporary names and go with the temporary folder.

The same pages give the same bytes, whatever the cluster: no time, host or random name goes into a file. A file's size grows from
LEAST to MOST bytes so that an archive has about FILES files or more; both bounds are parameters.

read_records() streams each file of the manifest and computes lengths and digests from the stored bytes; revisits carry those of the
payload they refer to in their headers. A file's bytes are checked against the manifest on the way.

Defined cases: null html is an empty payload; a null page_id is greater than all others (of rows without any, the first by url is the
response and refers_to is null); of rows that repeat a page_id and a payload the first by url is the response, and of rows that are the same in
all three every one is (they stand in one file); a null url and characters that no header may hold are left out and percent-encoded; very long pages are one record
each; an empty table gives an empty manifest; extra columns are ignored; each input row gives one record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from utterlake.llm.common import shared_dir, small_batches, stored, table
from utterlake.llm.media_store import arrow_uri

KEY = ("page_id", "url", "digest")
LEAST, MOST, FILES = 1024 * 1024, 1024 * 1024 * 1024, 64
MANIFEST = "file long, name string, temporary string, n_records long, n_bytes long, sha256 string, first_page_id long, last_page_id long"
RECORDS = (
    "name string, offset long, page_id long, record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, "
    "refers_to long, intact boolean"
)
#: Printable characters of a URL that stay as they are.
URL_SAFE = "!#$%&'()*+,/:;=?@[]~-._"
READ = 1 << 16


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(*of: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(repr, of)))}>"


def _headed(first: str, fields: list[tuple[str, object]], body: bytes) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields if v is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body


def make_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit (payload None) has the HTTP headers of its payload only."""
    revisit = payload is None
    http = _headed("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)], payload or b"")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_urn(page_id, url, digest)), ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe=URL_SAFE) if url else None), ("X-Page-ID", page_id),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("X-Refers-To-Page-ID", refers_to if revisit else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(http)}"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(http)),
    ]
    return _member(_headed("WARC/1.1", fields, http + b"\r\n\r\n"))


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # its header has no time and no name
    return packer.compress(data) + packer.flush()


def file_info(name: str, date: str) -> bytes:
    """The warcinfo record that begins a file."""
    body = b"software: utterlake\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_urn(name)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]
    return _member(_headed("WARC/1.1", fields, body + b"\r\n\r\n"))


def _read_fields(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = data.partition(b"\r\n\r\n")
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:]), body


def parse_record(data: bytes) -> tuple | None:
    """(page_id, record_id, record_type, target_uri, payload_bytes, payload_digest, refers_to, intact) of one record; None for a file's own."""
    fields, rest = _read_fields(data)
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[: int(fields["Content-Length"])]
    told, payload = _read_fields(block)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    intact = fields["WARC-Block-Digest"] == f"sha1:{base32_sha1(block)}" and rest[len(block) :] == b"\r\n\r\n"
    number = lambda k: int(fields[k]) if k in fields else None
    if fields["WARC-Type"] == "response":
        own = base32_sha1(payload)
        intact, digest, size = intact and own == digest and len(payload) == int(told["Content-Length"]), own, len(payload)
    else:
        size = int(told["Content-Length"])
    return number("X-Page-ID"), fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Target-URI"), size, digest, number("X-Refers-To-Page-ID"), intact


def members(chunks: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of a file's gzip members; one is held at a time."""
    at, used, unpack, parts = 0, 0, zlib.decompressobj(31), []
    for chunk in chunks:
        while chunk:
            parts.append(unpack.decompress(chunk))
            rest = unpack.unused_data
            used += len(chunk) - len(rest)
            if unpack.eof:
                yield at, b"".join(parts)
                at, used, unpack, parts = at + used, 0, zlib.decompressobj(31), []
            chunk = rest


def _ids(df: DataFrame, *names: str) -> DataFrame:
    """df with whole-number columns that may be null as decimals: pandas has no such whole numbers."""
    return df.withColumns({c: F.col(c).cast("decimal(20, 0)") for c in names})


def _whole(x) -> int | None:
    return None if pd.isna(x) else int(x)


def responses(pages: DataFrame, date: str, members: bool) -> DataFrame:
    """page_id, url, digest (of the payload), n_bytes, size, member (the gzip bytes, null unless asked for) of each page's response record."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                digest = base32_sha1(payload)
                member = make_record(_whole(page_id), url, payload, len(payload), digest, None, date)
                out.append((page_id, url, digest, len(payload), len(member), member if members else None))
            yield pd.DataFrame(out, columns=["page_id", "url", "digest", "n_bytes", "size", "member"])

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    made = _ids(own, "page_id").mapInPandas(make, "page_id decimal(20, 0), url string, digest string, n_bytes long, size long, member binary")
    return made.withColumn("page_id", F.col("page_id").cast("long"))


def _order() -> Column:
    """A place among rows of one payload: by page_id, null last, then url."""
    return F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.coalesce("url", F.lit("")).alias("url"))


def with_revisits(records: DataFrame, revisit_from: int, date: str) -> DataFrame:
    """KEY's columns, size and `revisit`: the member of a record that refers to another, null for responses. Payloads aren't read."""
    own = records.select(*KEY, "n_bytes", "size")
    first = own.filter(F.col("n_bytes") >= revisit_from).groupBy("digest").agg(F.min(_order()).alias("first"))
    rows = own.join(first, "digest", "left").withColumn("later", F.col("first").isNotNull() & (_order() != F.col("first")))
    rows = rows.select(*KEY, "n_bytes", "size", F.col("later"), F.col("first.page_id").alias("refers_to"))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, sizes = [], []
            for page_id, url, digest, n, size, later, first in zip(*(batch[c] for c in (*KEY, "n_bytes", "size", "later", "refers_to")), strict=True):
                out.append(make_record(_whole(page_id), url, None, n, digest, _whole(first), date) if later else None)
                sizes.append(len(out[-1]) if later else size)
            yield batch[list(KEY)].assign(size=sizes, revisit=pd.Series(out, dtype=object, index=batch.index))

    made = _ids(rows, "page_id", "refers_to").mapInPandas(make, "page_id decimal(20, 0), url string, digest string, size long, revisit binary")
    return made.withColumn("page_id", F.col("page_id").cast("long"))


def roll_size(total: int, least: int = LEAST, most: int = MOST, files: int = FILES) -> int:
    return max(least, min(most, -(-total // files)))


def _in_order() -> list[Column]:
    return [F.col("page_id").asc_nulls_last(), F.col("url").asc_nulls_first(), F.col("digest")]


def _place(page_id, url, digest) -> tuple:
    """The same order in Python."""
    return (page_id is None, page_id or 0, url is not None, url or "", digest)


def placed(records: DataFrame, least: int = LEAST, most: int = MOST, files: int = FILES) -> DataFrame:
    """with_revisits() with file and at: the record's place in the whole archive, in compressed bytes."""
    ranged = records.repartitionByRange(*_in_order()).sortWithinPartitions(*_in_order())
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "warc-order")
    sums = ranged.groupBy("part").agg(F.sum("size").alias("n")).collect()  # one row a partition
    starts, so_far = [], 0
    for r in sorted(sums):
        starts.append((r["part"], so_far))
        so_far += r["n"]
    before = F.broadcast(records.sparkSession.createDataFrame(starts, "part int, before long"))  # as many rows
    own = F.sum("size").over(Window.partitionBy("part").orderBy(*_in_order()).rowsBetween(Window.unboundedPreceding, -1))
    at = ranged.withColumn("own", own).join(before, "part").withColumn("at", F.coalesce("own", F.lit(0)) + F.col("before"))
    file = F.floor(F.col("at") / roll_size(so_far, least, most, files)).cast("long")
    return at.select(*KEY, "revisit", file.alias("file"), "at")


def file_of(firsts: list[tuple[tuple, int]]):
    """A vectorised helper: a record's key to its file, by the files' first keys."""
    keys, files = [k for k, _ in firsts], [f for _, f in firsts]

    @F.pandas_udf("long")
    def find(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            found = [files[bisect_right(keys, _place(_whole(p), u, d)) - 1] for p, u, d in zip(*columns, strict=True)]
            yield pd.Series(found, dtype="int64")

    return find


def write_archive(pages: DataFrame, path: str | None = None, revisit_from: int = 0, date: str = "2000-01-01T00:00:00Z", least: int = LEAST, most: int = MOST, files: int = FILES) -> DataFrame:
    """Write the archive to the folder `path` (a new one in the shared folder by default); its committed manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    path = path or shared_dir(spark, "warc")
    base = arrow_uri(path)
    sizes = stored(responses(pages, date, members=False).drop("member"), "warc-sizes")
    places = stored(placed(with_revisits(sizes, revisit_from, date), least, most, files), "warc-places")
    rows = places.groupBy("file").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), *KEY)).alias("k")).collect()  # one row a file
    firsts = sorted((_place(r.k.page_id, r.k.url, r.k.digest), r.file) for r in rows)
    find = file_of(firsts)
    whole = responses(pages, date, members=True).select(*KEY, "member", F.lit(1).alias("kind"))
    both = places.filter("revisit is not null").select(*KEY, F.col("revisit").alias("member"), F.lit(0).alias("kind")).unionByName(whole)
    dealt = both.withColumn("file", find(F.col("page_id").cast("decimal(20, 0)"), "url", "digest"))
    dealt = dealt.repartition(max(1, len(firsts)), "file").sortWithinPartitions("file", *_in_order(), "kind")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, root = fs.FileSystem.from_uri(base)
        open_file, out, told, revisit = None, None, {}, (None, None)

        def done() -> pd.DataFrame:
            out.close()
            return pd.DataFrame([told | {"sha256": told["sha256"].hexdigest()}]).astype({"first_page_id": "Int64", "last_page_id": "Int64"})

        for batch in batches:
            for file, page_id, url, digest, member, kind in zip(*(batch[c] for c in ("file", *KEY, "member", "kind")), strict=True):
                key = (_whole(page_id), url, digest)
                if kind == 0:  # a revisit stands before the records of its key
                    revisit = key, member
                    continue
                member = revisit[1] if revisit[0] == key else member
                if file != open_file:
                    if out is not None:
                        yield done()
                    name = f"{file:08d}.warc.gz"
                    open_file, temporary = file, f"temporary/{name}.{uuid.uuid4().hex}"
                    where.create_dir(f"{root}/temporary", recursive=True)
                    out = where.open_output_stream(f"{root}/{temporary}", compression=None)
                    head = file_info(name, date)
                    out.write(head)
                    told = {
                        "file": file, "name": name, "temporary": temporary, "n_records": 0, "n_bytes": len(head), "sha256": hashlib.sha256(head),
                        "first_page_id": _whole(page_id),
                    }
                out.write(member)
                told["sha256"].update(member)
                told |= {"n_records": told["n_records"] + 1, "n_bytes": told["n_bytes"] + len(member), "last_page_id": _whole(page_id)}
        if out is not None:
            yield done()

    return commit(stored(_ids(dealt, "page_id").mapInPandas(write, MANIFEST), "warc-written"), path)


def commit(written: DataFrame, path: str) -> DataFrame:
    """Give the written files their final names, then write the manifest. Done again after a failure it does what is left."""
    base = arrow_uri(path)

    def rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, root = fs.FileSystem.from_uri(base)
        for batch in batches:
            for name, temporary, n in zip(batch["name"], batch["temporary"], batch["n_bytes"], strict=True):
                final, held = where.get_file_info([f"{root}/{name}", f"{root}/{temporary}"])
                if held.type == fs.FileType.File:
                    where.move(held.path, final.path)
                elif final.type != fs.FileType.File or final.size != n:
                    raise OSError(f"{name} is neither at its temporary place nor at its own")
            yield batch

    spark = written.sparkSession
    written.mapInPandas(rename, MANIFEST).drop("temporary").write.mode("overwrite").parquet(f"{path}/manifest")
    where, root = fs.FileSystem.from_uri(base)
    if where.get_file_info(f"{root}/temporary").type == fs.FileType.Directory:
        where.delete_dir(f"{root}/temporary")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest").withColumn("path", F.lit(path))


def read_records(manifest: DataFrame) -> DataFrame:
    """RECORDS' columns of all records of the manifest's files. intact: block, payload and length are as their headers say.

    A file that isn't as long as its manifest row says, or has another SHA-256, is an error.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, name, n_bytes, sha256 in zip(batch["path"], batch["name"], batch["n_bytes"], batch["sha256"], strict=True):
                where, root = fs.FileSystem.from_uri(arrow_uri(path))
                seen, size, rows = hashlib.sha256(), 0, []

                def chunks(stream):
                    nonlocal size
                    while chunk := stream.read(READ):
                        seen.update(chunk)
                        size += len(chunk)
                        yield bytes(chunk)

                with where.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, data in members(chunks(stream)):
                        if (r := parse_record(data)) is not None:
                            page_id, record_id, record_type, uri, n, digest, refers_to, intact = r
                            rows.append((name, offset, page_id, record_id, record_type, uri, n, digest, refers_to, intact))
                        if len(rows) >= 5000:
                            yield _frame(rows)
                            rows = []
                if (size, seen.hexdigest()) != (n_bytes, sha256):
                    raise OSError(f"{name} isn't as its manifest says")
                yield _frame(rows)

    spread = manifest.select("path", "name", "n_bytes", "sha256").repartition("name")  # a task a file or so, not a task a manifest file
    return spread.mapInPandas(read, RECORDS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages' archive, read it back: page_id, payload_bytes, payload_digest, record_type, refers_to, and the record's place."""
    r = read_records(write_archive(pages))
    return r.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri", "intact", "name", "offset")


def op12_warc(spark, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))
