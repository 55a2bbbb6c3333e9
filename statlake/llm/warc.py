"""Web archives in ZIP packages, written and read back by range (operator 4).

Each task writes one package: ``archive/data.warc.gz`` (one gzip member per
record) and ``indexes/index.cdxj`` (a line per record: page, offset, length),
both stored, so that a record is one byte range of the package.  Of pages
with equal payloads that with the smallest id is a response; the others are
revisits that name it.

Packages go to a folder that all executors share, under names that no other
task attempt uses; the manifest, a Spark table, lists those of the attempts
that counted.  Readers take packages from the manifest, find the index through
the ZIP directory, and read runs of records in parallel.  Payload groups are
joined by salted digest, so a payload that a third of all pages share is
spread over ``SALTS`` times as many partitions.

Defined cases: null html is an empty payload; a null page_id is never the
smallest, and a group without ids is all responses; repeated rows of the
smallest id are responses each; payloads under ``least`` bytes are all
responses; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm import store
from statlake.llm.zip_archive import ZipReader, ZipWriter

SALTS = 16
RUN_BYTES = 8 << 20  # of records read at once
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record, gzipped by itself.  A revisit keeps the HTTP head, and
    in it the payload's length, but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
            ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT)]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def parse(data: bytes) -> dict:
    """The record whose gzip member ``data`` is."""
    raw = zlib.decompress(data, 31)
    cut = raw.index(b"\r\n\r\n")
    lines = raw[:cut].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = raw[cut + 4:cut + 4 + int(head["content-length"])]
    cut = block.index(b"\r\n\r\n")
    http = {k.lower(): v for k, v in (x.split(": ", 1) for x in block[:cut].decode().split("\r\n")[1:])}
    page = lambda name: (lambda x: None if x in ("", "None") else int(x))(head.get(name, "")[len("<urn:page:"):-1])
    out = {"page_id": page("warc-record-id"), "url": head.get("warc-target-uri"), "record_type": head["warc-type"],
           "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"), "refers_to": page("warc-refers-to"),
           "payload_bytes": int(http["content-length"]), "payload": None}
    if out["record_type"] == "response":
        out["payload"] = block[cut + 4:]
        if len(out["payload"]) != out["payload_bytes"] or digest(out["payload"]) != out["payload_digest"]:
            raise ValueError(f"page {out['page_id']}: payload and digest differ")
    return out


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, zip64: bool = False,
                   package_bytes: int = 1 << 30, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages; the manifest ``(path, n_records)``, one row per package.

    ``folder``: a URI that the executors share and pyarrow opens (file, hdfs,
    s3, ...); by default a new one in the shared folder of the session."""
    folder = folder or store.new_path(pages.sparkSession, "warc")
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    p = p.withColumn("_sha", F.sha1(F.col("html").cast("binary")))
    first = (p.filter(F.octet_length("html") >= least).groupBy("_sha")
             .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    p = p.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    refers = F.when((F.octet_length("html") >= least) & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    p = p.join(first, ["_sha", "_salt"], "left").select("page_id", "url", "html", refers.alias("refers_to"))

    def write(batches):
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        made, stream, package, lines, name = [], None, None, [], ""

        def finish():
            package.end()
            package.begin(INDEX)
            package.write("".join(lines).encode())
            package.end()
            package.close()
            stream.close()
            fs.move(f"{base}/.{name}", f"{base}/{name}")
            made.append((f"{folder}/{name}", len(lines)))
        for b in batches:
            for page_id, url, text, refers_to in zip(*[c for c in b.columns], strict=True):
                if package is not None and package.at >= package_bytes:
                    finish()
                    package = None
                if package is None:
                    name = f"part-{context.partitionId():05d}-{uuid.uuid4().hex}.wacz"
                    stream = fs.open_output_stream(f"{base}/.{name}")
                    package, lines = ZipWriter(stream, zip64), []
                    package.begin(ARCHIVE)
                data = record(page_id.as_py(), url.as_py(), (text.as_py() or "").encode(), refers_to.as_py(), date)
                at = package.write(data)
                lines.append(json.dumps({"page": page_id.as_py(), "offset": at, "length": len(data)}) + "\n")
        if package is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())],
                                         ["path", "n_records"])
    return store.table(p.mapInArrow(write, "path string, n_records long"), "warc-manifest")


class _File:
    """Range reads of one file."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        self.size = fs.get_file_info(path).size
        self.file = fs.open_input_file(path)

    def __call__(self, start: int, length: int) -> bytes:
        return self.file.read_at(length, start)


def runs(uri: str, run_bytes: int = RUN_BYTES) -> list[tuple[int, list[int]]]:
    """(start in the package, record lengths) of runs of about ``run_bytes``,
    found through the ZIP directory and the package's index."""
    file = _File(uri)
    package = ZipReader(file, file.size)
    members = {m.name: m for m in package.members}
    base = package.stored(members[ARCHIVE])
    index = members[INDEX]
    out: list[tuple[int, list[int]]] = []
    total = end = 0
    for line in file(package.stored(index), index.size).splitlines():
        entry = json.loads(line)
        if not out or total + entry["length"] > run_bytes or entry["offset"] != end:
            out.append((base + entry["offset"], []))
            total = 0
        out[-1][1].append(entry["length"])
        total += entry["length"]
        end = entry["offset"] + entry["length"]
    return out


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the packages that ``manifest`` lists in column ``path``."""
    def locate(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                found = runs(path)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found), pa.string()), pa.array([s for s, _ in found], pa.int64()),
                     pa.array([n for _, n in found], pa.list_(pa.int32()))], ["path", "start", "lengths"])
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payload

    def read(batches):
        for b in batches:
            for path, start, lengths in zip(*[c.to_pylist() for c in b.columns], strict=True):
                data, at, rows = _File(path)(start, sum(lengths)), 0, []
                for n in lengths:
                    rows.append(parse(data[at:at + n]))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds, strict=True)], names)
    spark = manifest.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = manifest.select("path").repartition(n).mapInArrow(locate, "path string, start long, lengths array<int>")
    return found.repartition(n).mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
        + ", payload binary" * payload)


def op4_query(pages: DataFrame, **options) -> DataFrame:
    return read_archives(write_archives(pages, least=0, **options), payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as x from pages),
f as (select x, min(page_id) as first from p group by x)
select p.page_id, cast(strlen(h) as bigint) as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(((cast('0x' || substr(p.x, (i // 4) * 5 + 1, 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31) + 1 as bigint), 1)),
    'string_agg', '') as payload_digest,
  case when first is null or p.page_id = first then 'response' else 'revisit' end as record_type,
  case when first is not null and p.page_id is distinct from first then first end as refers_to
from p join f on p.x = f.x
"""
