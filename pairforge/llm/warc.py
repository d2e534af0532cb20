"""Deterministic sharded WARC archives of pages, written and read back.

Records are range-sorted by ``page_id``; each range becomes one or more
``.warc.gz`` files that roll by compressed size (one gzip member per record, a
``warcinfo`` record first). Headers, ids and digests are made anew from the row,
so a rerun or a second attempt of a task writes the same bytes. A file gets its
final name when complete, and only the files of the manifest table count.

Of records with equal payloads of at least ``min_bytes``, that of the largest
page_id is the response; the others are ``revisit`` records that name it. Rows
that repeat the largest page_id are all responses. A null html is an empty
payload, a null url leaves out the target, a null page_id sorts first and is
never the response of a group that has a page_id. An empty table gives no files
and no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import column, frugal, pick, saved, small, table, tune
from pairforge.llm.shared_files import CommittedFile, drop_temporary, open_stream
from pairforge.session import scratch_path

FILE_BYTES = 4 << 20  # compressed bytes at which a file is full; 1 GB is usual on a cluster
RANGE_BYTES = 32 << 20  # payload bytes of a range, which one task writes
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("crc", pa.int64())])
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, again: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{again}')}>"


def clean_uri(url: str) -> str:
    """A header value: control characters and spaces percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("WARC-Date", DATE), ("WARC-Block-Digest", f"sha1:{sha1_32(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, again: int, leader: int | None, leader_url: str | None) -> bytes:
    digest = sha1_32(payload)
    headers = [("WARC-Record-ID", record_id(page_id, digest, again))]
    if url is not None:
        headers.append(("WARC-Target-URI", clean_uri(url)))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if leader is None:
        return record("response", headers, http + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(leader, digest, 0)), ("X-Refers-To-Page-Id", str(leader))]
    if leader_url is not None:
        headers.append(("WARC-Refers-To-Target-URI", clean_uri(leader_url)))
    return record("revisit", headers, http)


def _write(root: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, out, info, last = TaskContext.get().partitionId(), 0, None, {}, None
        again = 0

        def close() -> dict:
            out.commit()
            return info | {"bytes": out.size}

        for b in batches:
            names = ("page_id", "url", "html", "leader", "leader_url")
            done = []
            for page_id, url, html, leader, leader_url in zip(*(column(b, c).to_pylist() for c in names)):
                if out is None:
                    name = f"part-{part:06d}-{n:05d}.warc.gz"
                    out, info, n = CommittedFile(root, name), {"file": name, "records": 0, "crc": 0}, n + 1
                    first = record("warcinfo", [("WARC-Record-ID", record_id(None, name, 0)), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(first)
                    info["crc"] = zlib.crc32(first)
                payload = html.encode()
                again = again + 1 if last == (page_id, payload) else 0
                last = (page_id, payload)
                rec = page_record(page_id, url, payload, again, leader, leader_url)
                out.write(rec)
                info["crc"] = zlib.crc32(rec, info["crc"])
                info["records"] += 1
                if out.size >= file_bytes:
                    done.append(close())
                    out = None
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_MANIFEST)
        if out is not None:
            yield pa.RecordBatch.from_pylist([close()], schema=_MANIFEST)

    return run


def with_leaders(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, int]:
    """Pages with the page_id and url of the response they revisit (null for
    responses), and the sum of the payload bytes. The groups come from one
    partial aggregation over digests; only groups of two or more are joined."""
    rows = pick(pages, "page_id", "url", "html").select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("html")))
    n_bytes = F.octet_length("html")
    groups = rows.select("digest", "page_id", "url", n_bytes.alias("n")).groupBy("digest").agg(
        F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("lead"), F.count(F.lit(1)).alias("k"), F.first("n").alias("n")
    )
    groups = saved(groups, "payload-groups")
    total = groups.agg(F.sum(F.col("n") * F.col("k")).alias("s")).first()["s"] or 0
    leaders = groups.filter((F.col("k") > 1) & (F.col("n") >= min_bytes) & F.col("lead").isNotNull())
    leaders = saved(leaders.select("digest", F.col("lead.page_id").alias("leader"), F.col("lead.url").alias("leader_url")), "payload-leaders")
    joined = rows.join(small(leaders), "digest", "left")
    other = ~F.col("page_id").eqNullSafe(F.col("leader"))
    return joined.select(
        "page_id", "url", "html", "digest", F.when(other, F.col("leader")).alias("leader"), F.when(other, F.col("leader_url")).alias("leader_url")
    ), total


def write_warc(pages: DataFrame, root: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the archives below ``root``; returns the manifest (a row per file)."""
    spark = pages.sparkSession
    tune(spark)
    rows, total = with_leaders(pages, min_bytes)
    order = ["page_id", "digest", "url"]
    ranged = rows.repartitionByRange(max(1, -(-total // range_bytes)), *order).sortWithinPartitions(*order)
    files = ranged.drop("digest").mapInArrow(frugal(_write(root, file_bytes)), "file string, records bigint, bytes bigint, crc bigint")
    files.write.mode("overwrite").parquet(f"{root}/manifest")
    drop_temporary(root)
    return spark.read.parquet(f"{root}/manifest")


def records(stream, want_crc: int | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one archive, a gzip member at a time."""
    crc, data, z, parts = 0, b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(1 << 18)
            crc = zlib.crc32(data, crc)
            if not data:
                break
        parts.append(z.decompress(data))
        data = z.unused_data
        if z.eof:
            raw = b"".join(parts)
            head, _, rest = raw.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            block = rest[: int(headers["Content-Length"])]
            if rest[len(block) :] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{sha1_32(block)}":
                raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
            yield headers, block
            z, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends inside a record")
    if want_crc is not None and crc != want_crc:
        raise OSError(f"crc32 {crc}, the manifest has {want_crc}")


def _read(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, want in zip(column(b, "file").to_pylist(), column(b, "crc").to_pylist()):
                rows = []
                with open_stream(root, name) as f:
                    for h, block in records(f, want):
                        kind = h["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if (len(payload), sha1_32(payload)) != (size, digest):
                                raise ValueError(f"{name}: payload of {h['WARC-Record-ID']} differs from its header")
                        page, ref = h.get("X-Page-Id"), h.get("X-Refers-To-Page-Id")
                        rows.append((page and int(page), size, digest, kind, ref and int(ref), h.get("WARC-Target-URI")))
                cols = list(zip(*rows)) if rows else [()] * len(_READ)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _READ)], schema=_READ)

    return run


def read_warc(spark: SparkSession, root: str) -> DataFrame:
    """A row per page record of the archives that the manifest names."""
    manifest = spark.read.parquet(f"{root}/manifest")
    return manifest.select("file", "crc").repartition(max(1, manifest.count())).mapInArrow(
        frugal(_read(root)), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), root)
    return read_warc(spark, root).drop("url")
