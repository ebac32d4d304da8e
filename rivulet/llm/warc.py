"""WARC archives with an index written first and coalesced byte-range reads.

``write_archives`` gives every page a record: of pages with equal payloads of
at least ``min_revisit`` bytes the one with the smallest page_id is a
``response``, the others are ``revisit`` records that refer to it; all other
pages are responses. Rows meet their role by page_id, url and payload digest,
never by a position in a scan, so the splits of two scans may differ. Each task
writes one archive of gzip members (one a record) into the shared folder and
yields the index rows: file, offset, length, URL, digest. Archive names hold a random part, so a retried or speculative task
writes another file and only the files named by the committed index count.

``read_records`` sorts selected index rows by file and offset, joins ranges
with small gaps into one read and parses the members inside.

Archives are reached through ``pyarrow.fs``, which takes local, s3, gs and
(with libhdfs) hdfs URIs; only the tables' paths are Spark's.

Defined cases: a null html is an empty payload; a null url becomes
``urn:page:<id>``; control characters of a url are percent-encoded; repeated
rows of one page_id give one response, for the smallest url (null last), and
revisits that refer to the same id; of wholly equal rows one is the response;
null ids rank last; an empty table gives an empty index; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import materialize, null_as_empty, shared_path

MIN_REVISIT = 100          # bytes; shorter payloads are never revisits
GAP, MOST = 64 << 10, 8 << 20  # ranges this close are read together, up to this size
INDEX = ("page_id long, url string, file string, offset long, length long, payload_digest string, "
         "payload_bytes long, record_type string, refers_to long")
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, "
          "payload_bytes long, payload binary")
# fixed values of the WARC 1.1 format
_VERSION = "WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))


def _header_url(url: str | None, page_id) -> str:
    if url is None:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else quote(c) for c in url)


def encode_record(page_id, url, kind: str, refers_to, payload: bytes | None, digest: str, date: str, size: int) -> bytes:
    """One gzip member holding one record. A revisit keeps the HTTP head, the digest and the length, not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http + (payload if kind == "response" else b"")
    head = [_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_header_url(url, page_id)}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Page-ID: {'' if page_id is None else page_id}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT_PROFILE}", f"Refers-To-Page-ID: {'' if refers_to is None else refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 4, mtime=0)


def decode_record(member: bytes) -> dict:
    """The fields of RECORD; ``payload`` is None for revisits. A payload that fails its digest raises."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    f = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(f["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest, kind = f["WARC-Payload-Digest"].removeprefix("sha256:"), f["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record of page {f['Page-ID']}")
    number = lambda x: int(x) if x else None
    return {"page_id": number(f["Page-ID"]), "url": f["WARC-Target-URI"], "record_type": kind,
            "refers_to": number(f.get("Refers-To-Page-ID", "")), "payload_digest": digest, "payload_bytes": size,
            "payload": payload if kind == "response" else None}


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _write(batches: Iterator[pa.RecordBatch], root: str, date: str) -> Iterator[pa.RecordBatch]:
    fs, base = _fs(root)
    name, out, at = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
    try:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                payload = (r["html"] or "").encode() if r["record_type"] == "response" else None
                member = encode_record(r["page_id"], r["url"], r["record_type"], r["refers_to"], payload, r["payload_digest"], date, r["payload_bytes"])
                out.write(member)
                rows.append({**{k: r[k] for k in ("page_id", "url", "payload_digest", "record_type", "refers_to")},
                             "file": name, "offset": at, "length": len(member), "payload_bytes": r["payload_bytes"]})
                at += len(member)
            yield pa.RecordBatch.from_pylist(rows, _arrow(INDEX))
    finally:
        if out is not None:
            out.close()


_ROW = ["page_id", "url", "payload_digest"]


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload_digest, payload_bytes, copies, record_type, refers_to, twins): one row for all equal pages.

    ``copies`` counts them. ``twins``: only one of them is the response, the others are revisits.
    """
    html = null_as_empty(F.col("html"))
    keyed = materialize(pages.select(
        "page_id", "url", F.sha2(html, 256).alias("payload_digest"), F.octet_length(html).cast("long").alias("payload_bytes")), "warckeys")
    rows = keyed.groupBy(*_ROW, "payload_bytes").agg(F.count("*").alias("copies"))
    rank = F.struct(F.col("page_id").isNull().alias("z"), F.col("page_id").alias("page_id"), F.col("url").isNull().alias("u"), F.col("url").alias("url"))
    first = (keyed.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest")
             .agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    winner = F.col("first.page_id").eqNullSafe(F.col("page_id")) & F.col("first.url").eqNullSafe(F.col("url"))
    revisit = F.col("first").isNotNull() & ~winner
    # a digest with a third of all rows: the adaptive plan splits its partition of this join
    return rows.join(first, "payload_digest", "left").select(
        *_ROW, "payload_bytes", "copies", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
        (F.col("first").isNotNull() & winner & (F.col("copies") > 1)).alias("twins"))


def _with_roles(rows: DataFrame, roles: DataFrame) -> DataFrame:
    """Every page with the planned row of its page_id, url and digest."""
    plan = roles.select(*[F.col(c).alias(f"_{c}") if c in _ROW else F.col(c) for c in roles.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _ROW[:2]]
    return rows.join(plan, [F.col("payload_digest") == F.col("_payload_digest"), *same]).drop(*[f"_{c}" for c in _ROW])


def write_archives(pages: DataFrame, root: str | None = None, min_revisit: int = MIN_REVISIT,
                   date: str = "2020-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """(archive folder, index table). The folder must be reachable from every executor."""
    spark = pages.sparkSession
    root = root or shared_path(spark, "warc")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)  # noqa: SLF001 - Hadoop FileSystem API
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)  # noqa: SLF001
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    roles = materialize(plan_records(pages, min_revisit), "warcroles")
    rows = pages.withColumn("payload_digest", F.sha2(null_as_empty(F.col("html")), 256))
    columns = [*_ROW, "payload_bytes", "record_type", "refers_to", "html"]
    full = _with_roles(rows, roles.where("not twins")).select(columns)
    twins = roles.where("twins")
    if not twins.isEmpty():
        # equal rows are one another's twins: one text is the response, the rest need no text
        one = _with_roles(rows, twins).groupBy(*_ROW, "payload_bytes", "record_type", "refers_to").agg(F.first("html").alias("html"))
        rest = twins.withColumn("_i", F.explode(F.sequence(F.lit(2), F.col("copies")))).select(
            *_ROW, "payload_bytes", F.lit("revisit").alias("record_type"), F.col("page_id").alias("refers_to"), F.lit(None).cast("string").alias("html"))
        full = full.unionByName(one.select(columns)).unionByName(rest)
    return root, materialize(full.mapInArrow(lambda it: _write(it, root, date), INDEX), "warcindex")


def _ranges(rows: list[dict], gap: int = GAP, most: int = MOST) -> Iterator[list[dict]]:
    """Runs of index rows, sorted by file and offset, that one read covers."""
    run: list[dict] = []
    for r in rows:
        if run and (r["file"] != run[0]["file"] or r["offset"] - (run[-1]["offset"] + run[-1]["length"]) > gap
                    or r["offset"] + r["length"] - run[0]["offset"] > most):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def _read(batches: Iterator[pa.RecordBatch], root: str, payload: bool) -> Iterator[pa.RecordBatch]:
    fs, base = _fs(root)
    schema = _arrow(RECORD)
    name, f = None, None
    try:
        for b in batches:
            for run in _ranges(b.to_pylist()):
                if run[0]["file"] != name:
                    if f is not None:
                        f.close()
                    name = run[0]["file"]
                    f = fs.open_input_file(f"{base}/{name}")
                start = run[0]["offset"]
                data = f.read_at(run[-1]["offset"] + run[-1]["length"] - start, start)
                out = [decode_record(data[r["offset"] - start:r["offset"] - start + r["length"]]) for r in run]
                if not payload:
                    out = [{**r, "payload": None} for r in out]
                yield pa.RecordBatch.from_pylist(out, schema)
    finally:
        if f is not None:
            f.close()


def read_records(index: DataFrame, root: str, payload: bool = True) -> DataFrame:
    """The records of the selected index rows, read back from the archives (RECORD's columns)."""
    spark = index.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (index.select("file", "offset", "length").repartitionByRange(n, "file", "offset")
            .sortWithinPartitions("file", "offset"))
    return rows.mapInArrow(lambda it: _read(it, root, payload), RECORD)
