"""WARC archives with an index written first and byte-range reads coalesced from it.

Writing returns the index: file, offset, length, URL and payload digest of each record.  Reading
takes any selection of index rows, sorts them by file and offset, joins neighbours into ranges and
reads each range with one request.  An archive is named by its task attempt; only archives that the
committed index names exist for readers, so retried or speculative tasks leave no double records.

Defined results: a null payload is empty; a null URL becomes ``urn:page:<id>``; control characters
and blanks of a URL are percent-encoded; equal payloads of at least ``revisit_bytes`` are revisits
of the record with the largest identifier; an empty table gives an empty index; extra columns are
ignored.  A repeated identifier writes one record per row, and the row that is response is chosen
by identifier, so rows that repeat the response's identifier are responses as well.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, settle, tune, with_membership

INDEX = "page_id long, url string, file string, offset long, length long, digest string, payload_bytes long, record_type string, refers_to long"
#: An archive is closed beyond this size, a range ends at this size, and gaps up to this are read over.
FILE_BYTES, RANGE_BYTES, GAP_BYTES = 256 << 20, 4 << 20, 64 << 10
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _uri(page_id) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}"


def _target(url, page_id) -> str:
    if not isinstance(url, str) or not url:
        return f"urn:page:{page_id}"
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_bytes(page_id, url, payload: bytes, sha1: str, refers_to, compress: bool = True) -> bytes:
    """One record; compressed records are gzip members of their own."""
    base32 = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = HTTP % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_uri(page_id)}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {_target(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{base32}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_uri(refers_to)}>",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    if not compress:
        return raw
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(raw) + deflate.flush()


def parse_record(raw: bytes) -> dict:
    """Headers, payload and payload length of one (possibly compressed) record."""
    if raw[:2] == b"\x1f\x8b":
        raw = zlib.decompress(raw, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sent = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"headers": headers, "payload": payload, "http_length": sent}


def record_decisions(pages: DataFrame, id_col: str, payload_col: str, revisit_bytes: int) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): which rows are revisits, and of what."""
    raw = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), raw.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("check", F.sha2("payload", 256))
    groups = (
        rows.where(F.octet_length("payload") >= revisit_bytes)
        .groupBy("sha1", "check")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    large = rows.where(F.octet_length("payload") >= revisit_bytes).select("page_id", "sha1", "check")
    revisits = settle(
        large.join(groups, ["sha1", "check"]).where(~F.col("page_id").eqNullSafe(F.col("first_id"))).select("page_id", F.col("first_id").alias("refers_to"), F.col("sha1").alias("r_sha1")).distinct(),
        "warc-revisits",
    )
    # Only rows that may be revisits are shuffled; all other payloads stay where they were read.
    spot = F.xxhash64("page_id", "sha1")
    revisits = revisits.select(F.col("page_id").alias("r_id"), "r_sha1", "refers_to", F.xxhash64("page_id", "r_sha1").alias("r_spot"))
    judged = with_membership(rows.drop("check").withColumn("spot", spot), "spot", revisits, "r_spot", "maybe")
    same = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("sha1") == F.col("r_sha1"))
    out = ["page_id", "url", "payload", "sha1", "refers_to"]
    known = judged.where("not maybe").withColumn("refers_to", F.lit(None).cast("long")).select(*out)
    return known.unionByName(judged.where("maybe").join(revisits, same, "left").select(*out))


def write_archives(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", revisit_bytes: int = 1000, compress: bool = True, path: str | None = None) -> DataFrame:
    """Write a record for each row below ``path``; returns the committed index."""
    spark = pages.sparkSession
    tune(spark)
    path = path or scratch(spark, "warc")
    rows = record_decisions(pages, id_col, payload_col, revisit_bytes)
    suffix = "warc.gz" if compress else "warc"

    def write(batches):
        at, root = fs.FileSystem.from_uri(path)
        at.create_dir(root, recursive=True)
        task, n, out, offset = TaskContext.get(), 0, None, 0
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        try:
            for pdf in batches:
                index = []
                for page_id, url, payload, sha1, refers in pdf.itertuples(index=False):
                    page_id = None if pd.isna(page_id) else int(page_id)
                    refers = None if pd.isna(refers) else int(refers)
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        file, n, offset = f"{name}-{n:04d}.{suffix}", n + 1, 0
                        out = at.open_output_stream(f"{root}/{file}", compression=None)
                    data = record_bytes(page_id, url, payload, sha1, refers, compress)
                    out.write(data)
                    index.append((page_id, _target(url, page_id), f"{path}/{file}", offset, len(data), sha1, len(payload), "response" if refers is None else "revisit", refers))
                    offset += len(data)
                got = pd.DataFrame(index, columns=[x.split()[0] for x in INDEX.split(", ")])
                yield got.astype({"page_id": "Int64", "refers_to": "Int64"})
        finally:
            if out is not None:
                out.close()

    return settle(rows.mapInPandas(write, INDEX), "warc-index")


def read_archives(selected: DataFrame) -> DataFrame:
    """Records of the selected index rows, by coalesced byte ranges."""
    tune(selected.sparkSession)
    cell = F.floor(F.col("offset") / F.lit(RANGE_BYTES))  # bounds a range; a record belongs to the cell it starts in
    ranges = selected.groupBy("file", cell.alias("cell")).agg(F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("spans"))
    ranges = ranges.sortWithinPartitions("file", "cell")  # each archive is opened once in a task

    def read(batches):
        opened, at, held = None, None, None
        for pdf in batches:
            for file, spans in zip(pdf["file"], pdf["spans"], strict=True):
                if file != opened:
                    if held is not None:
                        held.close()
                    at, root = fs.FileSystem.from_uri(file)
                    held, opened = at.open_input_file(root), file
                spans = [(int(s["offset"]), int(s["length"])) for s in spans]
                runs = [[spans[0]]]
                for s in spans[1:]:
                    if s[0] - sum(runs[-1][-1]) <= GAP_BYTES:
                        runs[-1].append(s)
                    else:
                        runs.append([s])
                rows = []
                for run in runs:
                    start = run[0][0]
                    data = held.read_at(sum(run[-1]) - start, start)
                    for offset, length in run:
                        rec = parse_record(data[offset - start : offset - start + length])
                        h, payload = rec["headers"], rec["payload"]
                        sha1 = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if h["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != sha1:
                            raise ValueError(f"damaged record in {file} at {offset}")
                        rows.append((
                            int(h["x-page-id"]) if h["x-page-id"] else None, h["warc-target-uri"], h["warc-type"], sha1,
                            rec["http_length"], int(h["x-refers-to-page-id"]) if "x-refers-to-page-id" in h else None,
                            payload if h["warc-type"] == "response" else None, file, offset,
                        ))
                got = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "digest", "payload_bytes", "refers_to", "payload", "file", "offset"])
                yield got.astype({"page_id": "Int64", "refers_to": "Int64"})
        if held is not None:
            held.close()

    return ranges.mapInPandas(
        read, "page_id long, url string, record_type string, digest string, payload_bytes long, refers_to long, payload binary, file string, offset long"
    )


def select_records(spark: SparkSession, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Index rows of the wanted page_id values, and of the responses that their revisits refer to."""
    hits = index.join(wanted.select("page_id").distinct(), "page_id", "left_semi")
    sources = hits.where("refers_to is not null").select(F.col("refers_to").alias("page_id")).distinct()
    return hits.unionByName(index.where("record_type = 'response'").join(sources, "page_id", "left_semi")).distinct()
