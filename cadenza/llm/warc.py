"""WARC archives: a writer, and a reader that splits inside a file.

``write_warc`` lays one gzip member per record, so that an archive can be read
from any record on.  Of the records with equal payloads (of at least
``min_revisit_bytes``) that with the largest id is the response, the others are
revisits that name it and carry headers only.

``read_warc`` deals byte ranges of the archives to tasks.  A task looks for the
gzip magic in its range, accepts a place where a member decodes to a WARC
header block (of any size; a broken one is an error), and owns the records that
start inside the range; the last may end beyond it.  Bytes are read in blocks
and payloads decoded in pieces.

Archives live in a folder that all executors see (any file system that
``pyarrow.fs`` opens by URI); a file is written beside its name and then moved
there, so that a task that is run again replaces its file whole.

Defined results: a null payload is empty; a null or missing url is left out of
the headers; of rows that share id and payload each is a response if the id is
the largest of its payload; a null id is never smaller than another, and if all
ids of a payload are null, each is a response; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 20
SPLIT = 64 << 20
DATE = "1970-01-01T00:00:00Z"  # records of a table without times
RECORD = ("record_id string, record_type string, refers_to string, target_uri string, "
          "payload_bytes long, payload_digest string")


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _digest(payload_sha1: bytes) -> str:
    return base64.b32encode(payload_sha1).decode()


def encode_record(rid, kind: str, refers_to, uri, payload: bytes) -> bytes:
    """One record as a gzip member.  A revisit keeps the HTTP header block,
    whose Content-Length tells the payload's size, and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}",
            "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{_digest(hashlib.sha1(payload).digest())}"]
    if rid is not None:
        head.append(f"WARC-Record-ID: <urn:page:{rid}>")
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", uri))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``path/part-*.warc.gz``; gives ``(file, bytes, records)``, eager."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    url = F.col(url_col) if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("sha1"), F.length(payload).alias("n"))
    # copies meet as one row per task and digest before they are dealt out
    last = rows.where(F.col("n") >= min_revisit_bytes).groupBy("sha1").agg(F.max("id").alias("last"))
    rows = (rows.join(last, "sha1", "left")
            .select(F.col("id").cast("string"), "url", "payload",
                    F.when(F.col("last").isNull() | F.col("last").eqNullSafe(F.col("id")), None)
                    .otherwise(F.col("last")).cast("string").alias("refers_to")))
    fs, root = _fs(path)
    fs.create_dir(root, recursive=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        fs, root = _fs(path)
        name = f"{root}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        draft, size, n = f"{root}/.draft-{uuid.uuid4().hex}", 0, 0
        with fs.open_output_stream(draft) as out:
            for pdf in batches:
                for rid, uri, payload, refers in zip(pdf["id"], pdf["url"], pdf["payload"], pdf["refers_to"]):
                    refers = None if pd.isna(refers) else refers
                    data = encode_record(None if pd.isna(rid) else rid, "revisit" if refers is not None else "response",
                                         refers, None if pd.isna(uri) else uri, payload)
                    out.write(data)
                    size, n = size + len(data), n + 1
        if n:
            fs.move(draft, name)
            yield pd.DataFrame({"file": [name], "bytes": [size], "records": [n]})
        else:
            fs.delete_file(draft)

    made = rows.mapInPandas(write, "file string, bytes long, records long").agg(
        F.collect_list(F.struct("file", "bytes", "records")).alias("files")).first()["files"]
    return pages.sparkSession.createDataFrame(made, "file string, bytes long, records long")


# --- reader -----------------------------------------------------------------------

class _Source:
    """Bytes of a file from ``start`` on, read in blocks as asked for."""

    def __init__(self, f, start: int):
        self.f, self.base, self.data = f, start, b""
        f.seek(start)

    def grow(self) -> bool:
        more = self.f.read(BLOCK)
        self.data += more
        return bool(more)

    def drop(self, offset: int) -> None:
        self.data, self.base = self.data[offset - self.base:], offset


def _header(src: _Source, offset: int):
    """The decoder, the decoded bytes so far and where input goes on, if a WARC
    record decodes from ``offset``; None if what decodes there is no such record.
    The header block may be of any size; of the payload at most a piece is decoded."""
    z, out, at, seen = zlib.decompressobj(31), bytearray(), offset, 0
    while (out[:5] != b"WARC/") or out.find(b"\r\n\r\n", max(0, seen - 3)) < 0:
        told, seen = out[:5] == b"WARC/", len(out)
        if not told and (seen >= 5 or z.eof):
            return None
        more = not z.eof and (at - src.base < len(src.data) or src.grow())
        if not more:
            if told:
                raise ValueError(f"header block of the record at {offset} has no end")
            return None
        piece = src.data[at - src.base:at - src.base + 4096]
        try:
            out += z.decompress(piece, 65_536)
        except zlib.error as e:
            if told:
                raise ValueError(f"header block of the record at {offset} does not decode") from e
            return None
        at += len(piece) - len(z.unused_data or z.unconsumed_tail)
    return z, bytes(out), at


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def records_in(f, start: int, end: int, with_payload: bool) -> Iterator[tuple]:
    """The records of one archive that start in ``[start, end)``."""
    src, at = _Source(f, start), start
    while at < end:
        hit = src.data.find(MAGIC, at - src.base)
        if hit < 0:
            at = max(at, src.base + len(src.data) - 2)
            if at >= end:
                return
            src.drop(at)
            if not src.grow():
                return
            continue
        at = src.base + hit
        if at >= end:
            return
        found = _header(src, at)
        if found is None:
            at += 1
            continue
        z, out, on = found
        head, _, out = out.partition(b"\r\n\r\n")
        h = _fields(head)
        left, http, sha, kept, size = int(h["content-length"]), b"", hashlib.sha1(), [], 0
        in_http = True
        while True:
            piece, out = out[:left], b""
            left -= len(piece)
            if in_http:
                http += piece
                if b"\r\n\r\n" in http:
                    http, _, piece = http.partition(b"\r\n\r\n")
                    in_http = False
            if not in_http and piece:
                sha.update(piece)
                size += len(piece)
                if with_payload:
                    kept.append(piece)
            if z.eof:
                break
            src.drop(on)
            if not src.data and not src.grow():
                raise ValueError(f"record at {at} ends too early")
            feed = src.data[:65_536]
            out = z.decompress(feed)
            on += len(feed) - len(z.unused_data)
        ident = lambda k: h[k][len("<urn:page:"):-1] if k in h else None
        told = h["warc-payload-digest"].removeprefix("sha1:")
        if h["warc-type"] == "response":
            if told != _digest(sha.digest()):
                raise ValueError(f"payload of the record at {at} does not match its digest")
            payload = b"".join(kept)
        else:
            payload, size = None, int(_fields(http)["content-length"])
        yield (ident("warc-record-id"), h["warc-type"], ident("warc-refers-to"), h.get("warc-target-uri"),
               size, told, payload)
        at = on


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT, with_payload: bool = False) -> DataFrame:
    """The records below ``path``, one task for each ``split_bytes`` of an archive."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
             .load(path).select("path", "length"))
    ranges = files.select("path", "length", F.explode(
        F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    n = max(1, ranges.count())
    # a range of its own partition each, up to Spark's usual width
    ranges = ranges.repartition(min(n, max(200, spark.sparkContext.defaultParallelism * 4)))
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"]

    def read(batches):
        for pdf in batches:
            for uri, start in zip(pdf["path"], pdf["start"]):
                fs, name = _fs(uri.replace("file:/", "file:///", 1) if re.match(r"file:/[^/]", uri) else uri)
                rows, held = [], 0
                with fs.open_input_file(name) as f:
                    for r in records_in(f, start, start + split_bytes, with_payload):
                        rows.append(r)
                        held += 200 + (len(r[6]) if r[6] else 0)
                        if held > 8 << 20:
                            yield pd.DataFrame(rows, columns=names)[cols]
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)[cols]

    cols = names if with_payload else names[:-1]
    return ranges.select("path", "start").mapInPandas(read, RECORD + (", payload binary" if with_payload else ""))
