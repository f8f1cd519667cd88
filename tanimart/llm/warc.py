"""WARC archives with a two-level capture index.

Pages become gzip members of WARC files (one member per record, so a byte
range is a record).  Captures are listed under reversed-host URL keys
(``org,example,www)/path``); the list is sorted over the cluster and stored as
gzip blocks of some thousand lines (level two), with a sparse directory of the
blocks' first keys per index file (level one) and the files' key ranges on
top.  A lookup finds its index file by the key ranges, binary-searches that
file's directory, range-reads one block, binary-searches its lines, and
range-reads the records.

Files go to any store that pyarrow's file systems open by URI; each is written
under a name of its own per attempt, and only the names that a successful task
returned are used, so a lost task leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

#: Lines of one index block, and bytes after which a WARC file is closed.
BLOCK_LINES = 2000
FILE_BYTES = 256 << 20
#: Fixed values of the WARC 1.1 format and its revisit profile.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def reversed_host_key(url: str | None) -> str:
    """``http://www.Example.org:80/a?b#c`` -> ``org,example,www)/a?b``; a url
    without ``://`` (or null) is its own key after ``)``."""
    if not url:
        return ")"
    _, sep, rest = url.partition("://")
    if not sep:
        return ")" + url
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].partition("#")[0]
    host = host.rpartition("@")[2]
    name, colon, port = host.partition(":")
    if port in ("80", "443"):
        colon = port = ""
    return ",".join(reversed(name.split("."))) + colon + port + ")" + (path or "/")


def digest32(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as bytes; a revisit has no payload but its digest and length."""
    block = payload if kind == "response" else b""
    head = [
        VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        *([] if url is None else [f"WARC-Target-URI: {_line(url)}"]),
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-X-Payload-Length: {len(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if kind == "revisit" else []),
        "Content-Type: text/html", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict, bytes]:
    """Headers and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _gzip(data: bytes, level: int = 4) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write a record per page; return captures (key, page_id, file, offset, length).

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest id is the response and the others refer to it; smaller ones
    are all responses.  A null html is the empty payload; a null id is larger
    than any (a payload held only by null ids gives only responses), repeated
    rows with the smallest id are all responses.  An empty table gives no file.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.octet_length(html).alias("n"), F.sha1(html.cast("binary")).alias("sha"))
    firsts = slim.where(F.col("n") >= min_bytes).groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    again = (
        slim.join(firsts.where("copies > 1 AND first IS NOT NULL"), ["sha", "n"])
        .where(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("__again"), F.col("sha").alias("__sha"), "first").distinct()
    )
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("__again")) & (F.sha1(F.col("html").cast("binary")) == F.col("__sha")), "left")
    rows = rows.select("page_id", "url", "html", F.col("first").alias("refers_to"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(root)
        out, name, at, lines = None, "", 0, []
        store.create_dir(base, recursive=True)
        try:
            for batch in batches:
                for r in batch.to_pylist():
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    payload = r["html"].encode("utf-8", "surrogatepass")
                    kind = "response" if r["refers_to"] is None else "revisit"
                    data = _gzip(record(kind, r["page_id"], r["url"], payload, digest32(payload), r["refers_to"]))
                    out.write(data)
                    lines.append((reversed_host_key(r["url"]), r["page_id"], name, at, len(data)))
                    at += len(data)
                    if at >= FILE_BYTES:
                        out.close()
                        out = None
                yield _captures(lines)
                lines = []
        finally:
            if out is not None:
                out.close()

    return save(rows.mapInArrow(write, "key string, page_id long, file string, offset long, length long"), "warc-captures")


def _captures(lines: list) -> pa.RecordBatch:
    cols = list(zip(*lines, strict=True)) or [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["key", "page_id", "file", "offset", "length"])


def build_index(captures: DataFrame, root: str) -> DataFrame:
    """Sort the captures by key over the cluster and write index files; return
    the top level (file, first_key, last_key, directory offset and length).

    An index file is gzip blocks of BLOCK_LINES lines and, at its end, the
    directory of their first and last keys and byte ranges."""
    spread = captures.repartitionByRange("key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(root)
        name, at, directory, lines = f"{uuid.uuid4().hex}.cdx.gz", 0, [], []
        out = None

        def block():
            nonlocal at
            data = _gzip("\n".join(json.dumps(x) for x in lines).encode())
            out.write(data)
            directory.append([lines[0][0], lines[-1][0], at, len(data)])
            at += len(data)
            lines.clear()

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                lines.append([r["key"], r["page_id"], r["file"], r["offset"], r["length"]])
                if len(lines) >= BLOCK_LINES:
                    block()
        if out is None:
            return
        if lines:
            block()
        data = _gzip(json.dumps(directory).encode())
        out.write(data)
        out.close()
        yield pa.RecordBatch.from_pylist([{"file": name, "first_key": directory[0][0], "last_key": directory[-1][1], "at": at, "size": len(data)}])

    return save(spread.mapInArrow(write, "file string, first_key string, last_key string, at long, size long"), "warc-index")


def _range(store, path: str, offset: int, length: int) -> bytes:
    with store.open_input_file(path) as f:
        return f.read_at(length, offset)


def lookup(keys: DataFrame, index: DataFrame, root: str) -> DataFrame:
    """Captures of every key of ``keys`` (column key): (key, page_id, file, offset, length).

    The top level (one row per index file, as many as there were sort
    partitions) goes to every task; directories and blocks are range-read by
    the tasks that need them.  Keys are made distinct first, so a key with very
    many captures is one lookup, answered by all files and blocks it spans."""
    files = sorted(((r.first_key, r.last_key, r.file, r["at"], r["size"]) for r in index.collect()), key=lambda x: (x[0], x[1]))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lasts, firsts = [f[1] for f in files], [f[0] for f in files]
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                for i in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    out.append({"shard": i, "key": key})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("shard", pa.int32()), ("key", pa.string())]))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(root)
        shard, directory, firsts, lasts, held, lines, names = -1, [], [], [], -1, [], []
        for batch in batches:
            out = []
            for s, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{base}/{files[s][2]}"
                if s != shard:
                    directory = json.loads(zlib.decompress(_range(store, path, files[s][3], files[s][4]), 31))
                    firsts, lasts, shard, held = [d[0] for d in directory], [d[1] for d in directory], s, -1
                for b in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    if b != held:
                        lines = [json.loads(x) for x in zlib.decompress(_range(store, path, *directory[b][2:]), 31).split(b"\n")]
                        names, held = [x[0] for x in lines], b
                    out += [tuple(x) for x in lines[bisect_left(names, key):bisect_right(names, key)]]
            yield _captures(out)

    routed = keys.select("key").where("key IS NOT NULL").distinct().mapInArrow(route, "shard int, key string")
    # keys of one index file stay together in key order, so a block is read once or twice
    near = routed.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key")
    return near.mapInArrow(search, "key string, page_id long, file string, offset long, length long")


def fetch(captures: DataFrame, root: str) -> DataFrame:
    """Range-read the captures' records: (page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, payload).

    payload is null for revisits.  A response whose payload does not match its
    digest and length header is an error."""

    def get(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(root)
        held, f = "", None
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        ids = lambda x: int(x) if (x := x.removeprefix("<urn:page:").rstrip(">")) else None
        for batch in batches:
            out, size = [], 0
            for name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if name != held:
                    held, f = name, store.open_input_file(f"{base}/{name}")
                head, block = parse(zlib.decompress(f.read_at(length, offset), 31))
                kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                count = int(head["WARC-X-Payload-Length"])
                if kind == "response":
                    if digest32(block) != digest or len(block) != count:
                        raise ValueError(f"{held} at {offset}: payload does not match its digest")
                out.append({"page_id": ids(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"), "payload_bytes": count, "payload_digest": digest,
                            "record_type": kind, "refers_to": ids(head["WARC-Refers-To"]) if kind == "revisit" else None,
                            "payload": block if kind == "response" else None})
                size += len(block)
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    # ranges of one file in ascending order, a file in pieces of 16 MB
    piece = F.floor(F.col("offset") / (16 << 20))
    near = captures.select("file", "offset", "length").repartition("file", piece).sortWithinPartitions("file", "offset")
    return near.mapInArrow(get, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
