"""WARC archives with a two-level capture index.

Writing: one record per page, each its own gzip member, in `.warc.gz` files of bounded size.
Of pages with equal payloads the one with the smallest id is a response, the others are
revisits without the payload.

Index: captures sorted by reversed-host URL key, in compressed blocks of BLOCK_LINES
lines. Each index file ends with a sparse directory, the first key of every block; the
manifest has the first and last key of every file. A lookup goes to the files whose range
holds its key, binary-searches their directory, reads only the blocks it needs by
range, and binary-searches these. Records are then read by range, in the order of
their archives.

Files are renamed into place when complete and found only through the rows their tasks
return, so a lost or repeated task leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.files import RangeReader, new_folder, write_file
from gleanstar.llm.rows import as_batch, configure_batches, shuffle_partitions
from gleanstar.session import stage

BLOCK_LINES = 1000
ARCHIVE_BYTES = 1 << 30
# Records this near in an archive are read by one task.
SPAN = 64 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PORTS = {"http": ":80", "https": ":443"}


def url_key(url: str | None) -> str:
    """Sort key of a URL: its host's labels from the last to the first, then path and query.

    Scheme, user, default port and fragment do not count, host names are lower-cased, and
    addresses are not reversed. NULL has the empty key."""
    if url is None:
        return ""
    scheme, found, rest = url.strip().partition("://")
    if not found:
        scheme, rest = "", scheme
    rest = rest.partition("#")[0]
    end = re.search(r"[/?\\]", rest)
    host, path = (rest[: end.start()], rest[end.start() :]) if end else (rest, "")
    host = host.rpartition("@")[2].lower().removesuffix(_PORTS.get(scheme.lower(), ":"))
    host, colon, port = host.partition(":") if not host.startswith("[") else (host, "", "")
    if not re.fullmatch(r"\[.*\]|[0-9.]+", host):
        host = ",".join(reversed(host.strip(".").split(".")))
    if not path.startswith("/"):
        path = "/" + path
    # a key is one field of a line
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", f"{host}{colon}{port}){path}")


def _header(value: str) -> str:
    return re.sub(r"[\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", value)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False, date: str = DATE) -> bytes:
    """One WARC record. A revisit has the HTTP header of the payload, with its length, only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def parse(raw: bytes) -> dict:
    """What a record says; the digest of a response is taken from the payload read."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and digest_of(payload) != stated:
        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    return {
        "id": _page(fields["warc-record-id"]),
        "payload_bytes": int(_fields(http)["content-length"]),
        "payload_digest": stated,
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


_CAPTURES = pa.schema([("key", pa.string()), ("id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_CAPTURES_DDL = "key string, id long, file string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, id_col: str, url_col: str, payload_col: str, min_bytes: int, date: str = DATE) -> DataFrame:
    """Write the archives; returns one capture per page: key, id, file, offset, length."""
    configure_batches(pages)
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    # beside the SHA-1 a second hash and the length tell payloads apart
    same = [F.sha1("payload").alias("d"), F.xxhash64("payload").alias("x"), F.length("payload").alias("n")]
    firsts = rows.select("id", *same).filter(F.col("n") >= min_bytes).groupBy("d", "x", "n").agg(F.min("id").alias("first"))
    known = rows.select("*", *same).join(firsts, ["d", "x", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    known = known.select("id", "url", "payload", "first", revisit.alias("revisit"))

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def pages_in():
            for batch in batches:
                ids, urls, _, first, again = (c.to_pylist() if k != 2 else None for k, c in enumerate(batch.columns))
                for k, p in enumerate(batch.column(2)):
                    yield ids[k], urls[k], p.as_buffer().to_pybytes(), first[k], again[k]

        rest, number = pages_in(), 0
        ahead = next(rest, None)
        while ahead is not None:
            found = []

            def members():
                nonlocal ahead
                at = 0
                while ahead is not None and (at == 0 or at < ARCHIVE_BYTES):
                    id_, url, body, first, again = ahead
                    packer = zlib.compressobj(wbits=31)
                    raw = packer.compress(record(id_, url, body, first, again, date)) + packer.flush()
                    found.append((url_key(url), id_, at, len(raw)))
                    at += len(raw)
                    yield raw
                    ahead = next(rest, None)

            file = write_file(folder, f"pages-{part:06d}-{number:04d}.warc.gz", members())
            number += 1
            for k in range(0, len(found), 10_000):
                keys, ids, offsets, lengths = zip(*found[k : k + 10_000], strict=True)
                yield as_batch(_CAPTURES, keys, ids, [file] * len(keys), offsets, lengths)

    return known.mapInArrow(write, _CAPTURES_DDL)


_FILES = pa.schema([("file", pa.string()), ("first", pa.string()), ("last", pa.string()), ("n", pa.int64())])


def _line(row) -> str:
    return "\t".join("" if v is None else str(v) for v in row)


def write_index(captures: DataFrame, folder: str) -> list[tuple[str, str, str]]:
    """Write the sorted index; returns the manifest (file, first key, last key), one entry per
    range of keys."""

    def write(batches):
        from pyspark import TaskContext

        directory, state = [], {"n": 0, "last": None}

        def blocks():
            lines, at = [], 0

            def block():
                nonlocal at
                raw = zlib.compress("\n".join(lines).encode())
                directory.append(f"{lines[0].partition(chr(9))[0]}\t{at}\t{len(raw)}")
                at += len(raw)
                return raw

            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    lines.append(_line(row))
                    state["n"] += 1
                    state["last"] = row[0]
                    if len(lines) == BLOCK_LINES:
                        yield block()
                        lines = []
            if lines:
                yield block()
            raw = zlib.compress("\n".join(directory).encode())
            yield raw + len(raw).to_bytes(8, "little")

        file = write_file(folder, f"index-{TaskContext.get().partitionId():06d}", blocks())
        if state["n"]:
            yield as_batch(_FILES, [file], [directory[0].partition("\t")[0]], [state["last"]], [state["n"]])

    ranged = captures.repartitionByRange(shuffle_partitions(captures), "key", "id").sortWithinPartitions("key", "id", "file", "offset")
    files = stage(ranged.mapInArrow(write, "file string, first string, last string, n long"), "index_files")
    return [(r["file"], r["first"], r["last"]) for r in files.collect()]


class IndexFile:
    """Binary search in one index file: its directory, then single blocks read by range."""

    def __init__(self, uri: str):
        self._reader = RangeReader(uri)
        end = self._reader.size()
        n = int.from_bytes(self._reader.read(end - 8, 8).to_pybytes(), "little")
        entries = zlib.decompress(self._reader.read(end - 8 - n, n)).decode().split("\n")
        self.firsts, starts, lengths = zip(*(e.split("\t") for e in entries), strict=True)
        self._places = [(int(a), int(b)) for a, b in zip(starts, lengths, strict=True)]
        self._kept = (None, None)
        self.blocks_read = 0

    def _block(self, k: int) -> list[str]:
        if self._kept[0] != k:
            self._kept = k, zlib.decompress(self._reader.read(*self._places[k])).decode().split("\n")
            self.blocks_read += 1
        return self._kept[1]

    def find(self, key: str):
        """Lines of all captures with this key."""
        # captures of a key may begin in the block before the first that begins with it
        k = max(0, bisect_left(self.firsts, key) - 1)
        while k < len(self.firsts) and self.firsts[k] <= key:
            lines = self._block(k)
            names = [line.partition("\t")[0] for line in lines]
            yield from lines[bisect_left(names, key) : bisect_right(names, key)]
            k += 1


def lookup(keys: DataFrame, manifest: list[tuple[str, str, str]]) -> DataFrame:
    """Captures of the distinct keys given (column key), found through the index."""
    manifest = sorted(manifest, key=lambda m: (m[1], m[2]))
    firsts, lasts = [m[1] for m in manifest], [m[2] for m in manifest]
    asked = pa.schema([("key", pa.string()), ("file", pa.int64())])

    def assign(batches):
        # files hold ranges of keys in order; a key with many captures lies in several
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                k = bisect_left(lasts, key)
                while k < len(firsts) and firsts[k] <= key:
                    out.append((key, k))
                    k += 1
            if out:
                yield as_batch(asked, *zip(*out, strict=True))

    def search(batches):
        at, index = None, None
        for batch in batches:
            out = []
            for key, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != k:
                    at, index = k, IndexFile(manifest[k][0])
                for line in index.find(key):
                    found, id_, file, offset, length = line.split("\t")
                    out.append((found, int(id_) if id_ else None, file, int(offset), int(length)))
                if len(out) >= 10_000:
                    yield as_batch(_CAPTURES, *zip(*out, strict=True))
                    out = []
            if out:
                yield as_batch(_CAPTURES, *zip(*out, strict=True))

    placed = keys.select("key").mapInArrow(assign, "key string, file long")
    return placed.repartition(max(1, len(manifest)), "file").sortWithinPartitions("file", "key").mapInArrow(search, _CAPTURES_DDL)


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records at the places given: id, payload_bytes, payload_digest, record_type, refers_to,
    url and, if wanted, payload (NULL for revisits)."""
    fields = [("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string())]
    fields += [("refers_to", pa.int64()), ("url", pa.string())] + [("payload", pa.binary())] * with_payload
    schema = pa.schema(fields)

    def read(batches):
        at, reader = None, None
        for batch in batches:
            out, size = [], 0
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != file:
                    at, reader = file, RangeReader(file)
                found = parse(zlib.decompress(reader.read(offset, length), wbits=31))
                out.append([found[f.name] for f in schema])
                size += length
                if size > 4 << 20:
                    yield as_batch(schema, *zip(*out, strict=True))
                    out, size = [], 0
            if out:
                yield as_batch(schema, *zip(*out, strict=True))

    near = captures.withColumn("span", F.floor(F.col("offset") / SPAN)).repartition(shuffle_partitions(captures), "file", "span")
    kinds = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload
    return near.sortWithinPartitions("file", "offset").select("file", "offset", "length").mapInArrow(read, kinds)


def url_keys(df: DataFrame, url_col: str) -> DataFrame:
    """The distinct keys of a table's URLs."""
    configure_batches(df)
    schema = pa.schema([("key", pa.string())])

    def run(batches):
        for batch in batches:
            yield as_batch(schema, [url_key(u) for u in batch.column(0).to_pylist()])

    return df.select(url_col).distinct().mapInArrow(run, "key string").distinct()


def archive(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> list[tuple[str, str, str]]:
    """Write archives and index below `folder`; returns the index manifest."""
    captures = stage(write_archives(pages, f"{folder}/archives", id_col, url_col, payload_col, min_bytes), "captures")
    return write_index(captures, f"{folder}/index")


def round_trip(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    with_payload: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Write all pages, look all their URLs up in the index and read the records: one row per
    input row: id, payload_bytes, payload_digest (base32 SHA-1), record_type, refers_to, url
    and, if wanted, payload.

    Of records with equal payloads of at least min_bytes the one with the smallest id is a
    response and the others revisit it; rows that repeat this id and payload are all
    responses, and so are all whose ids are NULL if no id is given. NULL payloads are
    empty. NULL URLs have the empty key and no target in the record; control characters in
    URLs are percent-encoded. An empty table gives no rows. Other columns are not read.
    Writing runs when it is called.
    """
    manifest = archive(pages, folder or new_folder(pages.sparkSession, "warc"), id_col, url_col, payload_col, min_bytes)
    found = lookup(url_keys(pages, url_col), manifest)
    return read_records(found, with_payload).withColumnRenamed("id", id_col)
