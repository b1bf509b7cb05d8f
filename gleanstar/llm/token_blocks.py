"""Token ids in patched frame-of-reference blocks.

Documents are range-partitioned by id, encoded, and written in ascending order, one file
per range. A file is a sequence of segments. A segment holds the ids of consecutive
documents in blocks of BLOCK ids: the block's minimum is subtracted, the differences are
packed at the smallest width that fits a given share (percentile) of them, and the rest
stands in an exception list (position, whole difference). An index gives each block's
start, width and exceptions, so a block is read alone. Document ids and token counts
stand beside them. The end of a file lists its segments.

A file is renamed into place when complete and found only through the rows its task
returns, so a lost or repeated task leaves nothing that is read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanstar.llm.encoder import encoder, text_groups
from gleanstar.llm.files import RangeReader, new_folder, write_file
from gleanstar.llm.rows import as_batch, configure_batches, release, text_or_empty

BLOCK = 256
# Share of a block's differences that must fit the packed width.
PERCENTILE = 0.9
# Bytes of text whose ids make a segment (one text may be longer).
SEGMENT = 5 << 20
SEGMENTS_A_TASK = 2
_INDEX = np.dtype([("start", "<u8"), ("low", "<u4"), ("first_exception", "<u4"), ("width", "u1"), ("exceptions", "<u2")])
_EXCEPTION = np.dtype([("at", "<u2"), ("value", "<u4")])


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each value, most significant first."""
    raw = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(len(values), -1), axis=1)
    return raw.reshape(len(values), -1, 32)[:, :, 32 - width :]


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(block index, exceptions, payload) of unsigned 32-bit ids."""
    count = -(-len(ids) // BLOCK)
    full = np.full(count * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    full[: len(ids)] = ids
    full = full.reshape(count, BLOCK)
    low = full.min(axis=1, initial=2**32 - 1) if count else np.zeros(0, np.uint32)
    diff = full - low[:, None]
    need = max(1, int(np.ceil(percentile * BLOCK))) - 1
    at_percentile = np.partition(diff, need, axis=1)[:, need] if count else low
    width = np.zeros(count, np.uint8)
    for w in range(32):
        width += at_percentile >= np.uint64(1) << np.uint64(w)
    index = np.zeros(count, _INDEX)
    index["low"], index["width"] = low, width
    over = diff.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    block, position = np.nonzero(over)
    exceptions = np.zeros(len(block), _EXCEPTION)
    exceptions["at"], exceptions["value"] = position, diff[block, position]
    index["exceptions"] = over.sum(axis=1)
    index["first_exception"] = np.cumsum(index["exceptions"], dtype=np.int64) - index["exceptions"]
    sizes = width.astype(np.int64) * (BLOCK // 8)
    index["start"] = np.cumsum(sizes) - sizes
    payload = np.zeros(int(sizes.sum()), np.uint8)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = np.packbits(_bits(diff[rows], int(w)).reshape(len(rows), -1), axis=1)
        payload[index["start"][rows][:, None].astype(np.int64) + np.arange(packed.shape[1])] = packed
    return index, exceptions, payload.tobytes()


def unpack(index: np.ndarray, exceptions: np.ndarray, payload: np.ndarray, n: int) -> np.ndarray:
    """The first n ids of the indexed blocks, which may be a part of a segment's (their starts
    and first exceptions count from the parts given)."""
    out = np.zeros((len(index), BLOCK), np.uint32)
    for w in np.unique(index["width"]):
        rows = np.flatnonzero(index["width"] == w)
        if w:
            size = int(w) * (BLOCK // 8)
            raw = payload[index["start"][rows][:, None].astype(np.int64) + np.arange(size)]
            bits = np.unpackbits(raw, axis=1).reshape(len(rows), BLOCK, int(w))
            wide = np.zeros((len(rows), BLOCK, 32), np.uint8)
            wide[:, :, 32 - int(w) :] = bits
            out[rows] = np.packbits(wide.reshape(len(rows), -1), axis=1).view(">u4").astype(np.uint32)
    block = np.repeat(np.arange(len(index)), index["exceptions"])
    out[block, exceptions["at"]] = exceptions["value"]
    out += index["low"][:, None]
    return out.reshape(-1)[:n]


def _segment(doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray, percentile: float) -> bytes:
    index, exceptions, payload = pack(ids, percentile)
    given = doc_ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
    head = struct.pack("<5Q", len(doc_ids), len(ids), len(index), len(exceptions), len(payload))
    names = doc_ids.fill_null(0).to_numpy().astype("<i8")
    return b"".join([head, names.tobytes(), given.tobytes(), counts.astype("<u8").tobytes(), index.tobytes(), exceptions.tobytes(), payload])


def _read_segment(raw) -> tuple[list, np.ndarray, np.ndarray]:
    docs, n, blocks, exceptions, payload = struct.unpack_from("<5Q", raw)
    at = 40

    def take(dtype, count):
        nonlocal at
        out = np.frombuffer(raw, dtype, count, at)
        at += out.nbytes
        return out

    names, given, counts = take("<i8", docs), take(np.uint8, docs), take("<u8", docs).astype(np.int64)
    ids = unpack(take(_INDEX, blocks), take(_EXCEPTION, exceptions), take(np.uint8, payload), n)
    return [int(i) if g else None for i, g in zip(names, given, strict=True)], counts, ids


_WRITTEN = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("part", pa.int64()), ("segment", pa.int64()), ("n", pa.int64())])


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text", percentile: float = PERCENTILE
) -> DataFrame:
    """Encode and write; returns one row per segment: file, offset, length, part, segment, n."""
    configure_batches(docs)

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        code = encoder(tokenizer)
        found = []

        def segments():
            at = 0
            for batch in batches:
                for first, texts in text_groups(batch.column(1), SEGMENT):
                    ids, offsets = code.encode(texts)
                    ids = np.insert(ids, offsets[1:], np.uint32(end_id))
                    out = _segment(batch.column(0).slice(first, len(texts)), np.diff(offsets) + 1, ids, percentile)
                    found.append((at, len(out), len(ids)))
                    at += len(out)
                    yield out
            # the list of segments and its length end the file
            yield np.array(found, "<i8").tobytes() + struct.pack("<Q", len(found))

        file = write_file(folder, f"tokens-{part:06d}", segments())
        release()
        if found:
            rows = [(file, at, length, part, k, n) for k, (at, length, n) in enumerate(found)]
            yield as_batch(_WRITTEN, *zip(*rows, strict=True))

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id", "text")
    return ordered.mapInArrow(write, "file string, offset long, length long, part long, segment long, n long")


_READ = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.large_binary())])


def read_tokens(spark: SparkSession, segments: DataFrame, with_ids: bool = True) -> DataFrame:
    """Read written files back, a task per few segments: id, start, n_tokens, ids_crc32 and,
    if wanted, ids (little-endian unsigned 32-bit integers)."""
    # One row per file, so no more than there are ranges.
    sizes = segments.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("segments")).collect()
    base, at = {}, 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        base[r["part"]] = at
        at += r["n"]
    schema = pa.schema([*_READ][:3] + [("ids_crc32", pa.int64())] + ([_READ.field("ids")] if with_ids else []))

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                with RangeReader(r["file"]) as f:
                    names, counts, ids = _read_segment(f.read(r["offset"], r["length"]))
                ends = np.cumsum(counts)
                starts = ends - counts
                raw = memoryview(ids.astype("<u4").tobytes())
                parts = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [names, starts + (base[r["part"]] + r["before"]), counts, [zlib.crc32(p) for p in parts]]
                yield as_batch(schema, *columns, *([[bytes(p) for p in parts]] if with_ids else []))

    # tokens before a segment within its file: files hold a bounded range, so windows are small
    from pyspark.sql import Window

    before = F.sum("n").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    placed = segments.withColumn("before", F.coalesce(before, F.lit(0)))
    kinds = "id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    # the manifest is small, but what it names is not: one task per few segments
    tasks = max(1, sum(r["segments"] for r in sizes) // SEGMENTS_A_TASK)
    return placed.repartition(tasks).mapInArrow(read, kinds)


def token_blocks(
    docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, with_ids: bool = False
) -> DataFrame:
    """Write the documents' ids, each with `end_id` appended, and read them back: id, start,
    n_tokens, ids_crc32 (and ids). `start` counts the ids of all documents before.

    NULL counts as the empty text, which has the end id only. Rows with a NULL id come
    first; rows that repeat an id are ordered by their text, and equal ones are alike but
    for `start`. An empty table gives no rows. Other columns are not read.
    """
    from gleanstar.session import stage

    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    written = stage(write_tokens(docs, tokenizer, end_id, folder, id_col, text_col), "token_segments")
    return read_tokens(spark, written, with_ids).withColumnRenamed("id", id_col)
