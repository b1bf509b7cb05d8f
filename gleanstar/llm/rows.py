"""Helpers shared by the operators: whole input rows, Arrow batches, hashed words."""

from __future__ import annotations

import ctypes
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Arrow batches are cut at this size as well as at their usual number of rows.
BATCH_BYTES = 16 * 1024 * 1024


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def configure_batches(df: DataFrame) -> None:
    """Bound Arrow batches, and let Python workers import this package from where the driver
    has it (where it is installed or shipped otherwise, this changes nothing)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in path:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, path)])


def shuffle_partitions(df: DataFrame) -> int:
    """The session's number. Named in a repartition it holds also where AQE would join
    partitions that are small but stand for much work."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as the struct `row`, beside derived columns: names in the input
    cannot clash with the derived ones."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_hash(name: str) -> Column:
    """64 bits of a text: with the document's id it names a row, so that rows that share
    an id but not their text stay apart."""
    return F.xxhash64(text_or_empty(name))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying it row by row."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def release() -> None:
    """Hand the memory that a finished task no longer needs back to the system: workers live
    on, and a later stage shares their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# Word bytes: ASCII capitals lower-cased, separators [\x20\x09-\x0D] as 0.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 0
_FOLD[32] = 0
# NUL is a word byte of its own.
_SPACE = np.zeros(256, bool)
_SPACE[9:14] = _SPACE[32] = True


def splitmix(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values."""
    z = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return mix(z)


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = splitmix(256, 77)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for blocks of usual size."""
    have = _powers.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    out = np.full(max(n, 1 << 16), np.uint64(base & (2**64 - 1)))
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if len(out) <= 1 << 22:
        _powers[base] = out
    return out[:n]


def hashed_words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a block of texts, and word offsets per text."""
    hashes, starts, _ = placed_words(data, offsets, space)
    return hashes, np.searchsorted(starts, offsets)


def placed_words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a block of texts, with their starts and ends.

    Words are runs of bytes other than those of `space`, by default [\\x20\\x09-\\x0D], with
    A-Z lower-cased. The hash is a polynomial over the bytes, taken from one running sum of the block.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~space[data]
    edge = np.zeros(n + 1, bool)
    inner = offsets[(offsets > 0) & (offsets < n)]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[inner] |= word[inner]
    edge[1:n] = word[:-1] & ~word[1:]
    edge[n] = word[-1]
    edge[inner] |= word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(edge)
    term = _VALUES[_FOLD[data]] * powers(_BASE, n)
    total = np.cumsum(term)
    h = (total[ends - 1] - total[starts] + term[starts]) * powers(_INVERSE, n)[starts]
    return mix(h ^ (ends - starts).astype(np.uint64)), starts, ends


BLOCK = 1 << 21


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK):
    """(first row, bytes, offsets) of consecutive rows with about `size` bytes in all."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
