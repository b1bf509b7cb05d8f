"""Line dedup over range-partitioned hashes.

Each line's key (stripped, ASCII lower-cased) becomes a 128-bit hash. Rows (hash,
document, position) are range-partitioned by hash and document and sorted within a range
by hash, document (largest first) and position. A task streams its rows: the first
document of a hash keeps its lines, later ones lose theirs once enough documents have
been met. So a key that holds a large share of all lines is spread over many ranges.

A hash at the border of a range may go on in the next. Its undecided rows leave the task
beside a summary (documents met, largest document); the summaries, at most two per task,
are added up and decide them. Results are positions of dropped lines, gathered into a
compressed bitmap per document; texts are read only where they are to be rewritten.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.rows import as_batch, configure_batches, text_hash, text_or_empty
from gleanstar.session import stage

MIN_CHARS = 20
MIN_DOCS = 3
_STRIP = " \t\n\x0b\x0c\r"
DROP, OPEN, SUMMARY = 0, 1, 2

_LINES = pa.schema([("d0", pa.int64()), ("d1", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("pos", pa.int64())])
_KEYS = ["d0", "d1", "id", "h"]
_FOUND = pa.schema([("kind", pa.int32()), *_LINES, ("n", pa.int64())])
_FOUND_DDL = "kind int, d0 long, d1 long, id long, h long, pos long, n long"


def hash_lines(min_chars: int):
    def run(batches):
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            rows, positions, digests = [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                for at, line in enumerate(text.split("\n")):
                    key = line.strip(_STRIP)
                    if len(key) >= min_chars:
                        rows.append(row)
                        positions.append(at)
                        # bytes.lower() changes A-Z only
                        digests.append(xxhash.xxh3_128_digest(key.encode().lower()))
            if rows:
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                take = pa.array(rows, pa.int32())
                yield as_batch(_LINES, d[:, 0], d[:, 1], ids.take(take), hashes.take(take), positions)

    return run


class _Run:
    """The rows of one hash in a range, as far as they have been met."""

    def __init__(self, key, inner: bool):
        self.key, self.inner, self.docs, self.last, self.first = key, inner, 0, None, None
        self.waiting = []  # positions of the second to min_docs-th document


def stream_runs(min_docs: int):
    """Dropped rows, undecided rows and summaries of one sorted range."""

    def run(batches):
        state = None
        for batch in batches:
            out = []
            for d0, d1, id_, h, pos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state.key != (d0, d1):
                    if state is not None and not state.inner:
                        out.append((SUMMARY, *state.key, *state.first, None, state.docs))
                    # a run other than the range's first begins here, with its largest document
                    state = _Run((d0, d1), inner=state is not None)
                doc = (id_, h)
                if state.last != doc:
                    state.docs += 1
                    state.last = doc
                    state.first = state.first or doc
                row = (d0, d1, id_, h, pos, None)
                if not state.inner:
                    out.append((OPEN, *row))
                elif state.docs >= max(2, min_docs):
                    out += [(DROP, *w) for w in state.waiting]
                    out.append((DROP, *row))
                    state.waiting = []
                elif state.docs > 1:
                    state.waiting.append(row)
            if out:
                yield as_batch(_FOUND, *zip(*out, strict=True))
        if state is not None:
            # the last run may go on in the next range
            out = [(OPEN, *w) for w in state.waiting]
            out.append((SUMMARY, *state.key, *state.first, None, state.docs))
            yield as_batch(_FOUND, *zip(*out, strict=True))

    return run


_BITMAP = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("dropped", pa.binary())])


def bitmaps(batches):
    """Positions of dropped lines as a compressed bitmap."""
    for batch in batches:
        out = []
        for positions in batch.column(2):
            at = positions.values.to_numpy()
            bits = np.zeros(int(at.max()) + 1, np.uint8)
            bits[at] = 1
            out.append(zlib.compress(np.packbits(bits).tobytes()))
        yield as_batch(_BITMAP, batch.column(0), batch.column(1), out)


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Compressed bitmaps (zlib over bits, a bit per line) of the lines to drop: id, h (hash of
    the text), dropped. Documents that lose nothing have no row. Runs when it is called."""
    configure_batches(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("h"), text_or_empty(text_col).alias("text"))
    lines = rows.mapInArrow(hash_lines(min_chars), "d0 long, d1 long, id long, h long, pos long")
    order = [F.col("d0"), F.col("d1"), F.col("id").desc_nulls_last(), F.col("h").desc()]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    found = stage(ranged.mapInArrow(stream_runs(min_docs), _FOUND_DDL), "line_runs")
    # At most two summaries a range, so their sums may be broadcast.
    borders = (
        found.filter(F.col("kind") == SUMMARY)
        .groupBy("d0", "d1")
        .agg(F.sum("n").alias("docs"), F.max(F.struct("id", "h")).alias("largest"))
        .filter(F.col("docs") >= max(2, min_docs))
    )
    undecided = found.filter(F.col("kind") == OPEN).join(F.broadcast(borders), ["d0", "d1"])
    lost = ~(F.col("id").eqNullSafe(F.col("largest.id")) & (F.col("h") == F.col("largest.h")))
    drops = found.filter(F.col("kind") == DROP).select("id", "h", "pos").union(undecided.filter(lost).select("id", "h", "pos"))
    return drops.groupBy("id", "h").agg(F.collect_list("pos").alias("positions")).mapInArrow(bitmaps, "id long, h long, dropped binary")


def apply_bitmaps(with_text: bool):
    schema = pa.schema(
        [("id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string()), ("keep_bitmap", pa.binary())]
        + [("kept", pa.string())] * with_text
    )

    def run(batches):
        for batch in batches:
            out = []
            for text, dropped in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n, lost, kept = text.count("\n") + 1, 0, text
                keep = np.ones(n, np.uint8)
                if dropped is not None:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(dropped), np.uint8))[:n]
                    keep[: len(bits)] -= bits
                    lost = n - int(keep.sum())
                    kept = "\n".join(line for line, k in zip(text.split("\n"), keep, strict=True) if k)
                sha = hashlib.sha256(kept.encode()).hexdigest()
                out.append((n, lost, sha, zlib.compress(np.packbits(keep).tobytes()), *([kept] * with_text)))
            if out:
                yield as_batch(schema, batch.column(0), *zip(*out, strict=True))

    return run


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, kept_sha256, keep_bitmap (zlib over a bit
    per line) and, if wanted, kept (the text that stays).

    A line's key is the line without [\\x20\\x09-\\x0D] at its ends, with A-Z lower-cased. Keys of
    at least min_chars code points found in at least min_docs documents lose all their lines
    except in the largest document that holds them. NULL or empty text is one empty line. A
    document is an id with its text: equal rows count once and lose the same lines; rows that
    share an id but not their text are ordered by a hash of the text; a NULL id is smallest.
    An empty table gives no rows. Other columns are not read.
    """
    drops = stage(dropped_lines(docs, id_col, text_col, min_chars, min_docs), "line_bitmaps").withColumnsRenamed({"id": "i", "h": "t"})
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("h"), text_or_empty(text_col).alias("text"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("t"))
    joined = rows.join(drops.hint("shuffle_hash"), same, "left").select("id", "text", "dropped")
    kinds = "id long, n_lines long, n_dropped long, kept_sha256 string, keep_bitmap binary" + ", kept string" * with_text
    return joined.mapInArrow(apply_bitmaps(with_text), kinds).withColumnRenamed("id", id_col)
