"""Cost-balanced packing of token ids into sequences of a fixed capacity.

A document's ids cost LINEAR a token plus QUADRATIC a token pair (attention within the
document). Each task encodes the documents it reads and packs them window by window: as
many sequences as the window fills are open at once, and the documents, longest first, go
each to the open sequence of least cost that has room for them. A document longer than a
sequence gives whole sequences first and goes on with what is left of it; one that has no
room in the few cheapest sequences fills the cheapest and goes on in the next. What is left when all
sequences of a window are full (less than one sequence) moves to the next window; at the
end of the task it is cut into sequences whose lengths are powers of two, which are not
padded. So no sequence is padded at all, whatever the lengths.

Nothing is shuffled, and a task holds one window. The pieces are stored before they are
returned, so a task that runs again cannot number its sequences otherwise.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.encoder import encoder, text_groups
from gleanstar.llm.rows import as_batch, configure_batches, release, text_or_empty
from gleanstar.session import stage

CAPACITY = 4096
# Relative cost of a token and of a pair of tokens: the matrix products of a layer of width
# 1024 take 24 * 1024 * 1024 operations a token, its attention 4 * 1024 a pair.
LINEAR, QUADRATIC = 1.0, 1 / 6144
# Sequences that are open at once.
WINDOW = 1024
# So many of the cheapest sequences are tried before a document is cut.
TRIES = 8


def cost(length: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> float:
    return linear * length + quadratic * length * length


def balanced(lengths: list[int], capacities: list[int], weigh=cost) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Pieces (document, start, length, sequence, offset), and what found no room: (document,
    start, length). Sequences are filled as far as the documents go."""
    heap = [(0.0, s) for s, room in enumerate(capacities) if room]
    room, pieces, left = list(capacities), [], []
    largest = max(capacities, default=0)
    # a document beyond the largest sequence counts by its first piece
    for d in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start, rest = 0, lengths[d]
        while rest and heap:
            tried = []
            while heap and len(tried) < TRIES:
                tried.append(heapq.heappop(heap))
                if room[tried[-1][1]] >= min(rest, largest):
                    break
            last = tried[-1]
            chosen = last if room[last[1]] >= min(rest, largest) else tried[0]
            for entry in tried:
                if entry is not chosen:
                    heapq.heappush(heap, entry)
            spent, s = chosen
            n = min(rest, room[s])
            pieces.append((d, start, n, s, capacities[s] - room[s]))
            room[s] -= n
            if room[s]:
                heapq.heappush(heap, (spent + weigh(n), s))
            start, rest = start + n, rest - n
        if rest:
            left.append((d, start, rest))
    return pieces, left


def powers_of_two(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs the documents of one task, given one after another."""

    def __init__(self, capacity: int, window: int, weigh):
        if capacity & (capacity - 1):
            raise ValueError("the capacity must be a power of two")
        self.capacity, self.limit, self.weigh = capacity, capacity * window, weigh
        # waiting parts of documents: document, first of its ids that are here, ids, ids in all
        self.parts, self.held, self.sequences = [], 0, 0

    def add(self, doc, ids: np.ndarray) -> list[tuple]:
        self.parts.append((doc, 0, ids, len(ids)))
        self.held += len(ids)
        return self._pack(self.held // self.capacity * [self.capacity]) if self.held >= self.limit else []

    def close(self) -> list[tuple]:
        return self._pack(self.held // self.capacity * [self.capacity] + powers_of_two(self.held % self.capacity))

    def _pack(self, capacities: list[int]) -> list[tuple]:
        """(document, start, ids, ids of the document, sequence, offset, cost of the sequence)."""
        pieces, left = balanced([len(p[2]) for p in self.parts], capacities, self.weigh)
        spent = [0.0] * len(capacities)
        for _, _, n, s, _ in pieces:
            spent[s] += self.weigh(n)
        out = []
        for d, start, n, s, offset in pieces:
            doc, first, ids, total = self.parts[d]
            out.append((doc, first + start, ids[start : start + n], total, self.sequences + s, offset, spent[s]))
        self.parts = [(self.parts[d][0], self.parts[d][1] + start, self.parts[d][2][start : start + n].copy(), self.parts[d][3]) for d, start, n in left]
        self.held = sum(n for _, _, n in left)
        self.sequences += len(capacities)
        return out


_PIECES = pa.schema(
    [("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_cost", pa.float64())]
)
_KINDS = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    window: int = WINDOW,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_cost (that of all pieces of the sequence) and, if wanted, ids (little-endian
    unsigned 32-bit integers).

    A document's ids are its text's and `end_id`. Each of its ids is in one piece; the pieces of
    a sequence follow one another without a gap. A sequence number is the task's times 2**32
    plus one of its own, so numbers are distinct but not consecutive. NULL counts as the empty
    text, which has the end id only; ids may be NULL or repeat, each row is a document. An
    empty table gives no rows. Other columns are not read. Runs when it is called.
    """
    configure_batches(docs)
    schema = pa.schema([*_PIECES, *([pa.field("ids", pa.binary())] if with_ids else [])])

    def run(batches):
        from pyspark import TaskContext

        code, base = encoder(tokenizer), TaskContext.get().partitionId() << 32
        packer = Packer(capacity, window, lambda n: cost(n, linear, quadratic))

        def rows(pieces):
            raw = [np.ascontiguousarray(p[2], "<u4").tobytes() for p in pieces]
            columns = [
                [p[0] for p in pieces], [p[1] for p in pieces], [len(p[2]) for p in pieces], [zlib.crc32(r) for r in raw],
                [p[3] for p in pieces], [base + p[4] for p in pieces], [p[5] for p in pieces], [p[6] for p in pieces],
            ]
            return as_batch(schema, *columns, *([raw] if with_ids else []))

        for batch in batches:
            for first, texts in text_groups(batch.column(1)):
                names = batch.column(0).slice(first, len(texts)).to_pylist()
                ids, offsets = code.encode(texts)
                ids = np.insert(ids, offsets[1:], np.uint32(end_id))
                offsets = offsets + np.arange(len(offsets))
                pieces = []
                for name, a, b in zip(names, offsets, offsets[1:], strict=False):
                    pieces += packer.add(name, ids[a:b])
                if pieces:
                    yield rows(pieces)
        pieces = packer.close()
        if pieces:
            yield rows(pieces)
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    packed = stage(rows.mapInArrow(run, _KINDS + ", ids binary" * with_ids), "packed_pieces")
    return packed.withColumnRenamed("id", id_col)
