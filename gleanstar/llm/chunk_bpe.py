"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash over WINDOW bytes meets a condition, so equal passages
of different documents give equal chunks wherever they stand. Three passes:

1. every chunk's 128-bit digest is counted; those met more than once are shared, and the
   smallest (document id, text hash) that holds one owns it;
2. owners encode their shared chunks, once each; digests and ids go to a store of sorted
   files in the shared folder, one per range of digests;
3. every document is put together from stored ids for its shared chunks and from its own
   encoding of the rest.

Chunks end anywhere, so the ids at a join can be wrong: the text between the last blank
before a join and the first blank after it is encoded again and replaces what was there;
where a chunk has no blank, this goes on over the following chunks until both sides agree.
No text is shuffled: only digests, and the ids of shared chunks, which meet by binary
search in the memory-mapped store. A worker loads only the pages it searches.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.encoder import encoder
from gleanstar.llm.files import new_folder, open_shards, write_arrays
from gleanstar.llm.rows import _BASE, _INVERSE, _VALUES, as_batch, blocks, configure_batches, mix, powers, release, text_buffer, text_hash, text_or_empty
from gleanstar.session import stage

WINDOW = 16
# Mean bytes of a chunk (a power of two).
MEAN = 512
# Digests a task holds before it passes their counts on.
TABLE = 200_000
_BLANK = re.compile("[ \n]")


def cut_points(data: np.ndarray, offsets: np.ndarray, mean: int = MEAN) -> np.ndarray:
    """Byte positions before which a chunk ends, other than the ends of texts."""
    n = len(data)
    if n <= WINDOW:
        return np.zeros(0, np.int64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUES[data] * powers(_BASE, n))])
    rolled = (total[WINDOW:] - total[:-WINDOW]) * powers(_INVERSE, n - WINDOW + 1)
    cuts = np.flatnonzero(mix(rolled) < np.uint64(2**64 // mean)) + WINDOW
    cuts = cuts[cuts < n]
    cuts = cuts[(data[cuts] & 0xC0) != 0x80]  # not within a character
    start = offsets[np.searchsorted(offsets, cuts, "right") - 1]
    return cuts[cuts - start >= WINDOW]  # the window lies within the text


def chunked(batch: pa.RecordBatch, column: int, mean: int):
    """(row, bytes of the text, chunk edges) for the rows of each block of a batch."""
    data, offsets = text_buffer(batch.column(column))
    for first, part, at in blocks(data, offsets):
        cuts = cut_points(part, at, mean)
        raw = part.tobytes()
        of = np.searchsorted(cuts, at)
        out = []
        for k in range(len(at) - 1):
            inner = cuts[of[k] : of[k + 1]]
            inner = inner[inner > at[k]]
            out.append((first + k, raw[at[k] : at[k + 1]], [0, *(inner - at[k]).tolist(), int(at[k + 1] - at[k])]))
        yield out


_SEEN = pa.schema([("d0", pa.int64()), ("d1", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("n", pa.int64())])


def _lower(a, b):
    """The smaller owner; a NULL id is smallest, as in Spark."""
    def order(x):
        return (x[0] is not None, x[0] or 0, x[1])

    return a if order(a) <= order(b) else b


def count_chunks(mean: int):
    def flush(seen):
        digests = np.frombuffer(b"".join(seen), "<i8").reshape(-1, 2)
        owners = list(seen.values())
        return as_batch(_SEEN, digests[:, 0], digests[:, 1], *zip(*owners, strict=True))

    def run(batches):
        seen = {}
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block in chunked(batch, 2, mean):
                for row, raw, edges in block:
                    for a, b in zip(edges, edges[1:], strict=False):
                        digest = xxhash.xxh3_128_digest(raw[a:b])
                        owner = (ids[row], hashes[row])
                        old = seen.get(digest)
                        seen[digest] = (*owner, 1) if old is None else (*_lower(old[:2], owner), old[2] + 1)
                    if len(seen) > TABLE:
                        yield flush(seen)
                        seen = {}
        if seen:
            yield flush(seen)
        release()

    return run


_FILES = pa.schema([("file", pa.string()), ("first", pa.int64()), ("n", pa.int64())])
_FILES_DDL = "file string, first long, n long"


def sorted_store(df: DataFrame, folder: str, stem: str, arrays) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """Write df in files by ranges of its digest column d0; `arrays` turns a range's rows
    into flat arrays, of which d0 is one. Returns the files and the first digest of each;
    there are as many files as shuffle partitions."""

    def write(batches):
        from pyspark import TaskContext

        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is not None and table.num_rows:
            out = arrays(table)
            file = write_arrays(folder, f"{stem}-{TaskContext.get().partitionId():06d}", out)
            yield as_batch(_FILES, [file], [int(out["d0"][0])], [table.num_rows])

    ranged = df.repartitionByRange("d0").sortWithinPartitions("d0", "d1")
    files = stage(ranged.mapInArrow(write, _FILES_DDL), stem).orderBy("first").collect()
    return tuple(f.file for f in files), tuple(f.first for f in files)


def find(shards, firsts: np.ndarray, d0: np.ndarray, d1: np.ndarray) -> list:
    """(shard, position) of each digest, or None."""
    out = [None] * len(d0)
    if not len(firsts):
        return out
    where = np.searchsorted(firsts, d0, "right") - 1
    for s in np.unique(where[where >= 0]).tolist():
        shard, rows = shards[s], np.flatnonzero(where == s)
        known, at = shard["d0"], np.searchsorted(shard["d0"], d0[rows])
        inside = at < len(known)
        rows, at = rows[inside], at[inside]
        while len(rows):  # digests that share their first half stand together
            same = known[at] == d0[rows]
            rows, at = rows[same], at[same]
            hit = shard["d1"][at] == d1[rows]
            for r, k in zip(rows[hit].tolist(), at[hit].tolist(), strict=True):
                out[r] = (s, k)
            rows, at = rows[~hit], at[~hit] + 1
            rows, at = rows[at < len(known)], at[at < len(known)]
    return out


def _plain(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def owner_arrays(table: pa.Table) -> dict[str, np.ndarray]:
    ids = table.column("id")
    return {
        "d0": _plain(table, "d0"), "d1": _plain(table, "d1"), "h": _plain(table, "h"),
        "id": ids.fill_null(0).to_numpy(), "null": ids.is_null().to_numpy().astype(np.uint8),
    }


def ids_arrays(table: pa.Table) -> dict[str, np.ndarray]:
    """Stored encodings; a chunk that two equal rows have both encoded stands once or twice alike."""
    parts = table.column("ids").to_pylist()
    return {
        "d0": _plain(table, "d0"), "d1": _plain(table, "d1"),
        "head": _plain(table, "head"), "tail": _plain(table, "tail"),
        "end": np.cumsum([len(p) for p in parts], dtype=np.int64), "ids": np.frombuffer(b"".join(parts), np.uint8),
    }


def split_chunk(text: str) -> tuple[str, str, str] | None:
    """Text up to the first blank, between the first and the last, and after the last."""
    first = _BLANK.search(text)
    if first is None:
        return None
    last = max(text.rfind(" "), text.rfind("\n"))
    return text[: first.start()], text[first.start() : last + 1], text[last + 1 :]


def _digests(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<i8").reshape(-1, 2)


_STORED = pa.schema([("d0", pa.int64()), ("d1", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()), ("ids", pa.binary())])


def encode_owned(tokenizer: str, mean: int, files, firsts):
    """Ids of the shared chunks that the rows of a task own."""

    def run(batches):
        shards, code, starts = open_shards(files), encoder(tokenizer), np.array(firsts, np.int64)
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block in chunked(batch, 2, mean):
                rows = [row for row, _, edges in block for _ in edges[1:]]
                parts = [raw[a:b] for _, raw, edges in block for a, b in zip(edges, edges[1:], strict=False)]
                digests = _digests(parts)
                own = {}
                for k, place in enumerate(find(shards, starts, digests[:, 0], digests[:, 1])):
                    if place is not None:
                        shard, at = shards[place[0]], place[1]
                        id_ = None if shard["null"][at] else int(shard["id"][at])
                        if (id_, int(shard["h"][at])) == (ids[rows[k]], hashes[rows[k]]):
                            own[digests[k].tobytes()] = parts[k].decode()
                if own:
                    thirds = [split_chunk(t) or (t, "", "") for t in own.values()]
                    head, middle, tail = (encoded_list(code, list(x)) for x in zip(*thirds, strict=True))
                    keys = np.frombuffer(b"".join(own), "<i8").reshape(-1, 2)
                    whole = [a + b + c for a, b, c in zip(head, middle, tail, strict=True)]
                    yield as_batch(_STORED, keys[:, 0], keys[:, 1], list(map(len, head)), list(map(len, tail)), whole)
        release()

    return run


def encoded_list(code, texts: list[str]) -> list[bytes]:
    """The ids of many texts."""
    ids, offsets = code.encode(pa.array(texts, pa.large_string()))
    raw, cuts = ids.tobytes(), (4 * offsets).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def assemble(runs: list, code) -> bytes:
    """Ids of a text from its runs (text, stored thirds or None), repaired at their joins."""
    out: list[bytes] = []
    open_text, open_ids = "", b""  # what follows the last blank so far

    def closed(text: str, ids: bytes) -> bytes:
        if not open_text:
            return ids
        if not text:
            return open_ids
        # both sides of the join hold a part of one piece: encode it again as a whole
        again = code.encode_all([open_text + text])[0]
        return open_ids + ids if again == open_ids + ids else again

    for text, thirds in runs:
        parts = split_chunk(text)
        if thirds is None:
            encoded = code.encode_all(list(parts) if parts else [text])
        elif parts:
            encoded = thirds
        else:
            encoded = [thirds[0]]
        if parts is None:
            # no blank yet: the join reaches into the next run
            open_ids = closed(text, encoded[0])
            open_text += text
            continue
        out += [closed(parts[0], encoded[0]), encoded[1]]
        open_text, open_ids = parts[2], encoded[2]
    out.append(open_ids)
    return b"".join(out)


def _runs(raw: bytes, edges: list[int], places: list, shards) -> list:
    """Stored chunks one by one, neighbouring chunks that are not stored as one run."""
    runs, since = [], None
    for k, place in enumerate(places):
        if place is None:
            since = edges[k] if since is None else since
            continue
        if since is not None:
            runs.append((raw[since : edges[k]].decode(), None))
            since = None
        shard, at = shards[place[0]], place[1]
        end = int(shard["end"][at])
        ids = shard["ids"][int(shard["end"][at - 1]) if at else 0 : end].tobytes()
        head, tail = int(shard["head"][at]), int(shard["tail"][at])
        runs.append((raw[edges[k] : edges[k + 1]].decode(), (ids[:head], ids[head : len(ids) - tail], ids[len(ids) - tail :])))
    if since is not None:
        runs.append((raw[since:].decode(), None))
    return runs


def encode_documents(tokenizer: str, mean: int, files, firsts, schema: pa.Schema):
    with_ids = "ids" in schema.names

    def run(batches):
        shards, code, starts = open_shards(files), encoder(tokenizer), np.array(firsts, np.int64)
        numbers = [str(i) for i in range(len(code.tokens))]
        for batch in batches:
            names = batch.column(0).to_pylist()
            for block in chunked(batch, 2, mean):
                parts = [raw[a:b] for _, raw, edges in block for a, b in zip(edges, edges[1:], strict=False)]
                digests = _digests(parts)
                places = find(shards, starts, digests[:, 0], digests[:, 1])
                del parts
                at, ids, whole = 0, [b""] * len(block), []
                for k, (_, raw, edges) in enumerate(block):
                    own = places[at : at + len(edges) - 1]
                    at += len(edges) - 1
                    if any(p is not None for p in own):
                        ids[k] = assemble(_runs(raw, edges, own, shards), code)
                    else:
                        whole.append(k)
                for k, raw in zip(whole, encoded_list(code, [block[k][1].decode() for k in whole]), strict=True):
                    ids[k] = raw
                columns = [[names[row] for row, _, _ in block], [len(i) // 4 for i in ids], [], []]
                decoded = []
                for raw in ids:
                    numbered = np.frombuffer(raw, "<u4")
                    listed = numbered.tolist()
                    columns[2].append(hashlib.sha256(" ".join(map(numbers.__getitem__, listed)).encode()).hexdigest())
                    text = code.decode(numbered)
                    columns[3].append(hashlib.sha256(text.encode()).hexdigest())
                    if with_ids:
                        decoded.append(text)
                if with_ids:
                    columns += [ids, decoded]
                yield as_batch(schema, *columns)
        release()

    return run


def chunk_bpe(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", mean: int = MEAN, with_ids: bool = False
) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids
    (little-endian unsigned 32-bit integers) and decoded (the text as the library decodes it).

    NULL counts as the empty text, which has no tokens. Ids may be NULL or repeat. An empty
    table gives no rows. Other columns are not read. Passes 1 and 2 run when this is called.
    """
    configure_batches(docs)
    folder = new_folder(docs.sparkSession, "chunks")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("h"), text_or_empty(text_col).alias("text"))
    seen = rows.mapInArrow(count_chunks(mean), "d0 long, d1 long, id long, h long, n long")
    shared = (
        seen.groupBy("d0", "d1")
        .agg(F.min(F.struct("id", "h")).alias("owner"), F.sum("n").alias("n"))
        .filter("n > 1")
        .select("d0", "d1", "owner.id", "owner.h")
    )
    owners = sorted_store(stage(shared, "shared_chunks"), folder, "owners", owner_arrays)
    owned = rows.mapInArrow(encode_owned(tokenizer, mean, *owners), "d0 long, d1 long, head long, tail long, ids binary")
    stored = sorted_store(stage(owned, "owned_chunks"), folder, "ids", ids_arrays)
    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    kinds = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.binary()), ("decoded", pa.string())]
        kinds += ", ids binary, decoded string"
    out = rows.mapInArrow(encode_documents(tokenizer, mean, *stored, pa.schema(fields)), kinds)
    return out.withColumnRenamed("id", id_col)
