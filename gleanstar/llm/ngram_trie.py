"""Language-model scoring with an Elias-Fano n-gram trie.

The model is an interpolated n-gram model with absolute discounting, for a context node h:

    p(w | h) = max(c(h w) - DISCOUNT, 0) / c(h) + rest(h) * p(w | shorter h)

over n-grams met at least CUTOFF times; rest(h) is what these leave, so p adds up to one.
The lowest order is (c + 1) / (N + V + 1).

Level 1 holds the 64-bit hashes of all words (Elias-Fano) with their counts. A level above holds, for each
context (a node of the level below), its words: a monotone sequence of pointers gives every
context a range of its own, as long as its largest word needs, and the words stand in a
second monotone sequence relative to the pointer of their context. So a child is searched
as the successor of pointer + word, within its context's range. Discounted probabilities and
rests are quantised to 256 values each.

Counting and building are distributed: tasks send sorted n-gram keys, Elias-Fano coded, by
range of contexts; the task of a range adds them up and writes its shard to the shared
folder, from where scoring tasks map it. A worker loads only the pages it searches, so the
model may grow with the corpus. Word numbers of all texts are stored once for the passes.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm import elias_fano as ef
from gleanstar.llm.files import new_folder, open_shards, write_arrays
from gleanstar.llm.language_id import remainder
from gleanstar.llm.rows import as_batch, blocks, configure_batches, hashed_words, shuffle_partitions, text_buffer, text_or_empty
from gleanstar.session import stage

ORDER = 3
# n-grams met less often would be left out; 1 keeps all.
CUTOFF = 1
DISCOUNT = 0.75
# n-grams a task holds before it sends them on.
HELD = 2_000_000
# n-grams a shard holds at most, by the number of tokens that are counted.
SHARD = 2_000_000
# The end of a text is a word of its own.
END = np.uint64(0x9E3779B97F4A7C15)
_ABSENT = np.uint32(2**32 - 1)

_SENT = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_SENT_DDL = "shard int, keys binary, counts binary"
_BUILT = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n", pa.int64()), ("total", pa.int64())])
_BUILT_DDL = "shard int, file string, n long, total long"


def n_shards(docs: DataFrame, tokens: int = 0) -> int:
    """Shards of a level: in proportion to the shuffle partitions the session sets, and so many
    that none has more than SHARD different n-grams, of which there are no more than tokens."""
    return max(1, shuffle_partitions(docs) // 4, -(-tokens // SHARD))


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    every, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    edges = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[edges], np.add.reduceat(n, edges) if len(edges) else n


def sent(keys: list[np.ndarray], counts: list[np.ndarray], split):
    """Batches of coded keys by shard; split(keys) gives shard numbers and keys within them."""
    every, n = added(keys, counts)
    shard, local = split(every)
    edges = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    for a, b in zip(edges, [*edges[1:], len(shard)], strict=True):
        coded = zlib.compress(n[a:b].astype("<u4").tobytes(), 1)
        yield as_batch(_SENT, [int(shard[a])], [ef.to_bytes(local[a:b])], [coded])


def counting(find_keys, split):
    """A task's n-gram counts: find_keys(batch) yields arrays of keys."""

    def run(batches):
        keys, counts, held = [], [], 0
        for batch in batches:
            for found in find_keys(batch):
                values, n = np.unique(found, return_counts=True)
                keys.append(values)
                counts.append(n)
                held += len(values)
                if held >= HELD:
                    yield from sent(keys, counts, split)
                    keys, counts, held = [], [], 0
        if held:
            yield from sent(keys, counts, split)

    return run


def building(folder: str, stem: str, arrays):
    """Adds up the counts of each shard and writes it: arrays(shard, keys, counts) gives what to
    write and the number of nodes."""

    def run(batches):
        at, keys, counts = None, [], []

        def built():
            every, n = added(keys, counts)
            out, nodes = arrays(at, every, n)
            file = write_arrays(folder, f"{stem}-{at:06d}", out)
            return as_batch(_BUILT, [at], [file], [nodes], [int(n.sum())])

        for batch in batches:
            for shard, coded, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != shard:
                    if keys:
                        yield built()
                    at, keys, counts = shard, [], []
                keys.append(ef.from_bytes(coded))
                counts.append(np.frombuffer(zlib.decompress(n), "<u4").astype(np.int64))
                if sum(map(len, keys[1:])) > 4 * len(keys[0]):
                    merged = added(keys, counts)
                    keys, counts = [merged[0]], [merged[1]]
        if keys:
            yield built()

    return run


@lru_cache(maxsize=4096)
def _sequence(files: tuple[str, ...], k: int, prefix: str) -> ef.EliasFano:
    """A sequence of a level's k-th file, set up once per worker."""
    return ef.EliasFano(open_shards(files)[k], prefix)


class Shards:
    """Shards of a level by number: their files and the number of their first node."""

    def __init__(self, rows: list, shards: int):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.files = tuple(r["file"] for r in rows)
        self.place = {r["shard"]: k for k, r in enumerate(rows)}
        self.first, self.nodes = {}, 0
        for r in rows:
            self.first[r["shard"]] = self.nodes
            self.nodes += r["n"]
        self.total = sum(r["total"] for r in rows)
        self.shards = shards

    def arrays(self, shard: int) -> dict[str, np.ndarray] | None:
        k = self.place.get(shard)
        return None if k is None else open_shards(self.files)[k]


    def sequence(self, shard: int, prefix: str = "") -> ef.EliasFano:
        return _sequence(self.files, self.place[shard], prefix)


def _runs(shard: np.ndarray):
    """(shard, slice) of sorted shard numbers."""
    if not len(shard):
        return
    edges = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    for a, b in zip(edges, [*edges[1:], len(shard)], strict=True):
        yield int(shard[a]), slice(a, b)


def quantised(values: np.ndarray, prefix: str) -> dict[str, np.ndarray]:
    """Values as one of 256 each: the means of bins that hold equally many."""
    distinct, inverse = np.unique(values, return_inverse=True)
    if len(distinct) <= 256:
        return {f"{prefix}code": inverse.astype(np.uint8), f"{prefix}book": distinct.astype(np.float32)}
    order = np.argsort(values, kind="stable")
    bins = np.zeros(len(values), np.int64)
    bins[order] = np.arange(len(values)) * 256 // len(values)
    # equal values share a bin
    bins = np.minimum.reduceat(bins[order], np.flatnonzero(np.diff(inverse[order], prepend=-1)))[inverse]
    book = np.bincount(bins, values, 256) / np.maximum(np.bincount(bins, minlength=256), 1)
    return {f"{prefix}code": bins.astype(np.uint8), f"{prefix}book": book.astype(np.float32)}


class Words:
    """Level 1: words by hash; their numbers are their ranks."""

    def __init__(self, shards: Shards):
        self.shards = shards
        self.size = shards.nodes
        starts = [shards.first.get(s) for s in range(shards.shards)]
        for s in range(shards.shards - 1, -1, -1):
            if starts[s] is None:
                starts[s] = starts[s + 1] if s + 1 < shards.shards else shards.nodes
        self.starts = np.array(starts, np.int64)

    @staticmethod
    def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def split(shards: int):
        return lambda hashes: (Words.shard_of(hashes, shards), hashes)

    @staticmethod
    def build(shard, keys, counts):
        return {**ef.encode(keys), "count": counts.astype("<u8")}, len(keys)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, 2**32 - 1 for unknown words."""
        distinct, inverse = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), _ABSENT, np.uint32)
        for s, part in _runs(self.shard_of(distinct, self.shards.shards)):
            if s in self.shards.place:
                at = self.shards.sequence(s).find(distinct[part])
                out[part] = np.where(at >= 0, at + self.shards.first[s], _ABSENT).astype(np.uint32)
        return out[inverse]

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Occurrences of the words with sorted numbers (0 for unknown words)."""
        out = np.zeros(len(numbers), np.int64)
        known = np.searchsorted(numbers, _ABSENT)
        shard = np.searchsorted(self.starts, numbers[:known], "right") - 1
        for s, part in _runs(shard):
            out[:known][part] = self.shards.arrays(s)["count"][numbers[:known][part].astype(np.int64) - self.starts[s]]
        return out


class Level:
    """Level k > 1: the words of each context."""

    def __init__(self, shards: Shards, contexts: int):
        self.shards, self.contexts = shards, contexts

    @staticmethod
    def first_context(shard, contexts: int, shards: int):
        return -(-shard * contexts // shards)

    @staticmethod
    def split(contexts: int, shards: int, words: int):
        """Keys are context * words + word; within a shard the context counts from its first."""

        def run(keys):
            context = (keys // np.uint64(words)).astype(np.int64)
            shard = context * shards // contexts
            first = Level.first_context(shard, contexts, shards)
            return shard, keys - first.astype(np.uint64) * np.uint64(words)

        return run

    @staticmethod
    def build(contexts: int, shards: int, words: int, cutoff: int, discount: float):
        def run(shard, keys, counts):
            size = int(Level.first_context(shard + 1, contexts, shards) - Level.first_context(shard, contexts, shards))
            context, word = (keys // np.uint64(words)).astype(np.int64), (keys % np.uint64(words)).astype(np.int64)
            total = np.bincount(context, counts, size)
            kept = counts >= cutoff
            context, word, counts = context[kept], word[kept], counts[kept]
            p = (counts - discount) / total[context]
            rest = 1 - np.bincount(context, p, size)
            span = np.zeros(size, np.int64)
            np.maximum.at(span, context, word + 1)
            pointer = np.concatenate([[0], np.cumsum(span)]).astype(np.uint64)
            places = pointer[context] + word.astype(np.uint64)
            out = ef.encode(pointer, "pointer_") | ef.encode(places, "word_") | quantised(p, "p_") | quantised(np.clip(rest, 0, 1), "rest_")
            return out, int(kept.sum())

        return run

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node or -1, discounted probability, rest of the context) of pairs sorted by context."""
        node = np.full(len(context), -1, np.int64)
        p, rest = np.zeros(len(context), np.float32), np.ones(len(context), np.float32)
        for s, part in _runs(context * self.shards.shards // max(self.contexts, 1)):
            arrays = self.shards.arrays(s)
            if arrays is None:
                continue
            local = context[part] - self.first_context(s, self.contexts, self.shards.shards)
            rest[part] = arrays["rest_book"][arrays["rest_code"][local]]
            # pointers of each distinct context and of the next
            edges = np.flatnonzero(np.diff(local, prepend=-1))
            pointers = self.shards.sequence(s, "pointer_")
            low, high = pointers.access(local[edges]), pointers.access(local[edges] + 1)
            of = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(local))))
            place = low[of] + word[part].astype(np.uint64)
            rows = np.flatnonzero(place < high[of])
            at = self.shards.sequence(s, "word_").find(place[rows])
            found = rows[at >= 0]
            at = at[at >= 0]
            node[part.start + found] = at + self.shards.first[s]
            p[part.start + found] = arrays["p_book"][arrays["p_code"][at]]
        return node, p, rest


class Trie:
    """Levels built so far."""

    def __init__(self, words: Words):
        self.words, self.levels = words, []

    def nodes(self, numbers: np.ndarray, starts: np.ndarray):
        """For texts of word numbers, one after another: the node of the context of each place,
        and lists of (discounted probability, rest) from level 2 up to the last.

        The begin of a text is the context `words.size`; -1 is no node."""
        context = np.empty(len(numbers), np.int64)
        context[1:] = numbers[:-1]
        context[starts] = self.words.size
        context[context == int(_ABSENT)] = -1
        parts = []
        for level in self.levels:
            node = np.full(len(numbers), -1, np.int64)
            p, rest = np.zeros(len(numbers), np.float32), np.ones(len(numbers), np.float32)
            rows = np.flatnonzero(context >= 0)
            if len(rows):
                # unknown words are no child of any context, but their context has its rest
                word = np.where(numbers[rows] == _ABSENT, self.words.size, numbers[rows].astype(np.int64))
                pair = context[rows].astype(np.uint64) * np.uint64(self.words.size + 1) + word.astype(np.uint64)
                distinct, inverse = np.unique(pair, return_inverse=True)
                of = (distinct // np.uint64(self.words.size + 1)).astype(np.int64)
                found = level.find(of, (distinct % np.uint64(self.words.size + 1)).astype(np.int64))
                node[rows], p[rows], rest[rows] = (f[inverse] for f in found)
            parts.append((p, rest))
            # the n-gram that ends here is the context of the next place
            context = np.empty(len(numbers), np.int64)
            context[1:] = node[:-1]
            context[starts] = -1
        return context, parts


# Words that are looked up at a time (a longer text is looked up as a whole).
LOOKED_UP = 1 << 20


def _texts(column: pa.Array):
    """(word numbers, starts of texts) of a binary column, about LOOKED_UP words at a time."""
    numbers, ends = _numbers(column)
    for _, part, at in blocks(numbers, np.concatenate([[0], ends]), LOOKED_UP):
        if len(part):
            yield part, at[:-1]


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, ends of texts) of a binary column."""
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_binary(column.type)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint32)[at[0] // 4 : at[-1] // 4], (at[1:] - at[0]) // 4


def _with_end(hashes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes with the end of each text after its words, and the ends of texts."""
    return np.insert(hashes, edges[1:], END), edges[1:] + np.arange(1, len(edges))


def train(docs: DataFrame, id_col: str, text_col: str, order: int, cutoff: int, discount: float, folds: int, held: int):
    """(trie, tokens N, stored word numbers) of a corpus: id, held_out, numbers."""
    configure_batches(docs)
    shards, folder = n_shards(docs), new_folder(docs.sparkSession, "trie")
    out = F.coalesce(remainder(id_col, folds) == held, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), out.alias("held_out"), text_or_empty(text_col).alias("text"))

    def level(found: DataFrame, find_keys, split, arrays, stem: str, shards: int) -> Shards:
        """Count and build; the manifest has one row per shard."""
        counted = found.mapInArrow(counting(find_keys, split), _SENT_DDL)
        by_shard = counted.repartition(shuffle_partitions(docs), "shard").sortWithinPartitions("shard")
        return Shards(stage(by_shard.mapInArrow(building(folder, stem, arrays), _BUILT_DDL), stem).collect(), shards)

    def word_keys(batch):
        data, offsets = text_buffer(batch.column(0))
        for _, part, at in blocks(data, offsets):
            yield _with_end(*hashed_words(part, at))[0]

    counted = level(rows.filter("not held_out").select("text"), word_keys, Words.split(shards), Words.build, "words", shards)
    trie = Trie(Words(counted))

    def to_numbers(batches):
        schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("numbers", pa.binary())])
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for first, part, at in blocks(data, offsets):
                hashes, ends = _with_end(*hashed_words(part, at))
                raw = trie.words.number(hashes).tobytes()
                cuts = [0, *(4 * ends).tolist()]
                texts = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                yield as_batch(schema, *(batch.column(k).slice(first, len(texts)) for k in (0, 1)), texts)

    numbered = stage(rows.mapInArrow(to_numbers, "id long, held_out boolean, numbers binary"), "word_numbers")
    contexts = trie.words.size + 1
    words = trie.words.size + 1
    shards = n_shards(docs, counted.total)
    for k in range(2, order + 1):

        def keys(batch):
            for numbers, starts in _texts(batch.column(0)):
                context, _ = trie.nodes(numbers, starts)
                rows = np.flatnonzero(context >= 0)
                yield context[rows].astype(np.uint64) * np.uint64(words) + numbers[rows].astype(np.uint64)

        texts = numbered.filter("not held_out").select("numbers")
        arrays = Level.build(max(contexts, 1), shards, words, cutoff, discount)
        found = level(texts, keys, Level.split(max(contexts, 1), shards, words), arrays, f"level{k}", shards)
        trie.levels.append(Level(found, max(contexts, 1)))
        contexts = found.nodes
    return trie, counted.total, numbered


_SCORES = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]


def scoring(trie: Trie, total: int):
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), *_SCORES])

    def run(batches):
        every = total + trie.words.size + 1
        for batch in batches:
            columns = [[], [], [], []]
            for numbers, starts in _texts(batch.column(2)):
                distinct, inverse = np.unique(numbers, return_inverse=True)
                count = trie.words.counts(distinct)[inverse]
                base = (count + 1) / every
                p = base.copy()
                for discounted, rest in trie.nodes(numbers, starts)[1]:
                    p = discounted + rest * p
                # every text has its end, so no slice is empty
                columns[0].append(np.diff(np.append(starts, len(numbers))))
                for k, x in enumerate(((count > 0).astype(np.int64), np.log10(base), np.log10(p))):
                    columns[k + 1].append(np.add.reduceat(x, starts))
            if columns[0]:
                n, known, base, score = (np.concatenate(c) for c in columns)
                yield as_batch(schema, batch.column(0), batch.column(1), n, known, [total] * len(n), base, score)

    return run


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    cutoff: int = CUTOFF,
    discount: float = DISCOUNT,
    folds: int = 7,
    held: int = 2,
) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of a text (runs of bytes other than [\\x20\\x09-\\x0D], A-Z lower-cased) and
    one end. Learned from all rows whose fold (crc32 of the id as text, modulo `folds`) is
    not `held`; rows with a NULL id are learned from. base_score: log10 probability by
    (c + 1) / (N + V + 1); score: by the whole model. NULL counts as the empty text, which is
    one end. Rows may repeat. An empty table gives no rows; if all rows are held out, N and V
    are 0. Other columns are not read. Learning runs when it is called.
    """
    trie, total, numbered = train(docs, id_col, text_col, order, cutoff, discount, folds, held)
    kinds = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return numbered.mapInArrow(scoring(trie, total), kinds).withColumnRenamed("id", id_col)
