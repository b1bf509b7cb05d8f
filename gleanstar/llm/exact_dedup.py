"""Exact dedup by Patricia-trie owners.

Every text is inserted whole, byte by byte, into a compressed radix trie over the texts
themselves, so common beginnings are stored once; a terminal node keeps the smallest
identifier and the number of texts that ended there. Tries are built twice:

1. in the task that reads the rows, so that copies meet before the shuffle and one text
   leaves a task once, however many copies it has (a hot group costs one row per task);
2. in the owner of a (length, content hash) partition, whose rows arrive sorted by that
   pair, so all subtrees but the current one are complete.

Both tries are bounded: beyond TRIE_BYTES whole subtrees are spilled. The reader spills
its largest subtree into the shuffle, where the owner merges it; the owner spills its
completed subtrees as results. The groups then meet the documents by the digest of the
text, in a join that carries no texts and that AQE splits if one group is hot.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.rows import as_batch, configure_batches, packed, text_or_empty

TRIE_BYTES = 32 * 1024 * 1024


class Node:
    __slots__ = ("children", "label", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.value, self.children = label, value, {}


def shared_length(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b[at:]."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def merged(a, b):
    """Of two (smallest id, count) values."""
    ids = [x for x in (a[0], b[0]) if x is not None]
    return (min(ids) if ids else None, a[1] + b[1])


class PatriciaTrie:
    """A compressed radix trie over byte strings with (smallest id, count) at its ends."""

    def __init__(self):
        self.root, self.size, self.sizes = Node(b""), 0, {}

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                self._grow(key, len(key) - at)
                return
            if not key.startswith(child.label, at):
                common = shared_length(child.label, key, at)
                fork = Node(child.label[:common])
                child.label = child.label[common:]
                fork.children[child.label[0]] = child
                node.children[key[at]] = child = fork
                self._grow(key, 0)
            at += len(child.label)
            node = child
        node.value = value if node.value is None else merged(node.value, value)

    def _grow(self, key: bytes, added: int) -> None:
        self.size += added + 300  # about what a node takes
        self.sizes[key[0]] = self.sizes.get(key[0], 0) + added + 300

    def walk(self, node: Node | None = None, prefix: bytes = b""):
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.value is not None:
                yield key, node.value
            stack += [(c, key) for c in node.children.values()]

    def spill(self, top: int | None = None):
        """Take out the subtree below a first byte (by default the largest) and yield its texts."""
        if not self.sizes:
            return
        top = max(self.sizes, key=self.sizes.get) if top is None else top
        self.size -= self.sizes.pop(top, 0)
        node = self.root.children.pop(top, None)
        if node is not None:
            yield from self.walk(node)


_TEXTS = pa.schema([("length", pa.int64()), ("hash", pa.int64()), ("text", pa.large_binary()), ("ident", pa.int64()), ("n", pa.int64())])
_GROUPS = pa.schema([("digest", pa.string()), ("ident", pa.int64()), ("group_size", pa.int64())])
OUT_BYTES = 4 * 1024 * 1024


def content_hash(text: bytes) -> int:
    """As Spark's xxhash64 of the text."""
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (h >> 63 << 64)


def _rows_out(ends, schema, row):
    """Batches of bounded size from (key, value) ends."""
    out, size = [], 0
    for key, value in ends:
        out.append(row(key, value))
        size += len(key)
        if size >= OUT_BYTES:
            yield as_batch(schema, *zip(*out, strict=True))
            out, size = [], 0
    if out:
        yield as_batch(schema, *zip(*out, strict=True))


def local_tries(limit: int):
    """Texts of a task's rows once each, with smallest id and count."""

    def row(key, value):
        return len(key), content_hash(key), key, *value

    def run(batches):
        trie = PatriciaTrie()
        for batch in batches:
            for text, ident in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                trie.insert(text.as_buffer().to_pybytes(), (ident, 1))
                while trie.size > limit:
                    yield from _rows_out(trie.spill(), _TEXTS, row)
        yield from _rows_out(trie.walk(), _TEXTS, row)

    return run


def owner_tries(limit: int):
    """One row per distinct text, from rows sorted by length and hash: texts of one length share a trie."""

    def row(key, value):
        return hashlib.sha256(key).hexdigest(), *value

    def run(batches):
        trie, at = PatriciaTrie(), None
        for batch in batches:
            plain = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            for length, hash_, ident, n, text in zip(*plain, batch.column(2), strict=True):
                if at != (length, hash_):
                    # every text of the earlier pairs has arrived
                    if at is not None and (trie.size > limit or length != at[0]):
                        for top in list(trie.sizes):
                            yield from _rows_out(trie.spill(top), _GROUPS, row)
                    at = (length, hash_)
                trie.insert(text.as_buffer().to_pybytes(), (ident, n))
        yield from _rows_out(trie.walk(), _GROUPS, row)

    return run


def text_groups(docs: DataFrame, id_col: str, text_col: str, largest: bool, limit: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: digest (SHA-256, hex), ident, group_size."""
    configure_batches(docs)
    ident = F.col(id_col).cast("long")
    text = text_or_empty(text_col)
    read = docs.select(
        text.cast("binary").alias("text"),
        # the bitwise complement reverses the order, so the smallest is the largest id
        (F.bitwise_not(ident) if largest else ident).alias("ident"),
    )
    local = read.mapInArrow(local_tries(limit), "length long, hash long, text binary, ident long, n long")
    owned = local.repartition("length", "hash").sortWithinPartitions("length", "hash")
    groups = owned.mapInArrow(owner_tries(limit), "digest string, ident long, group_size long")
    return groups.withColumn("keep_id", F.bitwise_not("ident") if largest else F.col("ident")).drop("ident")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", limit: int = TRIE_BYTES
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; NULL counts as the empty text. Of equal texts
    the row with the smallest (or largest) id stays. Rows that repeat both text and id are
    all marked as kept, as they are the same document. A NULL id never stays unless every
    id of the group is NULL (then keep_id is NULL). An empty table gives no rows. Other
    columns are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    digest = F.sha2(text_or_empty(text_col).cast("binary"), 256)
    rows = docs.select(F.col(id_col).alias("id"), digest.alias("digest"))
    groups = text_groups(docs, id_col, text_col, keep == "largest", limit)
    kept = F.col("id").cast("long").eqNullSafe(F.col("keep_id"))
    return rows.join(groups, "digest").select(
        F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256")
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", limit: int = TRIE_BYTES
) -> DataFrame:
    """The rows that `exact_dedup` keeps, with all their columns.

    Repeated rows of one id and text stay once; which one of them is then undefined.
    """
    digest = F.sha2(text_or_empty(text_col).cast("binary"), 256)
    groups = text_groups(docs, id_col, text_col, keep == "largest", limit)
    keys = ["digest", "key", "no_id"]  # digest and id: one row per text matches, so no key is hot

    def named(c):
        return {"key": F.coalesce(c, F.lit(0)), "no_id": c.isNull()}

    rows = packed(docs, digest=digest, **named(F.col(id_col).cast("long")))
    stays = groups.select("digest", *[c.alias(n) for n, c in named(F.col("keep_id")).items()])
    return rows.join(stays, keys).dropDuplicates(keys).select("row.*")
