"""N-gram Jaccard join by T-occurrence search.

Documents become sets of hashed word shingles; equal sets are one class from then on. A
partner of a set x with n shingles shares at least T = ceil(threshold * n) of them, so the
search asks for sets that occur in at least T of x's inverted lists. It is done in two steps.

Across the cluster, on the first p + k shingles in hash order (p = n - T + 1, k = REACH % of p):
partners share k + 1 of these, so a set whose first shingles are mostly met nowhere else has
no partner, and any p of them include a shared one. Each remaining set therefore probes
the p of its lists that are shortest, restricted to partners that are as large or larger (by
size class). Sets linked through probed lists form blocks. Nothing is dropped: every
pair that reaches the threshold lies in one block.

Within a block, DivideSkip: the T - 1 or fewer longest lists are set aside and the short ones
merged by a heap, which leaps over sets that cannot be in enough of them; sets met often
enough are looked up in the long lists by binary search, until they reach or can no longer
reach the overlap. Sets already linked with the query, or of a size out of reach, leave the
short lists before they are merged, so a group of near copies costs one link a set rather
than all pairs.
A block that is larger than a slice is cut into slices of bounded number and bytes, and no
task holds more than two: each slice is searched by itself, one set of each component found
is searched with those of the other slices, and then all pairs of slices are searched whose
sizes are within reach and that are not within one component. A family of near copies is one
component by then.
"""

from __future__ import annotations

from bisect import bisect_left
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.graph import EDGES_DDL, UnionFind, components, edge_batch
from gleanstar.llm.rows import as_batch, blocks, configure_batches, hashed_words, mix, packed, splitmix, text_buffer, text_hash, text_or_empty
from gleanstar.session import stage

WORDS = 3
PERCENT = 90
REACH = 100
# List lengths are told apart up to this; longer lists all count as longest.
LENGTHS = 1000
# Lists per set that join large groups ahead of the complete pass.
FEW = 4
# Sets of a slice, and bytes of their shingles, on average; a task holds two slices.
SLICE = 2000
SLICE_BYTES = 16 * 1024 * 1024
# Weight of DivideSkip's trade between merging and probing.
MU = 0.0085


def least_overlap(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def shingle_sets(batch: pa.RecordBatch, column: int, words: int):
    """(row, sorted distinct shingle hashes) of each row."""
    factors = splitmix(words, 11)
    data, offsets = text_buffer(batch.column(column))
    for first, part, at in blocks(data, offsets):
        hashes, ends = hashed_words(part, at)
        full = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for j in range(words):
            full += hashes[j : j + len(full)] * factors[j]
        full = mix(full)
        for k in range(len(at) - 1):
            a, b = int(ends[k]), int(ends[k + 1])
            if b - a >= words:
                yield first + k, np.unique(full[a : b - words + 1])
            elif b > a:
                # fewer words: the whole sequence is one shingle
                short = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield first + k, mix(np.array([short]))
            else:
                yield first + k, np.zeros(0, np.uint64)


_CLASSES = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("s", pa.binary())])


def classes(words: int):
    """(id, hash of the text, set size, digest of the set) per row."""

    def run(batches):
        for batch in batches:
            n, s = [0] * batch.num_rows, [None] * batch.num_rows
            for row, tokens in shingle_sets(batch, 2, words):
                if len(tokens):
                    n[row], s[row] = len(tokens), xxhash.xxh3_128_digest(tokens.tobytes())
            yield as_batch(_CLASSES, batch.column(0), batch.column(1), n, s)

    return run


_FIRST = pa.schema([("token", pa.int64()), ("s", pa.binary()), ("n", pa.int64())])
SEEN = 1_000_000


def first_shingles(words: int, percent: int, reach: int):
    """The p + k smallest shingles of each distinct set of a task."""

    def run(batches):
        seen = set()
        for batch in batches:
            tokens, names, sizes, counts = [], [], [], []
            for _, found in shingle_sets(batch, 0, words):
                if not len(found):
                    continue
                name = xxhash.xxh3_128_digest(found.tobytes())
                if name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen = set()
                seen.add(name)
                p = len(found) - least_overlap(len(found), percent) + 1
                tokens.append(found[: p + p * reach // 100])
                names.append(name)
                sizes.append(len(found))
                counts.append(len(tokens[-1]))
            if names:
                take = pa.array(np.repeat(np.arange(len(names), dtype=np.int32), counts))
                size = pa.array(sizes, pa.int64()).take(take)
                yield as_batch(_FIRST, np.concatenate(tokens).view(np.int64), pa.array(names, pa.binary()).take(take), size)

    return run


_LISTED = pa.schema([*_FIRST, ("length", pa.int64())])


def digests(column: pa.Array) -> np.ndarray:
    """16-byte values as rows of two numbers."""
    _, offsets, data = column.buffers()
    wide = pa.types.is_large_binary(column.type)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(data, np.uint64, 2 * len(column), int(at)).reshape(-1, 2) if len(column) else np.zeros((0, 2), np.uint64)


def _binary(rows: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * 16)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(rows))])


def shared_lists(batches):
    """Rows of the lists that hold at least two sets, with the list's length (up to LENGTHS),
    from rows sorted by token and set. Equal rows of several tasks count once. A list that
    goes on in the next batch is kept until LENGTHS rows of it have been met."""

    def rows_out(tokens, s, n, lengths):
        return as_batch(_LISTED, tokens, _binary(s), n, lengths)

    kept = None  # rows of the last list, not passed on yet
    long = None  # (token, last set) of a long list that has been passed on so far
    for batch in batches:
        tokens, s, n = batch.column(0).to_numpy(), digests(batch.column(1)), batch.column(2).to_numpy()
        if not len(tokens):
            continue
        if kept is not None:
            tokens, s, n = np.concatenate([kept[0], tokens]), np.concatenate([kept[1], s]), np.concatenate([kept[2], n])
            kept = None
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (s[1:] != s[:-1]).any(axis=1)
        if long is not None and tokens[0] == long[0]:
            # rows that repeat the last one passed on
            repeats = int(np.argmax(fresh[1:])) + 1 if fresh[1:].any() else len(fresh)
            if (s[0] == long[1]).all():
                fresh[:repeats] = False
        tokens, s, n = tokens[fresh], s[fresh], n[fresh]
        if not len(tokens):
            continue
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        lengths = np.diff(np.append(starts, len(tokens)))
        if long is not None and tokens[0] == long[0]:
            lengths[0] = LENGTHS
        size = np.minimum(np.repeat(lengths, np.diff(np.append(starts, len(tokens)))), LENGTHS)
        last = int(starts[-1])
        if lengths[-1] >= LENGTHS:
            long, end = (tokens[-1], s[-1].copy()), len(tokens)
        else:
            kept, long, end = (tokens[last:], s[last:], n[last:]), None, last
        take = np.flatnonzero(size[:end] > 1)
        if len(take):
            yield rows_out(tokens[take], s[take], n[take], size[take])
    if kept is not None and len(kept[0]) > 1:
        yield rows_out(*kept, np.full(len(kept[0]), len(kept[0])))


def probe_forest(batches):
    """Edges between the sets of each probed list, as forests; rows are sorted by list,
    probing sets first."""
    key, pivot, joined = None, None, UnionFind()
    for batch in batches:
        token, size, probe = (batch.column(k).to_numpy() for k in range(3))
        s = digests(batch.column(3))
        if not len(token):
            continue
        first = np.concatenate([[key != (token[0], size[0])], (token[1:] != token[:-1]) | (size[1:] != size[:-1])])
        starts = np.flatnonzero(first)
        if not first[0]:
            # the list goes on from the batch before
            end = int(starts[0]) if len(starts) else len(token)
            if pivot is not None:
                for x in s[:end]:
                    if (name := x.tobytes()) != pivot:
                        joined.union(name, pivot)
        if len(starts):
            of = np.repeat(starts, np.diff(np.append(starts, len(token))))
            inner = np.arange(int(starts[0]), len(token))
            hit = (probe[of] == 1) & (s[inner] != s[of]).any(axis=1)
            raw = s.tobytes()
            for a, b in zip(inner[hit].tolist(), of[hit].tolist(), strict=True):
                joined.union(raw[16 * a : 16 * a + 16], raw[16 * b : 16 * b + 16])
            begin = int(starts[-1])
            key, pivot = (token[begin], size[begin]), s[begin].tobytes() if probe[begin] else None
        if len(joined.parent) > 500_000:
            yield edge_batch(joined.edges())
            joined = UnionFind()
    if edges := joined.edges():
        yield edge_batch(edges)


def merge_skip(lists: list[list[int]], least: int):
    """(value, number of lists that hold it) of the values of at least `least` sorted lists,
    in order. Where the heap's first value is in too few, the lists that could not make up
    the number move on to the first value of those left."""
    at = [0] * len(lists)
    heap = [(own[0], k) for k, own in enumerate(lists)]
    heapify(heap)
    while len(heap) >= least:
        value = heap[0][0]
        out = []
        while heap and heap[0][0] == value:
            out.append(heappop(heap)[1])
        if len(out) >= least:
            yield value, len(out)
            target = value + 1
        else:
            out += [heappop(heap)[1] for _ in range(least - 1 - len(out))]
            target = heap[0][0]
        for k in out:
            own = lists[k]
            at[k] = bisect_left(own, target, at[k])
            if at[k] < len(own):
                heappush(heap, (own[at[k]], k))


# Long lists that are probed before the overlap that is left is looked at again.
PROBES = 32


def divide_skip(sets: list[np.ndarray], queries, percent: int, links: UnionFind, data=None, known=None) -> None:
    """Link each query set with all sets of `data` (all sets, if not given) that reach the
    threshold, by position in `sets`; sets that are `known` to be of one component count as linked."""
    sizes = np.array([len(s) for s in sets])
    data = np.arange(len(sets)) if data is None else np.sort(np.asarray(data))
    owner = np.repeat(data, sizes[data])
    flat = np.concatenate([sets[k] for k in data])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    tokens, starts = np.unique(flat, return_index=True)
    ends = np.append(starts[1:], len(flat))
    # lists one after another, each ascending: one array that any list is searched in
    width = len(sets)
    rows = np.repeat(np.arange(len(tokens)) * width, ends - starts) + owner
    # a set's component so far
    group = np.arange(len(sets)) if known is None else np.unique(known, return_inverse=True)[1]
    members = {}
    for k, g in enumerate(group.tolist()):
        members.setdefault(g, []).append(k)
    for q in queries:
        if len(members[group[q]]) == len(sets):
            continue
        mine = sets[q]
        n = len(mine)
        least = least_overlap(n, percent)
        at = np.minimum(np.searchsorted(tokens, mine), len(tokens) - 1)
        at = at[tokens[at] == mine]
        if len(at) < least:
            continue
        at = at[np.argsort(ends[at] - starts[at], kind="stable")]
        longest = int(ends[at[-1]] - starts[at[-1]])
        n_long = min(least - 1, int(least / (MU * np.log2(longest + 1) + 1)))
        short, long = at[: len(at) - n_long], at[len(at) - n_long :]
        # overlap needed with a set of each size: o >= percent * (n + m) / (100 + percent)
        need = np.maximum(least, -(-percent * (n + sizes) // (100 + percent)))
        may = (group != group[q]) & (sizes * 100 >= n * percent) & (n * 100 >= sizes * percent)
        spans = ends[short] - starts[short]
        first = np.cumsum(spans) - spans
        merged = owner[np.arange(int(spans.sum())) - np.repeat(first - starts[short], spans)]
        left = may[merged]
        if not left.any():
            continue
        counts = np.add.reduceat(left, first)
        merged = merged[left]
        fewest = int(need[merged].min()) - n_long
        cut = np.cumsum(counts[counts > 0])
        lists = [part.tolist() for part in np.split(merged, cut[:-1])]
        for c, overlap in merge_skip(lists, max(1, fewest)):
            if group[c] == group[q] or overlap + n_long < need[c]:
                continue
            for k in range(0, n_long, PROBES):
                if overlap >= need[c] or overlap + n_long - k < need[c]:
                    break
                wanted = long[k : k + PROBES] * width + c
                found = np.minimum(np.searchsorted(rows, wanted), len(rows) - 1)
                overlap += int((rows[found] == wanted).sum())
            if overlap >= need[c]:
                links.union(q, c)
                a, b = group[q], group[c]
                if len(members[a]) < len(members[b]):
                    a, b = b, a
                group[members[b]] = a
                members[a] += members.pop(b)


BOTH, QUERY, DATA = 0, 1, 2


def search_slices(percent: int):
    """Links found for each key (block, two slices); rows are sorted by key and set."""

    def run(batches):
        key, names, sets, known, sides = None, [], [], [], []

        def search():
            links = UnionFind()
            queries, data = ([k for k, side in enumerate(sides) if side != other] for other in (DATA, QUERY))
            if len(names) > 1 and queries and data:
                divide_skip(sets, queries, percent, links, data, known)
            return [(names[a], names[b]) for a, b in links.edges()]

        for batch in batches:
            out = []
            for block, left, right, side, s, component, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (block, left, right):
                    out += search()
                    key, names, sets, known, sides = (block, left, right), [], [], [], []
                if names and names[-1] == s:
                    continue
                names.append(s)
                sets.append(np.frombuffer(raw, np.uint64))
                known.append(component)
                sides.append(side)
            if out:
                yield edge_batch(out)
        if out := search():
            yield edge_batch(out)

    return run


_SETS = pa.schema([("block", pa.binary()), ("s", pa.binary()), ("n", pa.int64()), ("slices", pa.int64()), ("raw", pa.binary())])


def set_bytes(words: int):
    def run(batches):
        for batch in batches:
            raw = [b""] * batch.num_rows
            for row, tokens in shingle_sets(batch, 4, words):
                raw[row] = tokens.tobytes()
            yield as_batch(_SETS, *batch.columns[:4], raw)

    return run


def _least(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def size_class(n: Column, percent: int) -> Column:
    """Linked sets are of the same class or of two classes beside each other."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / percent + 0.001)))


def row_key(id_: Column, h: Column) -> Column:
    """Names a row; rows with an id come first, by their id."""
    return F.struct(id_.isNull().alias("no_id"), F.coalesce(id_, F.lit(0).cast("long")).alias("id"), h.alias("h"))


def list_edges(active: DataFrame, held: bool) -> DataFrame:
    """Edges between the sets that probe a list and, with `held`, all sets it holds.

    active: s, size, tokens (shortest lists first), probes (how many of them are probed).
    Without `held`, only the FEW longest lists that a set probes: that joins most of a large
    group at few edges a set, and leaves the rest to the complete pass."""
    if not held:
        few = F.slice("tokens", F.greatest(F.col("probes") - FEW + 1, F.lit(1)), F.least(F.col("probes"), F.lit(FEW)))
        rows = active.select(F.explode(few).alias("token"), "size", F.lit(1).alias("probe"), "s")
    else:
        sizes = F.explode(F.array(F.col("size"), F.col("size") + 1))
        rows = active.select(F.explode(F.slice("tokens", F.lit(1), F.col("probes"))).alias("token"), "size", "s")
        rows = rows.select("token", sizes.alias("size"), F.lit(1).alias("probe"), "s")
        rows = rows.union(active.select(F.explode("tokens").alias("token"), "size", F.lit(0).alias("probe"), "s"))
    by_list = rows.repartition("token", "size").sortWithinPartitions("token", "size", F.desc("probe"), "s")
    return by_list.mapInArrow(probe_forest, EDGES_DDL)


def n_slices() -> Column:
    """Slices that the sets of a group need."""
    return F.ceil(F.greatest(F.count("*") / SLICE, F.sum("n") * 8 / SLICE_BYTES))


def searched(rows: DataFrame, percent: int) -> DataFrame:
    """Links of rows (block, left, right, side, s, component, raw); left and right name the slices."""
    rows = rows.select("block", "left", "right", "side", "s", "component", "raw")
    dealt = rows.repartition("block", "left", "right").sortWithinPartitions("block", "left", "right", "s")
    return dealt.mapInArrow(search_slices(percent), EDGES_DDL)


def by_themselves(sets: DataFrame) -> DataFrame:
    """Each slice alone; sets has block, s, slices, raw."""
    part = F.pmod(F.xxhash64("s"), F.col("slices")).cast("string")
    return sets.select("block", part.alias("left"), part.alias("right"), F.lit(BOTH).alias("side"), "s", F.col("s").alias("component"), "raw")


def across(sets: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """All pairs of slices of a block that can hold links, but those within one component.

    named: block, s, n, component. A slice holds sets of one size class, so it is searched with
    those of the classes beside it only. A component of more than a slice has its own slices, so
    pairs of these need no search; the sets of all other components of a block share slices."""
    wide = named.groupBy("block", "component").agg(n_slices().alias("k")).filter("k > 1")
    wide = wide.select("block", "component", F.col("component").alias("owner"))
    place = named.join(wide, ["block", "component"], "left").withColumn("owner", F.coalesce("owner", F.unhex(F.lit(""))))
    place = place.withColumn("size", size_class(F.col("n"), percent))
    own = stage(place.groupBy("block", "owner", "size").agg(n_slices().alias("k")), "slices_of_components")
    name = lambda part: F.concat_ws("/", F.hex("owner"), "size", part)
    part = F.pmod(F.xxhash64("s"), F.col("k"))
    place = place.join(own, ["block", "owner", "size"]).select("s", "component", name(part).alias("slice"))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("part")
    slices = own.select("block", "owner", "size", numbers).select("block", "owner", "size", name(F.col("part")).alias("left"))
    beside = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size")
    other = slices.select("block", F.col("owner").alias("other"), beside, F.col("left").alias("right"))
    pairs = slices.join(other, ["block", "size"]).filter("left <= right and not (owner = other and owner <> x'')")
    pairs = stage(pairs.select("block", "left", "right"), "slice_pairs")
    placed = sets.select("block", "s", "raw").join(place, "s")
    side = F.when(F.col("left") == F.col("right"), BOTH).otherwise(QUERY).alias("side")
    queries = placed.withColumnRenamed("slice", "left").join(pairs, ["block", "left"])
    data = placed.withColumnRenamed("slice", "right").join(pairs.filter("left < right"), ["block", "right"])
    columns = ["block", "left", "right", "s", "component", "raw"]
    return queries.select(*columns, side).unionByName(data.select(*columns, F.lit(DATA).alias("side")))


def links_in_blocks(sets: DataFrame, percent: int) -> DataFrame:
    """Edges whose components are those of all links; sets (stored): block, s, n, slices, raw.
    Rows with the id and the text of a chosen one repeat its set."""
    found = stage(searched(by_themselves(sets), percent), "links")
    large = sets.filter("slices > 1")
    before = large.count()
    if not before:
        return found
    while True:
        # blocks share no set, so an edge belongs to the block of either end
        inner = found.join(large.select(F.col("s").alias("a")), "a", "left_semi").select("a", "b")
        named = large.select("block", "s", "n").distinct().join(components(inner).withColumnRenamed("node", "s"), "s", "left")
        named = stage(named.withColumn("component", F.coalesce("component", "s")), "sets_of_components")
        # the set that names a component stands for it, as long as that leaves half as many
        heads = named.filter("s = component")
        now = heads.count()
        if 2 * now > before:
            break
        slices = heads.groupBy("block").agg(n_slices().alias("slices"), F.count("*").alias("heads")).filter("heads > 1").drop("heads")
        again = large.drop("slices").join(heads.select("s"), "s", "left_semi").join(slices, "block")
        found = stage(found.union(searched(by_themselves(again), percent)), "links")
        before = now
    return found.union(searched(across(large, named, percent), percent))


def links_between_sets(rows: DataFrame, found: DataFrame, words: int, percent: int, reach: int) -> DataFrame:
    """Edges (a, b) of set digests whose components are those of all links.

    rows: row, text; found: row, n, s (stored)."""
    first = rows.select("text").mapInArrow(first_shingles(words, percent, reach), "token long, s binary, n long")
    ordered = first.repartition("token").sortWithinPartitions("token", "s")
    listed = ordered.mapInArrow(shared_lists, "token long, s binary, n long, length long")
    n_low = _least(F.col("n"), percent)
    k_low = F.floor((n_low - _least(n_low, percent) + 1) * reach / 100)
    own = listed.groupBy("s", "n").agg(F.array_sort(F.collect_list(F.struct("length", "token"))).alias("lists"))
    own = own.withColumn("p", (F.col("n") - n_low + 1).cast("int"))
    # partners share more than k_low of the first shingles, or all they share are first ones
    active = own.filter(F.size("lists") >= F.least(k_low + 1, n_low))
    # shingles met nowhere else are the shortest lists, and give no candidates
    alone = F.least(F.col("n"), F.col("p") + F.floor(F.col("p") * reach / 100)) - F.size("lists")
    active = active.select(
        "s",
        "n",
        size_class(F.col("n"), percent).alias("size"),
        F.transform("lists", lambda x: x["token"]).alias("tokens"),
        F.greatest(F.lit(0), F.col("p") - alone).cast("int").alias("probes"),
    )
    active = stage(active, "active_sets")
    # First sets that probe the same long lists, then whole blocks of these with all that their
    # lists hold: members of one large group do not meet again in every list they share.
    near = stage(components(list_edges(active, held=False)), "probing_blocks").withColumnRenamed("node", "s")
    active = active.join(near, "s", "left").withColumn("part", F.coalesce("component", "s")).drop("component")
    active = stage(active, "active_parts")
    wide = components(list_edges(active.drop("s").withColumnRenamed("part", "s"), held=True)).withColumnRenamed("node", "part")
    in_block = active.select("s", "n", "part").join(wide, "part", "left").select("s", "n", F.coalesce("component", "part").alias("block"))
    in_block = stage(in_block, "blocks")
    members = in_block.groupBy("block").agg(n_slices().alias("slices"), F.count("*").alias("n_members"))
    members = members.filter("n_members > 1").drop("n_members")
    # one row stands for each set; its text gives the shingles again
    chosen = found.filter("s is not null").groupBy("s").agg(F.min("row").alias("chosen"))
    chosen = chosen.join(in_block, "s").join(members, "block")
    texts = chosen.join(rows, F.col("chosen") == F.col("row")).select("block", "s", "n", "slices", "text")
    sets = texts.mapInArrow(set_bytes(words), "block binary, s binary, n long, slices long, raw binary")
    return links_in_blocks(stage(sets, "block_sets"), percent)


def near_classes(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, reach: int) -> DataFrame:
    """id, h, row, n, s and keeper (the row key that names the component; NULL for empty sets)."""
    configure_batches(docs)
    id_, text = F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")
    base = docs.select(id_, text_hash(text_col).alias("h"), text)
    found = stage(base.mapInArrow(classes(words), "id long, h long, n long, s binary"), "shingle_sets")
    found = found.withColumn("row", row_key(F.col("id"), F.col("h")))
    rows = base.select(row_key(F.col("id"), F.col("h")).alias("row"), "text")
    parts = components(links_between_sets(rows, found, words, percent, reach))
    least = found.filter("s is not null").groupBy("s").agg(F.min("row").alias("least"))
    named = least.join(parts.withColumnRenamed("node", "s"), "s", "left").withColumn("component", F.coalesce("component", "s"))
    keepers = named.groupBy("component").agg(F.min("least").alias("keeper"))
    owner = named.select("s", "component").join(keepers, "component").select("s", "keeper")
    return found.join(owner, "s", "left")


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, reach: int = REACH
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Words are runs of bytes other than [\\x20\\x09-\\x0D], with A-Z lower-cased; a set holds the
    distinct shingles of `words` words, as 64-bit hashes. With fewer words the whole sequence
    is the one shingle; NULL and texts without words have the empty set and are linked with
    nothing. Two sets are linked when 100 * intersection >= percent * union. component_id is
    the smallest id reachable by links; NULL ids are passed over, unless a component has no
    other. Rows that repeat an id stand in the components of their own texts. An empty table
    gives no rows. Other columns are not read. Runs when it is called.
    """
    found = near_classes(docs, id_col, text_col, words, percent, reach)
    named = F.when(~F.col("keeper.no_id"), F.col("keeper.id"))
    component = F.when(F.col("s").isNull(), F.col("id")).otherwise(named)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, reach: int = REACH
) -> DataFrame:
    """All columns of one document of each component (the smallest id; a NULL id only if there
    is no other) and of every document with an empty set. Rows that repeat the id and the
    text of a document that stays all stay."""
    found = near_classes(docs, id_col, text_col, words, percent, reach)
    stays = found.filter(F.col("s").isNull() | (F.col("row") == F.col("keeper"))).select(F.col("row").alias("key")).distinct()
    rows = packed(docs, key=row_key(F.col(id_col).cast("long"), text_hash(text_col)))
    return rows.join(stays, "key", "left_semi").select("row.*")
