"""Benchmark decontamination: a prefix-filtered set join in DataFrame operations.

A window is `size` consecutive words of a benchmark item (a shorter item is one window).
It occurs in a document if and only if all its shingles of up to SHINGLE words do, at
consecutive positions. So each window needs only one shingle to be met, its rarest in
the documents (for whole containment the necessary prefix is one token).

1. Rarity: the documents' shingles are hashed and those of items counted; the counts are
   added up in the tasks, so the shuffle has a row per item shingle and task.
2. Prefix: each window keeps its rarest shingle; one with a shingle that no document holds
   occurs nowhere.
3. Join: document positions meet these prefixes only. The bounds of the position then fix
   where the window would begin and end within the text.
4. Verification: the words of that part of the document are compared with the window's. Texts
   are read in spans of SPAN words with a window's length before and after, so the words
   are at hand where a prefix is met and no text is shuffled.

The prefixes are broadcast while their number, which is counted, is within BROADCAST_ROWS. Beyond,
positions and prefixes are shuffled by the shingle (AQE splits frequent ones) without the
words around them, and candidates go back to the texts of their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.rows import packed, text_hash
from gleanstar.session import stage

WINDOW = 10
SHINGLE = 3
SPAN = 64
# Prefixes (some 200 bytes each) that are sent to all executors.
BROADCAST_ROWS = 200_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything in ASCII but digits and lower-case letters ends a word.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; NULL has none."""
    ascii_only = F.length(text) == F.octet_length(text)
    # lower() also changes letters beyond A-Z, but not in texts of ASCII only
    folded = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), _GAP), "")


def shingle_hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct windows: window (key), words, length, and the items that hold them."""
    own = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - F.lit(size - 1)))
    each = own.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, F.lit(size)))).alias("words"))
    return each.select("item", F.array_join("words", " ").alias("window"), "words", F.size("words").alias("length")).distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """Shingles of each distinct window: window, length, at (0 for the first), k, a, b, c."""
    once = windows.select("window", "words", "length").distinct()
    k = F.least(F.col("length"), F.lit(SHINGLE))
    placed = once.select("window", "words", "length", k.alias("k"), F.explode(F.sequence(F.lit(0), F.col("length") - k)).alias("at"))

    def word(j: int) -> Column:
        return F.when(F.col("k") > j, F.get("words", F.col("at") + j)).otherwise(F.lit("")).alias("abc"[j])

    return placed.select("window", "length", "at", "k", *[word(j) for j in range(SHINGLE)])


def shingle_positions(docs: DataFrame, sizes: list[int], size: int) -> DataFrame:
    """Shingles of the documents: id, h, pos, near (the words around it, at least `size` before
    and after, if the text has them), i (its position in these), s, a, b, c.

    docs: id, h, text; sizes: the lengths of shingles that items have."""
    w, near, lead = F.col("w"), F.col("span.near"), F.col("span.lead")
    split = docs.select("id", "h", words(F.col("text")).alias("w")).filter(F.size("w") > 0)

    def span(b: Column) -> Column:
        before = F.least(b, F.lit(size))
        return F.struct((b - before).alias("base"), before.alias("lead"), F.slice(w, b - before + 1, before + SPAN + size).alias("near"))

    spans = split.select("id", "h", F.explode(F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(SPAN)), span)).alias("span"))
    parts = [F.slice(near, lead + j + 1, F.lit(SPAN)).alias("abc"[j]) for j in range(max(sizes))]
    rows = spans.select("id", "h", "span", F.posexplode(F.arrays_zip(*parts)).alias("p", "x"))
    rows = rows.select("id", "h", (F.col("span.base") + lead + F.col("p")).alias("pos"), near.alias("near"), (lead + F.col("p")).alias("i"), "x")

    def shingle(k: int) -> Column:
        # the blank parts of shorter shingles keep the hashes of all lengths apart
        abc = [F.col(f"x.{'abc'[j]}") if j < k else F.lit("") for j in range(SHINGLE)]
        fields = F.struct(shingle_hash(*abc).alias("s"), *[c.alias("abc"[j]) for j, c in enumerate(abc)])
        return F.when(F.col(f"x.{'abc'[k - 1]}").isNotNull(), fields)

    one = shingle(sizes[0]) if len(sizes) == 1 else F.explode(F.array(*[shingle(k) for k in sizes]))
    return rows.select("id", "h", "pos", "near", "i", one.alias("y")).filter("y is not null").select("id", "h", "pos", "near", "i", "y.*")


def window_prefixes(docs: DataFrame, shingles: DataFrame, sizes: list[int], size: int) -> DataFrame:
    """The rarest shingle of each window all of whose shingles occur in the documents: window,
    length, at, k, s, a, b, c. shingles (stored): as of `window_shingles`, with their hash s."""
    asked = stage(shingles.select("s").distinct(), "item_shingles")
    rarity = shingle_positions(docs, sizes, size).select("s").join(asked, "s", "left_semi").groupBy("s").agg(F.count("*").alias("n"))
    rarity = stage(rarity, "shingle_rarity")
    ranked = shingles.join(rarity, "s", "left")
    ranked = ranked.select("window", "length", "k", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "s", "a", "b", "c").alias("r"))
    first = ranked.groupBy("window", "length", "k").agg(F.min("r").alias("r")).filter("r.n > 0")
    return first.select("window", "length", "k", "r.at", "r.s", "r.a", "r.b", "r.c")


def find_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Occurrences of windows: id, h, start (position of the first word), length, window.

    docs: id, h, text. Rows that repeat an id and a text repeat their occurrences. Runs when
    it is called."""
    shingles = window_shingles(windows).withColumn("s", shingle_hash(F.col("a"), F.col("b"), F.col("c")))
    shingles = stage(shingles, "window_shingles")
    # at most SHINGLE rows
    lengths = {r["k"]: r["size"] for r in shingles.groupBy("k").agg(F.max("length").alias("size")).collect()}
    if not lengths:
        return docs.sparkSession.createDataFrame([], "id long, h long, start int, length int, window string")
    sizes, size = sorted(lengths), max(lengths.values())
    prefixes = stage(window_prefixes(docs, shingles, sizes, size), "window_prefixes").withColumnsRenamed({c: f"_{c}" for c in "sabc"})
    same = (F.col("s") == F.col("_s")) & (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")) & (F.col("c") == F.col("_c"))
    rows = shingle_positions(docs, sizes, size)
    # bound of the position: the window begins within the text
    begins = F.col("pos") >= F.col("at")
    start = (F.col("pos") - F.col("at")).alias("start")
    if prefixes.count() <= BROADCAST_ROWS:
        # the words end with the text, so a window that goes on beyond it differs
        there = F.array_join(F.slice("near", F.greatest(F.col("i") - F.col("at"), F.lit(0)) + 1, F.col("length")), " ")
        met = rows.join(F.broadcast(prefixes), same).filter(begins & (there == F.col("window")))
        return met.select("id", "h", start, "length", "window")
    met = stage(rows.drop("near", "i").join(prefixes, same).filter(begins).select("id", "h", start, "length", "k", "window"), "candidates")
    # a window of one shingle is compared already
    whole = met.filter("length = k").select("id", "h", "start", "length", "window")
    open_ = met.filter("length > k").groupBy(F.col("id").alias("i"), F.col("h").alias("t"))
    open_ = stage(open_.agg(F.collect_set(F.struct("start", "length", "window")).alias("open")), "open_candidates")
    texts = docs.join(open_, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("t")))
    texts = texts.select("id", "h", words(F.col("text")).alias("w"), "open")
    held = F.filter("open", lambda x: F.array_join(F.slice("w", x["start"] + 1, x["length"]), " ") == x["window"])
    return whole.union(texts.select("id", "h", F.inline(held)))


def contaminated_texts(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, size: int
) -> DataFrame:
    """id, h (hash of the text), n_hit, n_items, items of the documents with occurrences."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("text"))
    windows = stage(item_windows(items, item_col, item_text, size), "item_windows")
    found = stage(find_windows(rows, windows), "window_occurrences")
    hit = found.select("id", "h", F.explode(F.expr("sequence(start, start + length - 1)")).alias("pos")).distinct()
    hit = hit.groupBy("id", "h").agg(F.count("*").alias("n_hit"))
    held = found.select("id", "h", "window").join(windows.select("window", "item"), "window").select("id", "h", "item").distinct()
    held = held.groupBy("id", "h").agg(F.count("item").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    held = held.withColumnsRenamed({"id": "i", "h": "t"})
    return hit.join(held, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("t"))).select("id", "h", "n_hit", "n_items", "items")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """One row per input row: id, n_words, n_hit (words inside an occurrence of a window),
    n_items (items with occurring windows), items (their ids as sorted strings), contaminated.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. NULL
    has no words; items that are NULL or without words have no windows; items with a NULL id
    mark words but are not listed. Documents are told apart by id and text, so equal rows
    have equal results. Empty tables give no rows or no hits. Other columns are not
    read. Runs when it is called.
    """
    found = contaminated_texts(docs, items, id_col, text_col, item_col, item_text, size).withColumnsRenamed({"id": "i", "h": "t"})
    n_words = F.size(words(F.col(text_col)))
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), n_words.alias("n_words"))
    joined = rows.join(found, F.col("id").cast("long").eqNullSafe(F.col("i")) & (F.col("h") == F.col("t")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """All columns of the documents in which no window occurs."""
    found = contaminated_texts(docs, items, id_col, text_col, item_col, item_text, size).select(F.col("id").alias("i"), F.col("h").alias("t"))
    rows = packed(docs, id=F.col(id_col).cast("long"), h=text_hash(text_col))
    return rows.join(found, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("t")), "left_anti").select("row.*")
