"""Language identification by character language models.

One interpolated Kneser-Ney model of ORDER characters per language, learned from a bounded
sample of labelled documents (SAMPLE per language, the smallest by a hash of their id).
Counting is distributed; the counted n-grams, bounded by the sample, become sorted hash
arrays with a probability per language, which every task gets. A text's language is
the one with the lowest cross-entropy per character. A part of the sample is not learned
from: it calibrates the score (a softmax with the temperature of least log loss) and the
cross-entropy beyond which a language's texts are rejected.

Characters other than letters count as one blank; letters are lower-cased. A letter beyond
U+FFFF is two places of an n-gram, its UTF-16 surrogates, so any four places fit one 64-bit key
and no two letters share a code; its probability is the product of both, and it counts as one
character.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanstar.llm.encoder import groups_of
from gleanstar.llm.rows import as_batch, configure_batches, mix, packed, text_or_empty
from gleanstar.session import stage

ORDER = 4
# Labelled documents per language that models and calibration see.
SAMPLE = 1200
# Of these, every CALIBRATE-th calibrates.
CALIBRATE = 5
# Share of calibration texts whose cross-entropy is taken for usual, and nats added to it.
USUAL, SLACK = 0.995, 1.0
# A document is accepted at this score.
ACCEPT = 0.5
UNDETERMINED = "und"
# Longer texts are scored part by part.
PART = 1 << 20
_BITS = np.uint64(16)


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """Lower-cased code point of each letter, blank for all else; 0 begins a text."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(1, 0x110000):
        if not 0xD800 <= c < 0xE000 and (s := chr(c)).isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    out[0] = 0
    return out


def _codes(text: str) -> np.ndarray:
    """UTF-16 codes of a joined string in which NUL begins each text, runs of blanks as one."""
    c = letter_codes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    c = c[keep]
    far = c > 0xFFFF
    if far.any():
        beyond = c[far] - 0x10000
        first = np.flatnonzero(far) + np.arange(len(beyond))
        c = np.repeat(c, far + 1)
        c[first], c[first + 1] = 0xD800 + (beyond >> 10), 0xDC00 + (beyond & 0x3FF)
    return c.astype(np.uint16)


def keyed(codes: np.ndarray) -> np.ndarray:
    """The last ORDER codes up to each place, packed."""
    key = codes.astype(np.uint64)
    for j in range(1, ORDER):
        key[j:] |= codes[: len(codes) - j].astype(np.uint64) << (_BITS * np.uint64(j))
    return key


_START = "\0" * (ORDER - 1)


def text_parts(texts: list[str]):
    """(row, codes, places to score) of texts, long ones in parts that overlap."""
    for row, text in enumerate(texts):
        clean = text.replace("\0", " ")
        tail = np.zeros(ORDER - 1, np.uint16)
        for at in range(0, max(1, len(clean)), PART):
            c = _codes(clean[at : at + PART])
            if len(c) and c[0] == 32 and tail[-1] == 32:
                c = c[1:]
            whole = np.concatenate([tail, c])
            yield row, whole
            tail = whole[-(ORDER - 1) :]


def coded_groups(texts: list[str]):
    """(first row, number of texts, codes, row of each place): short texts together."""
    row = 0
    for group in groups_of(texts, PART):
        if len(group) == 1 and len(group[0]) > PART:
            for _, whole in text_parts(group):
                yield row, 1, whole, np.zeros(len(whole), np.int64), ORDER - 1
        else:
            joined = _START + _START.join(t.replace("\0", " ") for t in group)
            codes = _codes(joined)
            starts = np.zeros(len(codes), np.int64)
            first = codes == 0
            first[1:] &= codes[:-1] != 0
            # an empty text adds its zeros to those before it
            zeros = np.cumsum(codes == 0)
            of = (zeros - 1) // (ORDER - 1)
            starts[:] = of
            yield row, len(group), codes, starts, 0
        row += len(group)


def count_ngrams(batches):
    """(language, packed n-gram, occurrences) of a task's documents."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs.tolist()):
            own = [t for t, k in zip(texts, langs, strict=True) if k == lang]
            for _, _, codes, _, skip in coded_groups(own):
                key = keyed(codes)[skip:][codes[skip:] != 0]
                if len(key):
                    values, n = np.unique(key, return_counts=True)
                    yield as_batch(_COUNTS, [lang] * len(values), values.view(np.int64), n)


_COUNTS = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("n", pa.int64())])


def _mask(order: int) -> np.uint64:
    return np.uint64(2 ** (16 * order) - 1)


class HashArray:
    """Sorted hashes of keys, a directory by their first bits, and a row of values each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)
        bits = max(1, min(22, int(np.ceil(np.log2(len(keys) + 1))) + 2))
        self.shift = np.uint64(64 - bits)
        edges = np.arange(2**bits, dtype=np.uint64) << self.shift
        self.directory = np.searchsorted(self.hashes, edges).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        wanted = mix(keys)
        at = self.directory[(wanted >> self.shift).astype(np.int64)].astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        rows, last = np.arange(len(keys)), len(self.hashes) - 1
        while len(rows):
            here = self.hashes[np.minimum(at, last)]
            found = (here == wanted) & (at <= last)
            out[rows[found]] = at[found]
            on = (here < wanted) & (at < last)
            rows, wanted, at = rows[on], wanted[on], at[on] + 1
        return out


class Model:
    """Interpolated Kneser-Ney models of several languages over shared hash arrays."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """counts: packed n-grams of ORDER characters and their occurrences by language."""
        self.languages = sorted(counts)
        levels = {n: {} for n in range(1, ORDER + 1)}
        for lang in self.languages:
            keys, n = counts[lang]
            levels[ORDER][lang] = keys, n.astype(np.float64)
            for order in range(ORDER - 1, 0, -1):
                # how many different characters precede each shorter n-gram
                keys, n = np.unique(keys & _mask(order), return_counts=True)
                levels[order][lang] = keys, n.astype(np.float64)
        alphabet = np.unique(np.concatenate([levels[1][k][0] for k in self.languages]))
        self.floor = -np.log(len(alphabet) + 1.0)
        self.seen, self.back = {}, {}
        lower = None
        for order in range(1, ORDER + 1):
            every = np.unique(np.concatenate([levels[order][k][0] for k in self.languages]))
            contexts = np.unique(every >> _BITS)
            p = np.zeros((len(every), len(self.languages)))
            g = np.ones((len(contexts), len(self.languages)))
            for j, lang in enumerate(self.languages):
                keys, n = levels[order][lang]
                once, twice = (n == 1).sum(), (n == 2).sum()
                discount = once / (once + 2 * twice) if once else 0.5
                discount = min(max(discount, 0.1), 0.9)
                at = np.searchsorted(contexts, keys >> _BITS)
                total = np.bincount(at, n, minlength=len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                met = total > 0
                g[met, j] = discount * kinds[met] / total[met]
                of = np.searchsorted(contexts, every >> _BITS)
                below = np.exp(self.floor) if lower is None else lower[0][np.searchsorted(lower[1], every & _mask(order - 1)), j]
                p[:, j] = g[of, j] * below
                p[np.searchsorted(every, keys), j] += (n - discount) / total[at]
            lower = p, every
            self.seen[order] = HashArray(every, np.log(p))
            self.back[order] = HashArray(contexts, np.log(g))

    def log_p(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log probability of each last character, by language."""
        if order == 0:
            return np.full((len(keys), len(self.languages)), self.floor, np.float32)
        at = self.seen[order].find(keys)
        out = self.seen[order].values[np.maximum(at, 0)]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            rest = keys[miss]
            context = self.back[order].find(rest >> _BITS)
            weight = np.where(context[:, None] >= 0, self.back[order].values[np.maximum(context, 0)], 0)
            out[miss] = weight + self.log_p(rest & _mask(order - 1), order - 1)
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(nats per character by language, letters) of each text."""
        total = np.zeros((len(texts), len(self.languages)))
        chars, letters = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for first, n, codes, of, skip in coded_groups(texts):
            here = np.flatnonzero(codes != 0)
            here = here[here >= skip]
            if not len(here):
                continue
            rows = of[here]
            p = self.log_p(keyed(codes)[here])
            edges = np.flatnonzero(np.diff(rows, prepend=-1))
            total[first + rows[edges]] += np.add.reduceat(p, edges, axis=0, dtype=np.float64)
            # the second of two surrogates is no character of its own
            one = codes[here] & 0xFC00 != 0xDC00
            chars[first : first + n] += np.bincount(rows, one, minlength=n)
            letters[first : first + n] += np.bincount(rows, one & (codes[here] != 32), minlength=n).astype(np.int64)
        return -total / np.maximum(chars, 1)[:, None], letters

    def calibrate(self, entropies: np.ndarray, truth: np.ndarray) -> None:
        """Temperature and usual cross-entropies from texts that were not learned from."""
        self.temperature, self.limit = 10.0, np.full(len(self.languages), np.inf)
        if not len(truth):
            return
        best = np.inf
        for t in np.geomspace(0.5, 200, 40):
            z = -t * (entropies - entropies.min(axis=1, keepdims=True))
            loss = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(truth)), truth]))
            if loss < best - 1e-12:
                best, self.temperature = loss, float(t)
        for j in range(len(self.languages)):
            own = entropies[truth == j, j]
            if len(own):
                self.limit[j] = np.quantile(own, USUAL) + SLACK

    def predict(self, entropies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score in 0..1): the chance of the best language, less where its
        cross-entropy is beyond the usual."""
        best = entropies.argmin(axis=1)
        low = entropies[np.arange(len(best)), best]
        chance = 1 / np.exp(-self.temperature * (entropies - low[:, None])).sum(axis=1)
        beyond = np.maximum(0, low - self.limit[best])
        return best, chance * np.exp(-beyond)


def remainder(id_col: str, divisor: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(divisor))


def fit(docs: DataFrame, text_col: str, lang_col: str, order: Column, sample: int = SAMPLE) -> Model | None:
    """Learn from the labelled rows given; None if there are none. `order`, a struct that begins
    with a 64-bit hash h, ranks the rows of a language; the first `sample` are used.

    Only rows whose hash lies in the first part of its range that holds twice the sample, as
    counted, are ranked, so no task ranks the rows of a whole language."""
    configure_batches(docs)
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = labelled.select(F.col(lang_col).alias("lang"), order.alias("order"))
    part = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.count("*"))
    counts = rows.groupBy("lang").agg((part * 2.0**64 - 2.0**63).alias("below"))
    # one row per language, of which the models hold a column each
    rows = rows.join(F.broadcast(counts), "lang").filter(F.col("order.h").cast("double") <= F.col("below")).drop("below")
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("order"))).filter(F.col("r") <= sample)
    # at most `sample` rows a language
    chosen = F.broadcast(ranked.groupBy("lang", "order").agg(F.min("r").alias("r")))
    full = labelled.select(F.col(lang_col).alias("lang"), order.alias("order"), F.col(text_col).alias("text"))
    taken = stage(full.join(chosen, ["lang", "order"]).select("lang", "r", "text"), "labelled_sample")
    learn = taken.filter(F.col("r") % CALIBRATE != 0).select("lang", "text")
    counted = learn.mapInArrow(count_ngrams, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    # bounded by the characters of the sample
    table = counted.toArrow()
    if not table.num_rows:
        return None
    langs = np.array(table.column("lang").to_pylist(), object)
    keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    counts = {}
    for lang in dict.fromkeys(langs.tolist()):
        own = langs == lang
        order_ = np.argsort(keys[own])
        counts[lang] = keys[own][order_], n[own][order_]
    model = Model(counts)
    place = {lang: j for j, lang in enumerate(model.languages)}
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("lang", pa.int64()), ("h", pa.list_(pa.float64()))])

    def held(batches):
        for batch in batches:
            h, letters = sent.value.cross_entropies(batch.column(1).to_pylist())
            truth = [place.get(k, -1) for k in batch.column(0).to_pylist()]
            use = [i for i, (t, n) in enumerate(zip(truth, letters, strict=True)) if t >= 0 and n]
            yield as_batch(schema, [truth[i] for i in use], [h[i].tolist() for i in use])

    aside = taken.filter(F.col("r") % CALIBRATE == 0).select("lang", "text").mapInArrow(held, "lang long, h array<double>").collect()
    model.calibrate(np.array([r.h for r in aside]), np.array([r.lang for r in aside], np.int64))
    return model


def predict(rows: DataFrame, text_col: str, model: Model | None) -> DataFrame:
    """`rows` without the text, with lang_pred, cross_entropy, score and accepted."""
    configure_batches(rows)
    kept = [c for c in rows.columns if c != text_col]
    ordered = rows.select(*kept, text_or_empty(text_col).alias(text_col))
    added = [("lang_pred", pa.string()), ("cross_entropy", pa.float64()), ("score", pa.float64()), ("accepted", pa.bool_())]
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            n = len(texts)
            langs, entropy, score = [UNDETERMINED] * n, [None] * n, [0.0] * n
            if model is not None and n:
                h, letters = model.cross_entropies(texts)
                best, chance = model.predict(h)
                for i in np.flatnonzero(letters > 0).tolist():
                    langs[i], entropy[i], score[i] = model.languages[best[i]], float(h[i, best[i]]), float(chance[i])
            schema = pa.schema([*list(batch.schema)[: len(kept)], *added])
            yield as_batch(schema, *batch.columns[: len(kept)], langs, entropy, score, [s >= ACCEPT for s in score])

    kinds = rows.select(*kept).schema
    for name, kind in (("lang_pred", "string"), ("cross_entropy", "double"), ("score", "double"), ("accepted", "boolean")):
        kinds = kinds.add(name, kind)
    return ordered.mapInArrow(run, kinds)


def learned(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held: int, sample: int) -> Model | None:
    """Models from the rows whose fold (crc32 of the id as text, modulo `folds`) is not `held`."""
    train = docs.filter(~F.coalesce(remainder(id_col, folds) == held, F.lit(False)))
    order = F.struct(F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).alias("id"))
    return fit(train, text_col, lang_col, order, sample)


def language_id(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 3,
    held: int = 1,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, cross_entropy, score, accepted.

    Learned from text and non-NULL language of rows that are not held out; predictions use
    the text only. lang_pred is `und`, with score 0, for NULL texts, texts without a letter,
    and if nothing was learned. Rows with a NULL id are not held out. Rows may repeat. An
    empty table gives no rows. Other columns are not read. Learning runs when it is called.
    """
    model = learned(docs, id_col, text_col, lang_col, folds, held, sample)
    out = F.coalesce(remainder(id_col, folds) == held, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), out.alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, "text", model).withColumnRenamed("id", id_col)


def keep_accepted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held: int = 1, sample: int = SAMPLE
) -> DataFrame:
    """All columns of the rows whose language is accepted."""
    model = learned(docs, id_col, text_col, lang_col, folds, held, sample)
    return predict(packed(docs, text=F.col(text_col)), "text", model).filter("accepted").select("row.*")
