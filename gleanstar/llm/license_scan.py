"""License scan: normalised text against licence templates by Dice over word bigrams.

A text is normalised to words (runs of ASCII letters, digits and bytes beyond ASCII, A-Z
lower-cased) and cut into units at line ends and after sentence ends. A licence is a run of
whole units whose distinct word bigrams A and the template's B reach
2 |A and B| / (|A| + |B|) >= threshold t. Size bounds prune before any run is compared:

* a run can only match if t / (2 - t) * |B| <= |A| <= (2 - t) / t * |B|, and must share at least
  t / (2 - t) * |B| bigrams; so a text that has fewer of a template's bigrams in all drops it;
* a run begins and ends with a unit that has one of the template's bigrams, is not extended beyond the
  upper bound, and ends where the text has no bigram of the template that it lacks, or where
  all those of its first unit have come again.

Documents are read once, without a shuffle; templates are a fixed parameter.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.license_texts import TEMPLATES
from gleanstar.llm.rows import as_batch, blocks, configure_batches, mix, placed_words, splitmix, text_buffer, text_or_empty

THRESHOLD = 0.8

_WORD_BYTES = np.ones(256, bool)
for _first, _last in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _WORD_BYTES[_first : _last + 1] = False
_FACTORS = splitmix(2, 5)
_LF, _ENDS = 10, np.zeros(256, bool)
_ENDS[[33, 46, 59, 63]] = True  # ! . ; ?


def word_bigrams(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * _FACTORS[0] + hashes[1:] * _FACTORS[1])


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Positions after line ends, and after sentence ends that a blank follows."""
    ends = data == _LF
    ends[1:] |= (data[1:] == 32) & _ENDS[data[:-1]]
    return np.flatnonzero(ends) + 1


class Templates:
    def __init__(self, texts: dict[str, str], threshold: float):
        self.names, self.threshold = sorted(texts), threshold
        self.sets = []
        for name in self.names:
            data = np.frombuffer(texts[name].encode(), np.uint8)
            hashes, _, _ = placed_words(data, np.array([0, len(data)]), _WORD_BYTES)
            self.sets.append(np.unique(word_bigrams(hashes)))
        self.known = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.uint64)
        # which templates hold each known bigram
        self.member = np.array([np.isin(self.known, s) for s in self.sets], bool).reshape(len(self.sets), len(self.known))
        self.sizes = np.array([len(s) for s in self.sets])
        t = threshold
        self.least = np.maximum(1, np.ceil(self.sizes * (t / (2 - t)) - 1e-9))
        self.most = np.floor(self.sizes * ((2 - t) / t) + 1e-9)

    def best_run(self, j: int, grams: np.ndarray, known: np.ndarray, starts: np.ndarray):
        """(Dice, shared, size, first unit, last unit) of the best run of a text's units, or None.

        known: index of each bigram among the known, or -1; starts: first word of each unit,
        and the number of words at the end. Each unit is visited once at most for every bigram
        of the template, however often a text repeats a statement."""
        ours = np.zeros(len(grams), bool)
        found = known >= 0
        ours[found] = self.member[j, known[found]]
        places = np.flatnonzero(ours)
        # the template's bigrams by the unit of their first word, once each; a run holds a bigram
        # once it has the unit of its second word
        at_unit, with_unit = (np.searchsorted(starts, places + k, "right") - 1 for k in (0, 1))
        pairs, index = np.unique(np.stack([known[places], at_unit]), axis=1, return_index=True)
        same = np.append(pairs[0, 1:] == pairs[0, :-1], False)
        following = np.where(same, np.append(with_unit[index][1:], 0), len(starts))
        units, place = np.unique(pairs[1], return_inverse=True)
        # from this unit on all bigrams of a unit come again: a run that goes as far is no
        # better than the same run without its first unit
        useless = np.zeros(len(units), np.int64)
        np.maximum.at(useless, place, following)
        # different bigrams of the template from a unit on: once a run has them all, it only falls
        last = np.bincount(place[~same], minlength=len(units))
        ahead = np.cumsum(last[::-1])[::-1]
        best = None
        b, most, t = int(self.sizes[j]), int(self.most[j]), self.threshold
        for u, end, kinds in zip(units.tolist(), useless.tolist(), ahead.tolist(), strict=True):
            seen, shared, at = set(), set(), int(starts[u])
            for v in range(u, min(end, len(starts) - 1)):
                # bigrams of the run's words only
                to = max(at, int(starts[v + 1]) - 1)
                seen.update(grams[at:to].tolist())
                if ours[at:to].any():
                    shared.update(grams[at:to][ours[at:to]].tolist())
                at = to
                if len(seen) > most:
                    break
                dice = 2 * len(shared) / (len(seen) + b)
                if dice >= t and (best is None or dice > best[0]):
                    best = (dice, len(shared), len(seen), u, v)
                if len(shared) == kinds:
                    break
        return best


@lru_cache(maxsize=4)
def _templates(items: tuple, threshold: float) -> Templates:
    return Templates(dict(items), threshold)


_OUT = [("license", pa.string()), ("dice", pa.float64()), ("n_licenses", pa.int64()), ("licenses", pa.list_(pa.string())), ("n_words", pa.int64())]
_OUT += [("family", pa.string()), ("families", pa.list_(pa.string()))]


def family(template: str) -> str:
    """The licence a template stands for: its name without the wording."""
    return re.sub(r"-(statement(-\d+)?|notice)$", "", template)


def scan(items: tuple, threshold: float):
    schema = pa.schema([("id", pa.int64()), *_OUT])

    def run(batches):
        t = _templates(items, threshold)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            out = []
            for _, part, at in blocks(data, offsets):
                hashes, starts, _ = placed_words(part, at, _WORD_BYTES)
                first = np.searchsorted(starts, at)
                grams = word_bigrams(hashes) if len(hashes) > 1 else np.zeros(0, np.uint64)
                known = np.full(len(grams), -1, np.int64)
                if len(t.known) and len(grams):
                    place = np.minimum(np.searchsorted(t.known, grams), len(t.known) - 1)
                    hit = t.known[place] == grams
                    known[hit] = place[hit]
                hits = np.flatnonzero(known >= 0)
                cuts = None
                for k in range(len(at) - 1):
                    a, b = int(first[k]), int(first[k + 1])
                    rows = []
                    own = hits[np.searchsorted(hits, a) : np.searchsorted(hits, max(a, b - 1))]
                    if len(own):
                        kinds = np.unique(known[own])
                        for j in np.flatnonzero(t.member[:, kinds].sum(axis=1) >= t.least).tolist():
                            if cuts is None:
                                cuts = unit_starts(part)
                            inner = cuts[np.searchsorted(cuts, at[k], "right") : np.searchsorted(cuts, at[k + 1])]
                            edges = np.unique(np.searchsorted(starts[a:b], inner))
                            units = np.unique(np.concatenate([[0], edges, [b - a]]))
                            best = t.best_run(j, grams[a : b - 1], known[a : b - 1], units)
                            if best:
                                rows.append((-best[0], t.names[j]))
                    rows.sort()
                    names = [n for _, n in rows]
                    first_name = names[0] if names else None
                    row = (first_name, -rows[0][0] if rows else 0.0, len(names), sorted(names), b - a)
                    out.append((*row, family(first_name) if names else None, sorted({family(n) for n in names})))
            if out:
                yield as_batch(schema, batch.column(0), *zip(*out, strict=True))

    return run


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: id, license (the template of highest Dice, of equal ones the first by
    name; NULL if none), dice (0 if none), n_licenses, licenses (all that reach the threshold,
    sorted), n_words, family (the licence of the nearest template, whatever its wording) and
    families (the licences of all).

    NULL and empty texts, and texts of one word, have no licence. Ids may be NULL or repeat. An
    empty table gives no rows. Other columns are not read.
    """
    configure_batches(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    kinds = "id long, license string, dice double, n_licenses long, licenses array<string>, n_words long, family string, families array<string>"
    return rows.mapInArrow(scan(tuple(sorted(templates.items())), threshold), kinds).withColumnRenamed("id", id_col)
