"""Token ids of whole texts by a public `tokenizers` vocabulary.

A text is cut at blanks and line feeds. No token, normalisation or special token of the
vocabularies used here reaches over white space, so the ids of the pieces, one after
another, are the ids of the text; `tests/llm` compares them with the library's own. Each
worker keeps a table of words it has met, bounded by bytes, so a frequent word is encoded
once; whole columns are cut and numbered in Arrow, and their ids gathered in NumPy.
"""

from __future__ import annotations

import os
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of each of the two generations of words and pieces a worker keeps.
TABLE_BYTES = 64 * 1024 * 1024
# What an entry takes besides its characters and ids.
_ENTRY = 170
# Bytes of text whose pieces are numbered together.
GROUP = 5 << 20
# Strings passed to the library at once: its results take some hundred bytes a token.
_CALL = 512
# Trailing marks that stay one token run of their own; the apostrophe starts contractions.
_MARKS = string.punctuation.replace("'", "")
_WORD_END = "</w>"


class Generations:
    """A table of encoded strings in two generations: when the newer one is full it becomes
    the older one, whose entries move up again when they are used and else are forgotten."""

    def __init__(self, limit: int):
        self._new, self._old, self._size, self._limit = {}, {}, 0, limit

    def get_all(self, keys: list[str]) -> tuple[list, list[int]]:
        """The ids of each key, and the places of keys that have none."""
        out = list(map(self._new.get, keys))
        if self._old:
            moved = [k for k, ids in enumerate(out) if ids is None]
            for k in moved:
                out[k] = self._old.get(keys[k])
            moved = [k for k in moved if out[k] is not None]
            self.put_all([keys[k] for k in moved], [out[k] for k in moved])
        return out, [k for k, ids in enumerate(out) if ids is None]

    def put_all(self, keys: list[str], ids: list[bytes]) -> None:
        if self._size > self._limit:
            self._new, self._old, self._size = {}, self._new, 0
        self._new.update(zip(keys, ids, strict=True))
        self._size += _ENTRY * len(keys) + sum(map(len, keys)) + sum(map(len, ids))

    def fill(self, keys: list[str], encode) -> dict[str, bytes]:
        """The ids of distinct keys, those not known encoded and kept."""
        out, missing = self.get_all(keys)
        new = [keys[k] for k in missing]
        encoded = encode(new)
        self.put_all(new, encoded)
        for k, ids in zip(missing, encoded, strict=True):
            out[k] = ids
        return dict(zip(keys, out, strict=True))


class Encoder:
    def __init__(self, path: str, table_bytes: int = TABLE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        n = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self._tokenizer.id_to_token(i) or "" for i in range(n)]
        self._ends = np.array([t.endswith(_WORD_END) for t in self.tokens])
        # plain words need none of the vocabulary's rules but the split into bytes
        self._plain = Tokenizer.from_file(path)
        self._plain.no_truncation()
        self._plain.no_padding()
        self._plain.normalizer = normalizers.Sequence([])
        split_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False, trim_offsets=False)
        self._plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), split_bytes])
        # plain lower-case words and marks; all other pieces
        self._words, self._others = Generations(table_bytes * 7 // 8), Generations(table_bytes // 8)

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), _CALL):
            encoded = self._tokenizer.encode_batch_fast(texts[at : at + _CALL], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in encoded]
        return out

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Lower-case words of letters below U+0180, many to a call: each ends at its first
        token with an end mark."""
        out = []
        for at in range(0, len(words), _CALL):
            part = words[at : at + _CALL]
            ids = self._plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            ids = np.array(ids, "<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(part):
                out += self._ids(part)
                continue
            raw, cuts = ids.tobytes(), [0, *(ends * 4).tolist()]
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, a text without blanks and line feeds.

        A piece of a plain word and trailing marks is the word's ids and the marks'. A word is
        plain if its lower case has only letters below U+0180: that of U+0130 ends in a
        combining mark, which the vocabulary's rules join with a mark after it.
        """
        heads = [p.rstrip(_MARKS) for p in pieces]
        lowers = [h.lower() for h in heads]
        out, missing = self._words.get_all(lowers)
        new = dict.fromkeys(lowers[k] for k in missing)
        plain = [w for w in new if w.isalpha() and (w.isascii() or max(w) < "ƀ")]
        encoded = self._word_ids(plain)
        self._words.put_all(plain, encoded)
        new.update(zip(plain, encoded, strict=True))
        if "" in new:
            new[""] = b""
        for k in missing:
            out[k] = new[lowers[k]]
        odd = [k for k, ids in enumerate(out) if ids is None]
        tailed = [k for k, (p, h) in enumerate(zip(pieces, heads, strict=True)) if len(p) != len(h) and out[k] is not None]
        tails = [pieces[k][len(heads[k]) :] for k in tailed]
        marks = self._words.fill(list(dict.fromkeys(tails)), self._ids)
        for k, t in zip(tailed, tails, strict=True):
            out[k] += marks[t]
        others = self._others.fill([pieces[k] for k in odd], self._ids)
        for k in odd:
            out[k] = others[pieces[k]]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column of texts (NULL: empty), one text after another, and where each
        text's begin (and the last one's end)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        parts = self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        ids = np.frombuffer(b"".join(parts), "<u4")
        places = coded.indices.to_numpy()
        n = lengths[places]
        ends = np.cumsum(n)
        first = (np.cumsum(lengths) - lengths)[places] - (ends - n)
        at = lists.offsets.to_numpy()
        offsets = np.concatenate([[0], ends])[at - at[0]]
        take = np.repeat(first, n)
        take += np.arange(len(take))
        return ids[take], offsets

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each of a few short texts as little-endian unsigned 32-bit integers."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        pieces = list(dict.fromkeys(p for s in split for p in s))
        ids = dict(zip(pieces, self.ids_of(pieces), strict=True))
        return [b"".join(map(ids.__getitem__, s)) for s in split]

    def decode(self, ids: np.ndarray) -> str:
        """As the library does without a decoder: tokens joined by blanks."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def text_groups(texts: pa.Array, size: int = GROUP):
    """(first row, slice) of consecutive rows with about `size` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield at, texts.slice(at, to - at)
        at = to


def groups_of(texts: list[str], size: int = 1 << 20):
    """Consecutive texts with about `size` characters in all."""
    group, n = [], 0
    for t in texts:
        group.append(t)
        n += len(t)
        if n >= size:
            yield group
            group, n = [], 0
    if group:
        yield group
