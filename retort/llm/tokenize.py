"""Token ids of a public tokenizer file, with a cache of words for the common scripts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from retort.llm.common import text_slices, word_hashes

# The classes of the tokenizer file's own word pattern, over Latin-1. White space is class 0.
LETTER, NUMBER, OTHER = 1, 2, 3
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = LETTER
_CLASS[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = NUMBER
_CLASS[[*range(0x09, 0x0E), 0x20, 0xA0]] = 0
_LOWER = np.array([b + 32 if 65 <= b <= 90 or 192 <= b <= 222 and b != 215 else b for b in range(256)], np.uint8)
#: Characters that libraries class differently, and what begins a special token; texts with them take the library's path.
_ODD = bytes([*range(0x1C, 0x20), 0x85])
_SPECIAL = b"<|"
_WORD_END = "</w>"
_APOSTROPHE = 0x27
_SHORT, _LONG = b"stmd", (b"re", b"ve", b"ll")

_of_process: dict[str, WordTokenizer] = {}


def of_process(path: str) -> WordTokenizer:
    """One tokenizer for each worker process: later tasks find its words cached."""
    if path not in _of_process:
        _of_process[path] = WordTokenizer(path)
    return _of_process[path]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pattern's words in lower-cased Latin-1: runs of letters or of other signs, single numbers,
    and an apostrophe of its own with the letters of a contraction after it."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _CLASS[data]
    edge = np.empty(len(data), dtype=bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge |= kind == NUMBER
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(edge)
    ends = np.append(at[1:], len(data))
    keep = kind[at] > 0
    starts, ends = at[keep], ends[keep]
    alone = np.flatnonzero((data[starts] == _APOSTROPHE) & (ends - starts == 1))
    alone = alone[alone + 1 < len(starts)]
    alone = alone[(starts[alone + 1] == ends[alone]) & (kind[np.minimum(ends[alone], len(data) - 1)] == LETTER)]
    inside = ~np.isin(ends[alone], offsets)
    alone = alone[inside]
    if len(alone):
        first = data[ends[alone]]
        second = data[np.minimum(ends[alone] + 1, len(data) - 1)]
        pair = ends[alone + 1] - starts[alone + 1] >= 2
        take = np.zeros(len(alone), np.int64)
        take[pair & np.logical_or.reduce([(first == a) & (second == b) for a, b in _LONG])] = 2
        take[np.isin(first, list(_SHORT))] = 1
        ends[alone] += take
        starts[alone + 1] += take
        full = starts < ends
        starts, ends = starts[full], ends[full]
    return starts, ends


class Words:
    """Ids by word hash, in a few sorted runs that are merged as they grow."""

    def __init__(self, limit: int):
        self.limit = limit
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # hashes, starts, lengths, ids

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, lengths, ids) of ascending hashes; a length of 0 marks an unknown word."""
        starts, lengths, base, flat = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64), 0, []
        for known, s, n, ids in self.runs:
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            starts[hit], lengths[hit] = s[at[hit]] + base, n[at[hit]]
            base += len(ids)
            flat.append(ids)
        return starts, lengths, np.concatenate(flat) if flat else np.zeros(0, np.uint32)

    def add(self, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Ascending hashes that no run has. Beyond the limit the runs are forgotten."""
        if sum(len(r[0]) for r in self.runs) > self.limit:
            self.runs = []
        self.runs.append((hashes, starts, lengths, ids))
        while len(self.runs) > 1 and len(self.runs[-1][0]) * 2 > len(self.runs[-2][0]):
            (h2, s2, n2, i2), (h1, s1, n1, i1) = self.runs.pop(), self.runs.pop()
            h, s, n = np.concatenate([h1, h2]), np.concatenate([s1, s2 + len(i1)]), np.concatenate([n1, n2])
            order = np.argsort(h, kind="stable")
            self.runs.append((h[order], s[order], n[order], np.concatenate([i1, i2])))


class WordTokenizer:
    """ids of texts, exactly as the tokenizer file gives them without special tokens.

    The file's pre-tokenizer splits a text into words that are encoded on their own, so each different word is encoded
    once and looked up by a 64-bit hash. Texts outside Latin-1, or with characters that could be special tokens, are
    encoded whole by the library.
    """

    def __init__(self, path: str, cache_words: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True
        self.words = Words(cache_words)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_words(self, words: list[bytes], together: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids of each): many words make one text, whose ids are cut after each word's last token."""
        flat, lengths = [], []
        for at in range(0, len(words), together):
            part = [w.decode("latin-1") for w in words[at : at + together]]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, dtype=np.uint32)
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                found = self._library(part)
                ids, cuts = np.concatenate(found), np.cumsum([len(x) for x in found])
            flat.append(ids)
            lengths.append(np.diff(cuts, prepend=0))
        return np.concatenate(flat), np.concatenate(lengths)

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        data = _LOWER[data]
        starts, ends = word_spans(data, offsets)
        hashes, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at, lengths, ids = self.words.find(hashes)
        if len(new := np.flatnonzero(lengths == 0)):
            raw = data.tobytes()
            fresh, n = self._new_words([raw[starts[i] : ends[i]] for i in first[new].tolist()])
            at[new], lengths[new] = len(ids) + np.cumsum(n) - n, n
            self.words.add(hashes[new], np.cumsum(n) - n, n, fresh)
            ids = np.concatenate([ids, fresh])
        n = lengths[which]
        total = np.cumsum(n)
        flat = ids[np.repeat(at[which] - (total - n), n) + np.arange(int(total[-1]) if len(total) else 0)]
        total = np.concatenate([[0], total])
        bounds = total[np.searchsorted(starts, offsets)].tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """uint32 ids of each text; null counts as empty."""
        out: list[np.ndarray] = []
        for _, _, data, offsets in text_slices(column):
            try:
                raw = data.tobytes().decode().encode("latin-1")
                plain = _SPECIAL not in raw and len(raw.translate(None, _ODD)) == len(raw)
            except UnicodeEncodeError:
                plain = False
            if plain:
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                out += self._plain(np.frombuffer(raw, np.uint8), chars[offsets])
            elif len(offsets) == 2:
                out += self._library([data.tobytes().decode()])
            else:
                for a, b in zip(offsets, offsets[1:], strict=False):
                    out += self.encode(pa.array([data[a:b].tobytes().decode()], pa.large_string()))
        return out
