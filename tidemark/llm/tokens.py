"""Token ids of whole texts from a vocabulary file, each distinct word encoded once per worker.

The vocabulary's pre-tokenizer never joins what white space parts, so a text's ids are the ids of its words in
a row. Words of printable ASCII and the letters from U+00C0 to U+00FF, all new ones of a block together, go through the file's
split pattern (narrowed to these) straight to its merge model; all others go through the library's whole chain.
"""

from __future__ import annotations

import re
from array import array
from itertools import repeat

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import spans

#: The vocabulary's split pattern for lower-case printable ASCII and letters up to U+00FF; "\n" ends a word.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ß-öø-ÿ\n]+")
LETTERS = 0xC3  # first UTF-8 byte of U+00C0 to U+00FF
SIGNS = (0x97, 0xB7)  # second byte of the two that are no letters
CACHE_WORDS = 600_000
CACHE_PARTS = 300_000


def _byte_characters() -> dict[int, str]:
    """The byte-level character of every byte that is not its own."""
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()


def plain_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words hold nothing but printable ASCII and letters from U+00C0 to U+00FF, and no start of a special token."""
    follows = np.append(False, data[:-1] == LETTERS)
    low = (data >= 0x80) & (data < 0xC0)
    strange = (data < 33) | (data == 127) | ((data >= 0x80) & (data != LETTERS) & ~(low & follows)) | (follows & ~low)
    strange |= follows & np.isin(data, SIGNS)
    strange[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    counts = np.concatenate([[0], np.cumsum(strange)])
    return (counts[starts] == counts[ends]) & (data[ends - 1] != LETTERS)


class WordEncoder:
    """Ids of blocks of documents; ``end_id`` closes every document."""

    def __init__(self, vocabulary: str, end_id: int):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.end_id = end_id
        self.parts: dict[str, bytes] = {}
        # Word 0 is the end of a document; ``blocks`` counts the blocks that had a word.
        self.places: dict[int, int] = {}
        self.keys, self.blocks, self.starts, self.lengths = (np.zeros(1 << 16, kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
        self.ids = np.zeros(1 << 18, np.uint32)
        self.ids[0], self.lengths[0], self.used, self.words = self.end_id, 1, 1, 1

    def _evict(self) -> None:
        """Keep the half of the words that most blocks had, and count anew."""
        kept = 1 + np.sort(np.argsort(-self.blocks[1 : self.words], kind="stable")[: CACHE_WORDS // 2])
        kept = np.concatenate([[0], kept])
        lengths = self.lengths[kept]
        stops = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.starts[kept] - (stops - lengths), lengths) + np.arange(stops[-1])]
        count, self.used = len(kept), len(ids)
        self.words = count
        self.ids[: self.used] = ids
        self.starts[:count], self.lengths[:count], self.keys[:count], self.blocks[:count] = stops - lengths, lengths, self.keys[kept], 0
        self.places = dict(zip(self.keys[1:count].tolist(), range(1, count), strict=True))

    def _plain(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain words in a row, and how many each has."""
        sizes = ends - starts + 1
        stops = np.cumsum(sizes)
        joined = data[np.minimum(np.repeat(starts - (stops - sizes), sizes) + np.arange(stops[-1]), len(data) - 1)]
        joined[stops - 1] = ord("\n")
        parts = PARTS.findall(joined.tobytes().decode().lower())
        new = set(parts).difference(self.parts)
        if len(self.parts) + len(new) > CACHE_PARTS:
            self.parts.clear()
            new = set(parts)
        new.discard("\n")
        tokenize = self.tokenizer.model.tokenize
        for part in new:
            text = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_CHARACTERS)
            self.parts[part] = array("I", [token.id for token in tokenize(text)]).tobytes()
        # No part is without ids, so those of length 0 are the ends of words.
        self.parts["\n"] = b""
        found = list(map(self.parts.__getitem__, parts))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        closing = np.cumsum(lengths)[lengths == 0] // 4
        return np.frombuffer(b"".join(found), np.uint32), np.diff(closing, prepend=0)

    def _others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any words."""
        found = [encoding.ids for encoding in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((id_ for ids in found for id_ in ids), np.uint32, int(lengths.sum())), lengths

    def _add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The places of words that are new."""
        while self.words + len(keys) > len(self.starts):
            arrays = (self.keys, self.blocks, self.starts, self.lengths)
            self.keys, self.blocks, self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in arrays)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        first, last = self.words, self.words + len(keys)
        self.starts[first:last] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:last] = lengths
        self.keys[first:last] = keys
        self.blocks[first:last] = 0
        self.ids[self.used : self.used + len(ids)] = ids
        self.places.update(zip(keys.tolist(), range(first, last), strict=True))
        self.used, self.words = self.used + len(ids), last
        return np.arange(first, last)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block and where each document's begin, with the end of the last."""
        starts, ends = spans.words(data, offsets)
        hashes = spans.span_hashes(spans.prefix_sums(spans.byte_values()[data]), starts, ends)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if self.words + len(keys) > CACHE_WORDS:
            self._evict()
        places = np.fromiter(map(self.places.get, keys.tolist(), repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            begin, end = starts[first[missing]], ends[first[missing]]
            plain = plain_words(data, begin, end)
            if plain.any():
                chosen = missing[plain]
                places[chosen] = self._add(keys[chosen], *self._plain(data, begin[plain], end[plain]))
            if not plain.all():
                chosen = missing[~plain]
                words = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begin[~plain], end[~plain], strict=True)]
                places[chosen] = self._add(keys[chosen], *self._others(words))
        self.blocks[places] += 1
        ends_of_docs = np.searchsorted(starts, offsets[1:])
        words = np.insert(places[inverse.ravel()] if len(keys) else places, ends_of_docs, 0)
        lengths = self.lengths[words]
        stops = np.cumsum(lengths)
        source = np.repeat(self.starts[words] - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)
        closing = ends_of_docs + np.arange(len(ends_of_docs))
        return self.ids[source], np.concatenate([[0], stops[closing]])
