"""Tokenizer ids of whole Arrow columns, each distinct chunk of text encoded once per process.

The tokenizers used here never merge across certain places, so a text may be
cut there and its ids are those of its chunks, one after another:

* before a space (0x20) that follows a byte which certainly is no white space;
* after a letter (ASCII, or U+00C0 to U+00FF), before an ASCII character that is none;
* between a single line feed that follows a printable ASCII character, and an ASCII letter.

Most chunks are words that were seen before: the library encodes new ones
only, and the rest is gathered with numpy. Chunks are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

from . import words
from .store import spread

#: 1: printable ASCII but the space, 2: ASCII letter.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = 1
_KIND[[*range(65, 91), *range(97, 123)]] = 3
#: A process forgets its chunks when they take more bytes than this; one slice of texts may come on top.
MOST_BYTES = 32 << 20


def cut(data: np.ndarray, starts: np.ndarray, whole: tuple[bytes, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the chunks, and the number of the text that each belongs to.

    The strings ``whole`` (added tokens) are never cut inside.
    """
    n = len(data)
    marks = np.zeros(n, dtype=bool)
    if n > 2:
        kind = _KIND[data]
        solid, letter = (kind & 1).astype(bool), (kind & 2).astype(bool)
        trail = (data >= 0x80) & (data < 0xC0)
        # the second byte of U+00C0 to U+07FF (no white space), and of the letters up to U+00FF
        two = np.zeros(n, dtype=bool)
        two[1:] = trail[1:] & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
        accented = np.zeros(n, dtype=bool)
        accented[1:] = trail[1:] & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        marks[1:] = (data[1:] == 0x20) & (solid | two)[:-1]
        marks[1:] |= (letter | accented)[:-1] & (data[1:] < 0x80) & ~letter[1:]
        marks[2:] |= letter[2:] & (data[1:-1] == 0x0A) & solid[:-2]
    for token in whole:
        raw, at = data.tobytes(), -1
        while (at := raw.find(token, at + 1)) >= 0:
            marks[at + 1 : at + len(token)] = False
    # texts touch each other: their borders are cut, and nothing else depends on a neighbour
    filled = starts[:-1][starts[1:] > starts[:-1]]
    marks[filled] = True
    begin = np.flatnonzero(marks)
    end = np.append(begin[1:], n) if len(begin) else begin
    text = np.searchsorted(starts, begin, side="right") - 1
    return begin, end, text


#: Byte-level vocabularies write printable bytes as themselves and the others as U+0100 and up, in order.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class ChunkEncoder:
    """Ids of texts through ``encode_chunks``, which gets a list of (string, opens a text) pairs.

    What was learned lies in arrays sorted by the chunks' hashes: some 30 bytes a chunk. Beyond ``MOST_BYTES`` all is forgotten.
    """

    def __init__(self, encode_chunks, first_differs: bool, whole: tuple[bytes, ...] = ()):
        self.encode_chunks, self.first_differs, self.whole = encode_chunks, first_differs, whole
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.start = np.zeros(0, dtype=np.uint32)
        self.count = np.zeros(0, dtype=np.uint32)
        self.ids = np.zeros(0, dtype=np.uint32)

    def held(self) -> int:
        """Bytes of what was learned."""
        return self.keys.nbytes + self.start.nbytes + self.count.nbytes + self.ids.nbytes

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """Where each key lies among the known ones, -1 if it doesn't."""
        if len(self.keys) == 0:
            return np.full(len(keys), -1, dtype=np.int64)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, at, -1)

    def _learn(self, keys: np.ndarray, texts: list[tuple[str, bool]]) -> None:
        got = self.encode_chunks(texts)
        lengths = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        flat = np.fromiter((i for x in got for i in x), dtype=np.uint32, count=int(lengths.sum()))
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.start = np.insert(self.start, at, starts[order].astype(np.uint32))
        self.count = np.insert(self.count, at, lengths[order].astype(np.uint32))
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the number of ids of each text; null counts as empty."""
        data, starts = words.text_bytes(texts)
        n = len(starts) - 1
        begin, end, text = cut(data, starts, self.whole)
        if len(begin) == 0:
            return np.zeros(0, dtype=np.uint32), np.zeros(n, dtype=np.int64)
        opens = np.zeros(len(begin), dtype=bool)
        opens[np.flatnonzero(np.r_[True, text[1:] != text[:-1]])] = True
        keys = words._word_hashes(data, begin, end)
        if self.first_differs:
            keys = np.where(opens, words.mix(keys + np.uint64(1)), keys)
        codes, unique = pd.factorize(keys)
        place = self._place(unique)
        new = np.flatnonzero(place < 0)
        if len(new):
            if self.held() > MOST_BYTES:
                self._forget()
                new = np.arange(len(unique))
            where = np.empty(len(unique), dtype=np.int64)
            where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            at = where[new]
            raw = data.tobytes()
            self._learn(unique[new], [(raw[b:e].decode("utf-8"), o) for b, e, o in zip(begin[at].tolist(), end[at].tolist(), opens[at].tolist(), strict=True)])
            place = self._place(unique)
        slot = place[codes]
        counts = self.count[slot].astype(np.int64)
        ids = self.ids[spread(self.start[slot].astype(np.int64), counts)]
        return ids, np.bincount(text, weights=counts, minlength=n).astype(np.int64)


def byte_pair_encoder(path: str) -> ChunkEncoder:
    """Ids of the tokenizers library (``add_special_tokens=False``) with the vocabulary at ``path``.

    For byte-level pre-tokenisation without added prefix spaces and without a normaliser.
    """
    import json
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    splitter = told.get("pre_tokenizer") or {}
    if told.get("normalizer") or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space"):
        raise ValueError("chunks need a byte-level vocabulary without normaliser and prefix space")
    if any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in told.get("added_tokens", [])):
        raise ValueError("chunks need added tokens that take no spaces")

    model = tokenizer.model

    def encode_chunks(chunks: list[tuple[str, bool]]) -> list[list[int]]:
        # a run of letters, with or without a space before it, is one word for the merges
        out: list[list[int] | None] = [
            [t.id for t in model.tokenize(c.encode().decode("latin-1").translate(_BYTE_LEVEL))] if (c[1:] if c[0] == " " else c).isalpha() else None
            for c, _ in chunks
        ]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, tokenizer.encode_batch_fast([chunks[i][0] for i in rest], add_special_tokens=False), strict=True):
            out[i] = x.ids
        return out

    return ChunkEncoder(encode_chunks, False, tuple(t["content"].encode() for t in told.get("added_tokens", [])))


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def byte_pair(path: str) -> ChunkEncoder:
    """The encoder of this process for a vocabulary; what it learned serves later tasks."""
    if ("bpe", path) not in _ENCODERS:
        _ENCODERS["bpe", path] = byte_pair_encoder(path)
    return _ENCODERS["bpe", path]
