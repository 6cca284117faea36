"""Word shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes between words: ASCII white space, or all of ASCII but letters and digits.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
#: Texts are worked on in blocks of about this many bytes.
BLOCK_BYTES = 1 << 20
#: Bytes, or shingles, that are worked on at once inside a block.
CHUNK = 1 << 18


def mix(z: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection whose output bits all depend on all input bits."""
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for all places of a chunk."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(CHUNK + 1, base, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def word_hashes(texts: list[bytes], between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (run of bytes that aren't `between` words), and the number of words before each text (n + 1).

    A word's hash is a polynomial in its bytes. Bytes are worked on in chunks, and a word that a chunk cuts is carried
    over, so memory beside the result is bounded however long a text or a word is.
    """
    joined = b" ".join(texts) + b" "
    bytes_, (power, inverse) = np.frombuffer(joined, dtype=np.uint8), _powers()
    hashes, starts = [], []
    held, length, begun = np.zeros(1, dtype=np.uint64), 0, 0  # a word that isn't at its end yet: its sum, its bytes, its begin
    for at in range(0, len(bytes_), CHUNK):
        chunk = bytes_[at : at + CHUNK]
        space = between[chunk]
        edge = np.diff(space.astype(np.int8), prepend=1, append=1)
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(chunk) + 1, dtype=np.uint64)
        np.cumsum((chunk.astype(np.uint64) + _U(1)) * power[: len(chunk)], out=sums[1:])
        value, size, place = (sums[end] - sums[start]) * inverse[start], end - start, start + at
        if length:
            if not len(value) or start[0]:  # the word was at its end with the chunk before
                value, size, place = np.append(held, value), np.append(length, size), np.append(begun, place)
            else:
                value[:1] = held + value[:1] * _U(pow(_BASE, length, 1 << 64))
                size[0] += length
                place[0] = begun
            length = 0
        if not space[-1] and len(value):
            held, length, begun = value[-1:], int(size[-1]), int(place[-1])
            value, size, place = value[:-1], size[:-1], place[:-1]
        hashes.append(mix(value + size.astype(np.uint64)))
        starts.append(place)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_counts(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: text index (ascending), shingle hash (ascending in a text), count.

    Words are runs of letters, digits and non-ASCII characters. A text of fewer words than `width`, but not none, is a
    single shingle.
    """
    words, first = word_hashes(texts, PUNCTUATION)
    n = np.diff(first)
    per_text = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    ends = np.cumsum(per_text)
    total = int(ends[-1]) if len(ends) else 0
    h, doc = np.empty(total, dtype=np.uint64), np.repeat(np.arange(len(texts), dtype=np.int32), per_text)
    for begin in range(0, total, CHUNK):
        own = doc[begin : begin + CHUNK]
        at = np.arange(begin, begin + len(own)) + (first[:-1] - ends + per_text)[own]
        left, last = first[1:][own] - at, len(words) - 1
        part = np.zeros(len(own), dtype=np.uint64)
        for k in range(width):
            word = np.where(left > k, words[np.minimum(at + k, last)], _U(0))
            part = mix(part * _U(0xD1342543DE82EF95) + word + _U(k + 1))
        h[begin : begin + len(own)] = part
    del words
    order = np.lexsort((h, doc)) if len(texts) > 1 else np.argsort(h)
    doc, h = doc[order], h[order]
    del order
    new = np.ones(total, dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    where = np.flatnonzero(new)
    return doc[where].astype(np.int64), h[where], np.diff(np.append(where, total))


def blocks(texts: list[str | None], size: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Lower-cased UTF-8 texts in blocks of limited size, with the index of each block's first text."""
    begin, block, held = 0, [], 0
    for k, text in enumerate(texts):
        raw = (text or "").lower().encode()
        block.append(raw)
        held += len(raw)
        if held >= size:
            yield begin, block
            begin, block, held = k + 1, [], 0
    if block:
        yield begin, block
