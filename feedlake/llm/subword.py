"""Hashed character n-grams of whole batches of texts, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What words are made of: ASCII letters and digits, and every byte above ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def tables(n: int, seed: int) -> np.ndarray:
    """Random words for tabulation hashing: one table of bytes for each of n positions."""
    return np.random.default_rng(seed).integers(0, 1 << 32, (n, 256), dtype=np.uint64).astype(np.uint32)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(a blank and the lower-cased bytes of all texts, each followed by a blank; offsets of the texts). Null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    spaced = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    buffers = spaced.buffers()
    cuts = np.frombuffer(buffers[1], np.int64, len(spaced) + 1, spaced.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8)[cuts[0] : cuts[-1]] if len(spaced) else np.zeros(0, np.uint8)
    return np.concatenate([[np.uint8(32)], _LOWER[data]]), cuts - cuts[0] + 1


def word_spans(data: np.ndarray, digits: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with separators as blanks, starts, ends) of the words, of letters alone without `digits`; data ends with a blank or is empty."""
    is_word = _WORD[data] if digits else _WORD[data] & ~_DIGIT[data]
    edge = np.diff(np.concatenate([[False], is_word, [False]]).astype(np.int8))
    return np.where(is_word, data, np.uint8(32)), np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def gram_buckets(data: np.ndarray, sizes: range, mask: int, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n: (start positions, buckets) of the n-grams that lie in one word and the blanks at its ends."""
    t = tables(sizes.stop, seed)
    gaps = np.concatenate([[0], np.cumsum(data == 32)])
    h = t[0][data]
    out = []
    for n in range(2, sizes.stop):
        if n > len(data):
            break
        h = h[: len(data) - n + 1] ^ t[n - 1][data[n - 1 :]]
        if n in sizes:
            inner = gaps[n - 1 : len(gaps) - 1] - gaps[1 : len(gaps) - n + 1]
            at = np.flatnonzero(inner == 0)
            mixed = (h[at] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            out.append((at, ((mixed >> np.uint32(12)) & np.uint32(mask)).astype(np.int32)))
    return out
