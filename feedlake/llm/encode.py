"""Byte-level BPE of whole batches of texts, with the tokenizers library.

Texts are cut at spaces, where the tokenizer's own pattern cuts too; each
different piece of a batch is encoded once and the ids are gathered back by
Arrow, so that the encoder sees vocabulary, not running text. Pieces not seen
before go through tiktoken over the same vocabulary and merges, read from the
tokenizer's file, which is three times as fast; texts with characters or white
space for which the cut isn't proven go whole through tokenizers.
"""

from __future__ import annotations

import ctypes
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered by one Python worker.
CACHE = 120_000

#: Characters for which cutting at spaces is known to agree with the pattern.
_ODD = "[^\\t\\n\\r\\x20-\\x7e\\x{a1}-\\x{24f}]"
#: A space with white space on both sides belongs to a run that must stay whole.
_RUN = "[\\t\\n\\r ] [\\t\\n\\r ]"


#: The split pattern of byte-level BPE, and the characters that stand for bytes in its files (fixed values).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _ranks(path: str) -> dict[bytes, int] | None:
    """Bytes and rank of every token, or None where ids don't rise in the order of the merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    hidden = [b for b in range(256) if b not in set(_SHOWN)]
    byte = {chr(b): b for b in _SHOWN} | {chr(256 + k): b for k, b in enumerate(hidden)}
    vocab = model["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    return {bytes(byte[c] for c in t): k for t, k in vocab.items() if all(c in byte for c in t) and not t.startswith("<|")}


class Encoder:
    """Token ids of texts by a tokenizer file, special tokens not added."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of over 16 bits")
        ranks = _ranks(path)
        self.fast = ranks and tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint16).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        if not self.fast:
            return self._whole(pieces)
        encode = self.fast.encode_ordinary
        return [array("H", encode(p)).tobytes() for p in pieces]

    def _known(self, pieces: list[str]) -> list[bytes]:
        get = self.cache.get
        out = [get(p) for p in pieces]
        new = [k for k, v in enumerate(out) if v is None]
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for k, v in zip(part, self._ids([pieces[k] for k in part]), strict=True):
                out[k] = v
                if len(self.cache) < CACHE:
                    self.cache[pieces[k]] = v
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as uint16, offsets: text k has ids[offsets[k]:offsets[k + 1]]). Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.or_(pc.match_substring_regex(texts, _ODD), pc.or_(pc.match_substring_regex(texts, _RUN), pc.match_substring(texts, "<|")))
        quick = pc.if_else(whole, "", texts)
        lists = pc.split_pattern(pc.replace_substring(quick, " ", "\x00 "), "\x00")
        flat = lists.flatten().dictionary_encode()
        known = pa.array(self._known(flat.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        taken = known.take(flat.indices)
        bounds = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8) // 2
        data = taken.buffers()[2]
        ids = np.frombuffer(data, np.uint16, len(data) // 2) if data is not None else np.zeros(0, np.uint16)
        cuts = bounds[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
        if not pc.any(whole).as_py():
            return ids, cuts
        at = np.flatnonzero(np.asarray(whole))
        rest = dict(zip(at.tolist(), (np.frombuffer(b, np.uint16) for b in self._whole([texts[int(k)].as_py() for k in at])), strict=True))
        parts = [rest[k] if k in rest else ids[cuts[k] : cuts[k + 1]] for k in range(len(texts))]
        return np.concatenate(parts) if parts else ids, np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def split_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about `most` bytes of `column`, or one row."""
    for b in batches:
        if b.num_rows == 0:
            continue
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0), np.int64))
        start = 0
        while start < b.num_rows:
            base = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, base + most, "right")))
            yield b.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """Give what a task has freed back to the machine, as Python workers live on beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
