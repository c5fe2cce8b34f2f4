"""SentencePiece BPE ids of whole texts and back, by a table of each prefix's last token.

Greedy merging of a text gives tokens of which every two neighbours are compatible:
merging the two texts as one gives the two tokens again. The other way round, tokens of
which all neighbours are compatible are the encoding of their text, as merges inside a
token happen in the same order whatever stands beside it. So each prefix of a text has one
last token: of the pieces that end there (an automaton finds all of them in one pass) the
one which is compatible with the last token of the prefix before it. The table is filled
from left to right and read backwards. Merging itself is only done for pairs of pieces.

Pieces hold the word mark at their front only, so words are encoded by themselves;
characters in no piece are single tokens, written as bytes, and part a word.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, whole_text
from .encode import split_batches

#: The word mark, which stands for a space, and the kinds of pieces (fixed values).
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Words (of this and of the last filling) and pairs of tokens remembered by one Python worker, and the longest word kept.
WORDS, PAIRS, WORD = 250_000, 1_000_000, 64
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceModel:
    """The pieces of a BPE model with byte fallback and no normalising rules."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        kinds = {p.type for p in model.pieces}
        rules = model.normalizer_spec
        fits = model.trainer_spec.model_type == 2 and model.trainer_spec.byte_fallback and not rules.precompiled_charsmap
        if not fits or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback, a leading mark and unchanged texts are supported")
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.text = [p.piece for p in model.pieces]
        self.end = next(k for k, p in enumerate(model.pieces) if p.piece == (model.trainer_spec.eos_piece or "</s>"))
        self.byte = {int(p.piece[1:-1], 16): k for k, p in enumerate(model.pieces) if p.type == BYTE}
        if any(MARK in p.lstrip(MARK) for p in self.score) or any(c not in self.score for p in self.score for c in p):
            raise ValueError("pieces must have the mark in front only and be made of pieces of one character")
        self.spoken = [bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else b" \xe2\x81\x87 " if p.type == UNKNOWN else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        self.leads = [p.type == NORMAL and p.piece.startswith(MARK) for p in model.pieces]
        self.is_byte = [p.type == BYTE for p in model.pieces]
        # A piece that merging its own text doesn't give is never a token.
        self.automaton = ahocorasick.Automaton()
        for k, p in enumerate(model.pieces):
            if p.type == NORMAL and self.merge(p.piece) == [p.piece]:
                self.automaton.add_word(p.piece, (k, len(p.piece)))
        self.automaton.make_automaton()
        self.known = re.compile("[" + re.escape("".join(sorted(p for p in self.score if len(p) == 1))) + "]+|.", re.DOTALL)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """Greedy merging, of short texts only: the neighbours whose union has the best score, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' texts as one gives the two tokens."""
        found = self.pairs.get((left, right))
        if found is None:
            a, b = self.text[left], self.text[right]
            found = self.merge(a + b) == [a, b]
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def _part(self, text: str) -> list[int]:
        """The tokens of a text of known characters, by the last token of each prefix."""
        last = [-1] * (len(text) + 1)
        size = last.copy()
        known = self.pairs.get
        for at, (token, length) in self.automaton.iter(text):
            end = at + 1
            if last[end] < 0:
                if length < end:
                    fits = known((last[end - length], token))
                    if fits is False or fits is None and not self.compatible(last[end - length], token):
                        continue
                last[end], size[end] = token, length
        out, end = [], len(text)
        while end:
            out.append(last[end])
            end -= size[end]
        out.reverse()
        return out

    def word(self, word: str) -> bytes:
        """The ids of a word, as bytes of 32-bit numbers."""
        found = self.words.get(word) or self.older.get(word)
        if found is None:
            ids: list[int] = []
            for part in self.known.findall(word):
                ids += self._part(part) if part[0] in self.score else [self.byte[b] for b in part.encode()]
            found = array("i", ids).tobytes()
        if len(word) <= WORD:
            if len(self.words) >= WORDS:
                self.words, self.older = {}, self.words
            self.words[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, without an end id; an empty text has none."""
        if not text:
            return b""
        words, word = self.words, self.word
        return b"".join([words.get(w) or word(w) for w in _WORDS.findall(MARK + text.replace(" ", MARK))])

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids; control ids say nothing, the first mark goes, bytes that are no UTF-8 become U+FFFD."""
        lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
        offsets = np.asarray(lists.offsets, np.int64)
        offsets = offsets - offsets[0]
        said = np.array(lists.flatten(), np.int64)
        said[offsets[:-1][np.diff(offsets) > 0]] += len(self.spoken)
        firsts = [s[1:] if lead else s for s, lead in zip(self.spoken, self.leads, strict=True)]
        words = pa.array([*self.spoken, *firsts], pa.large_binary()).take(pa.array(said))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), words), pa.scalar(b"", pa.large_binary()))
        try:
            return joined.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([self._spell(x) for x in lists.to_pylist()], pa.large_string())

    def _spell(self, ids: list[int]) -> str:
        """One text, of which a run of byte tokens is no UTF-8: each byte that fits nowhere becomes U+FFFD."""
        out, k = [], 0
        while k < len(ids):
            if not self.is_byte[ids[k]]:
                said = self.spoken[ids[k]]
                out.append((said[1:] if k == 0 and self.leads[ids[k]] else said).decode())
                k += 1
                continue
            run = b""
            while k < len(ids) and self.is_byte[ids[k]]:
                run += self.spoken[ids[k]]
                k += 1
            while run:
                wide = next((n for n in range(1, 5) if _is_text(run[:n])), 0)
                out.append(run[:wide].decode() if wide else "�")
                run = run[wide or 1 :]
        return "".join(out)


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model of this Python worker, read once."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _keep(df: DataFrame, keep: list[str]) -> tuple[DataFrame, list[T.StructField]]:
    """The kept columns under names of their own, so that none clashes with those that are added."""
    picked = df.select(*[F.col(f"`{c}`").alias(f"k{n}") for n, c in enumerate(keep)])
    return picked, list(picked.schema)


def encode_pieces(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), end: bool = True) -> DataFrame:
    """The kept columns and `ids`, an array of the ids of each row's whole text, with the end id at last unless `end` is false.

    Null texts count as empty, whose only id is the end; rows are judged one by one,
    so repeated rows, rows without an id and other columns don't matter; an empty table
    gives an empty one. `path` must be readable by every executor.
    """
    bound_batches(df.sparkSession)
    _, fields = _keep(df, list(keep))
    rows = df.select(*[F.col(f"`{c}`").alias(f"k{n}") for n, c in enumerate(keep)], whole_text(F.col(f"`{text}`")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        tail = array("i", [model.end]).tobytes() if end else b""
        for b in split_batches(batches, "text"):
            parts = [model.encode(t) + tail for t in b.column("text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(parts), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets), ids)
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in fields], lists], names=[*[f.name for f in fields], "ids"])

    out = rows.mapInArrow(run, T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.toDF(*keep, "ids")


def decode_pieces(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and `decoded`, the text that each row's ids stand for; null ids are the empty text."""
    bound_batches(df.sparkSession)
    _, fields = _keep(df, list(keep))
    rows = df.select(*[F.col(f"`{c}`").alias(f"k{n}") for n, c in enumerate(keep)], F.col(f"`{ids}`").cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for b in batches:
            if b.num_rows:
                said = model.decode(b.column("ids")).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in fields], said], names=[*[f.name for f in fields], "decoded"])

    out = rows.mapInArrow(run, T.StructType([*fields, T.StructField("decoded", T.StringType())]))
    return out.toDF(*keep, "decoded")
