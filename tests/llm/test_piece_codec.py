import random

import pyarrow as pa
import pytest
import sentencepiece

from feedlake.llm import piece_codec
from feedlake.llm.queries import PIECES, QUERIES

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
ODD = ["", " ", "  a", "a\x00b", "▁a", "▁▁ ▁", "​x", "a\tb\n", "é日本😀", "a  b ", "<s>", "</s> <unk>", "<0x41>", "ﬁ", "　a", "﻿x", "😀\U00013000\U00013001", "\n\n\n", "ab" * 500, None]


def texts():
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz   ▁ABCethon_-/.0123456789éß日本語中文😀\n\t"
    pieces = [p for p in piece_codec.piece_model(PIECES).score]
    out = ODD + [c * k for c in " -=0" for k in range(1, 40)] + [" " * k + "the" for k in range(40)]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 150))) for _ in range(1500)]
    return out + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(3000)]


def test_ids_and_texts_are_those_of_the_library(spark, sf):
    rows = list(enumerate(texts() + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    ids = piece_codec.encode_pieces(df, PIECES)
    got = {r["doc_id"]: r for r in piece_codec.decode_pieces(ids, PIECES, keep=("doc_id", "ids")).collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        want = LIBRARY.encode(t or "", add_eos=True)
        assert got[k]["ids"] == want, t
        assert got[k]["decoded"] == LIBRARY.decode(want), t


def test_neighbours_of_an_encoding_are_compatible():
    model = piece_codec.piece_model(PIECES)
    for word in ("▁unbelievable", "▁internationalization", "abcabcabc", "▁" * 37):
        parts = model.merge(word)
        ids = LIBRARY.piece_to_id(parts)
        assert memoryview(model.word(word)).cast("i").tolist() == ids
        assert all(model.compatible(a, b) for a, b in zip(ids, ids[1:]))


def test_decoding_of_any_ids():
    rng = random.Random(3)
    lists = [[rng.randrange(3, 259) if rng.random() < 0.6 else rng.randrange(32_000) for _ in range(rng.randint(0, 9))] for _ in range(2000)]
    got = piece_codec.piece_model(PIECES).decode(pa.array([*lists, None], pa.list_(pa.int32()))).to_pylist()
    assert got == [*[LIBRARY.decode(x) for x in lists], ""]


def test_edge_rows_and_columns(docs):
    ids = piece_codec.encode_pieces(docs, PIECES, keep=("doc_id", "key"), end=False)
    assert ids.columns == ["doc_id", "key", "ids"]
    want = sorted((str(r["doc_id"]), LIBRARY.encode(r["text"] or "")) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["ids"]) for r in ids.collect()) == want
    assert piece_codec.decode_pieces(ids.limit(0), PIECES).count() == 0
    assert piece_codec.encode_pieces(docs.limit(0), PIECES).count() == 0


def test_query(spark, sf):
    import hashlib

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = LIBRARY.encode(r["text"] or "", add_eos=True)
        want[r["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids)))
    got = QUERIES["op12_sentencepiece"](spark, sf)
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == want and got.schema["n_tokens"].dataType.simpleString() == "bigint"


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    with open(PIECES, "rb") as f:
        model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="BPE"):
        piece_codec.PieceModel(str(tmp_path / "m"))
