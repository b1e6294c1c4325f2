"""Encoding by the agenda and decoding against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from attesta.llm import _hash, sentence_pieces
from attesta.llm.queries import op11_sentence_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
#: Blanks, the mark that stands for them, characters without a piece, special strings, combining marks.
ODD = ["", " ", "  ", "▁", "a▁b", " ▁ ", "a  b ", "\n", "\t\n\r", "a\0b", "<s>hi</s><unk><0x41>", "é", "漢字🙂", "　z", "​", "ﬁ", "�", "a" * 500, " " * 300, "﻿x"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(row):
    return np.frombuffer(row["ids"], "<u4").tolist()


def odd_texts(n=600):
    rng, letters = random.Random(5), "ab ▁  \n\0éß漢🙂theingr0123.,'​"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(90))) for _ in range(n)]


def test_rows_are_the_librarys(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    rows = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(docs, PATH), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert (ids_of(r), r["n_tokens"], r["n_mended"], r["decoded"]) == (want, len(want), 0, library.decode(want))


def test_the_query_has_the_librarys_digests(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11_sentence_pieces(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_segments_by_rows_and_by_the_heap_agree(library):
    model = sentence_pieces.Pieces(PATH)
    for text in odd_texts(300):
        if text:
            name = ("▁" + text).replace(" ", "▁")
            assert model.merged(name).tolist() == library.encode(text)


def test_long_texts_are_cut_where_nothing_merges(spark, library, monkeypatch):
    monkeypatch.setattr(_hash, "SLICE_BYTES", 64)
    monkeypatch.setattr(sentence_pieces, "SLICE_BYTES", 64)
    model = sentence_pieces.Pieces(PATH)
    for text in ["word " * 200, "x" * 500, " " * 400 + "y", "▁ ▁" * 90, "a b" + "漢" * 90 + "  c" * 80]:
        ids = []
        for k, part in enumerate(sentence_pieces._parts(text.encode())):
            part = b" " * (k == 0) + part.replace("▁".encode(), b" ")
            ids += model.run(np.frombuffer(part, np.uint8), np.array([0, len(part)]))[0].tolist()
        assert ids == library.encode(text)


def test_what_the_library_says_stands(library):
    model = sentence_pieces.Pieces(PATH)
    model.merged, model.side_by_side = (lambda text: np.array([5])), (lambda codes, sizes: (np.full(len(sizes), 5), np.ones(len(sizes), np.int64)))
    raw = b" some words"
    ids, n, mended = model.run(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert ids.tolist() == library.encode("some words")
    assert mended[0] > 0


def test_a_full_table_is_emptied(library):
    model = sentence_pieces.Pieces(PATH, slots=1 << 8)
    for first in range(0, 3000, 100):
        text = " ".join(f"w{i}x" for i in range(first, first + 100))
        raw = f" {text}".encode()
        assert model.run(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist() == library.encode(text)


def test_decoding_any_ids(spark, library):
    cases = [[], [1, 2], [5, 6], [0xE6, 300, 301], [3 + 0xE6, 3 + 0xBC], [28705], [28705, 28705, 264], [0], [1, 264, 0, 264], [264, 1, 264]]
    rows = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(cases)] + [(99, None)], "n int, ids binary")
    got = {r["n"]: r["decoded"] for r in sentence_pieces.decode_pieces(rows, PATH).collect()}
    assert got == {i: library.decode(x) for i, x in enumerate(cases)} | {99: None}


def test_nulls_repeats_clashing_columns_and_empty_tables(spark, library):
    docs = spark.createDataFrame([(None, "a b", 1), (3, None, 2), (3, None, 2), (4, "", 3)], "doc_id int, text string, ids int")
    rows = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(docs, PATH), PATH).collect()
    assert sorted((r["doc_id"] or 0, ids_of(r), r["decoded"]) for r in rows) == [(0, library.encode("a b", add_bos=True, add_eos=True), "a b"), (3, [1, 2], ""), (3, [1, 2], ""), (4, [1, 2], "")]
    assert sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(docs.limit(0), PATH, begin=False), PATH).count() == 0
    assert [ids_of(r) for r in sentence_pieces.encode_pieces(docs.where("doc_id = 4"), PATH, begin=False, end=False).collect()] == [[]]


def test_another_kind_of_model_is_an_error(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "_fields", lambda raw: iter([(2, b""), (3, 1)]) if raw else iter(()))
    with pytest.raises(ValueError, match="merge-type"):
        sentence_pieces.Pieces(PATH)
