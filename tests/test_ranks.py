"""Counts by ranks, as a text grows, against the library that such files are made for."""

from __future__ import annotations

import random
import time

import pytest

from attesta.functions.ranks import RANK_PATTERN, Ranks, read_ranks
from attesta.operators import silver

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
LETTERS = "ab cde  \n\t'sll'Ré漢🙂12345.,!!-_ the ing \r\n　"


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    table = read_ranks(public_tokenizers.path(request.param))
    library = tiktoken.Encoding("own", pat_str=RANK_PATTERN, mergeable_ranks=table, special_tokens={})
    return Ranks(table), lambda value: len(library.encode_ordinary(value))


def odd(n, size, letters=LETTERS):
    rnd = random.Random(n)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(size))) for _ in range(n)]


def test_counts_are_the_librarys_at_any_border(both):
    ranks, library = both
    for text in odd(800, 60):
        assert ranks.count(text) == library(text)
        for at in (0, len(text) // 3, len(text) // 2, len(text)):
            _, stable, border = ranks.grown(0, "", text[:at])
            assert ranks.grown(stable, border, text[at:])[0] == library(text)


def test_every_prefix_of_a_pre_token(both):
    ranks, library = both
    for word in odd(60, 150, "abcdefghioustrné漢"):
        raw = word.encode()
        at = [len(word[:i].encode()) for i in range(1, len(word) + 1)]
        counts = list(ranks.prefixes(raw))
        if word.isalpha():
            assert [counts[i - 1] for i in at] == [library(word[:i]) for i in range(1, len(word) + 1)]


def test_words_in_pieces_are_as_long_as_they_can_be(both):
    ranks, library = both
    for word in odd(60, 120, "abcdeé漢'123!s"):
        found = list(ranks.pieces(word, 4))
        assert "".join(p for p, _ in found) == word
        for piece, n in found:
            assert n == library(piece) <= 4
        for (piece, _), (after, _) in zip(found[:-1], found[1:], strict=True):
            assert library(piece + after[0]) > 4


def test_chunks_have_whole_counts_in_linear_time(both):
    ranks, library = both
    by = silver.RankCounter(ranks=ranks.ranks)
    rnd = random.Random(3)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghioustrn") for _ in range(rnd.randrange(2, 12))) + rnd.choice(["", "", ".", "\n\n"]) for _ in range(n))
    took = []
    for n in (2000, 8000):
        value, began = text(n), time.perf_counter()
        chunks = silver.split_document(value, 300, 40, by)
        took.append(time.perf_counter() - began)
        assert all(c[2] == library(c[1]) for c in chunks)
        assert all(c[2] <= 300 for c in chunks)
    assert took[1] < 12 * took[0]


def test_a_very_long_word_and_no_bytes(both):
    ranks, library = both
    assert ranks.count("z" * 20_000) == library("z" * 20_000)
    with pytest.raises(ValueError, match="each byte"):
        Ranks({b"a": 0})
