"""Each stage of the pipeline against a plain version of itself, on what its predecessor kept."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer as Library

import corpus_pipeline
from attesta.llm.queries import tokenizer_path
from attesta.llm.quality import quality_scores
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_mixing import water, words
from tests.llm.test_neardup import brute as classes


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        step(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "token_output"]
    assert all(df.columns == kept[0].columns for df in kept[1:-1])
    assert all(b.select("doc_id").distinct().count() <= a.count() for a, b in zip(kept, kept[1:]))


def test_quality(spark, sf_dir, kept):
    scores = quality_scores(kept[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert set(texts(kept[1])) == {r.doc_id for r in scores.where("predicted = 1").collect()}


def test_near_dedup(kept):
    rows = sorted(texts(kept[1]).items())
    want = {int(c) for _, c in classes(rows)}
    assert set(texts(kept[2])) == want and kept[2].count() == len(want)


def test_decontamination(spark, sf_dir, kept):
    rows = sorted(texts(kept[2]).items())
    found = {int(d) for d, _, _ in leaks(rows, [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])}
    assert set(texts(kept[3])) == {d for d, _ in rows} - found


def test_mixing(kept):
    rows = kept[3].select("doc_id", "text", "source").collect()
    taken = Counter(r.doc_id for r in kept[4].select("doc_id").collect())
    sizes = Counter()
    for r in rows:
        sizes[r.source] += words(r.text)
    order = sorted(sizes)
    want = dict(zip(order, water([sizes[s] for s in order])))
    got, longest = Counter(), Counter()
    for r in rows:
        assert taken[r.doc_id] <= 2
        got[r.source] += taken[r.doc_id] * words(r.text)
        longest[r.source] = max(longest[r.source], words(r.text))
    assert all(abs(got[s] - want[s]) <= longest[s] + 1e-6 for s in order)
    assert set(texts(kept[4]).items()) <= set(texts(kept[3]).items())


def test_token_output(kept):
    library, start, want = Library.from_file(tokenizer_path()), 0, []
    for r in sorted(kept[4].select("doc_id", "text").collect(), key=lambda r: r.doc_id):
        ids = np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, kept[5].collect()), key=lambda r: r[1]) == want


def test_run_gives_the_last_stages_rows(spark, sf_dir, kept):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, kept[5].collect()))


@pytest.fixture(scope="module")
def odd(spark, sf_dir):
    """Documents with null and repeated ids, repeated rows, empty and long texts, and columns named like the stages' own."""
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()
    rows = [(r.doc_id if i % 5 else None, r.text, r.source if i % 7 else None) for i, r in enumerate(some)] + [(some[1].doc_id, some[3].text, "s"), (None, None, "s"), (None, "", "s"), (7, some[2].text, "s"), (7, some[2].text, "s"), (900, some[4].text * 40, "s")]
    names = "row_key string, kept_key string, mixed_key string, mixed_copies int, score double, label string, _metadata string, source_size long"
    return spark.createDataFrame([(*r, "k", "k", "k", 9, 0.5, "l", "m", 3) for r in rows], f"doc_id long, text string, source string, {names}")


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES)
def test_odd_rows_and_columns(spark, sf_dir, odd, tmp_path, name, step):
    odd.write.parquet(str(tmp_path / "odd"))
    rows = Counter(map(tuple, odd.collect()))
    for docs in (odd, spark.read.parquet(str(tmp_path / "odd"))):
        out = step(spark, docs, sf_dir)
        if name == "token_output":
            assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in odd.collect())
            continue
        assert out.columns == odd.columns
        got = Counter(map(tuple, out.collect()))
        assert got.keys() <= rows.keys()
        if name in ("quality", "decontamination"):  # judged by their texts alone
            assert all(n == rows[r] for r, n in got.items()) and len({r[1] or "" for r in rows} - {r[1] or "" for r in got}) + len({r[1] or "" for r in got}) == len({r[1] or "" for r in rows})
        if name == "near_dedup":
            assert max(got.values()) == 1
        if name == "mixing":
            assert all(n <= 2 * rows[r] for r, n in got.items())


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES)
def test_empty_tables(spark, sf_dir, odd, tmp_path, name, step):
    odd.limit(0).write.parquet(str(tmp_path / "none"))
    for docs in (odd.limit(0), spark.read.schema(odd.schema).parquet(str(tmp_path / "none"))):
        out = step(spark, docs, sf_dir)
        assert out.count() == 0 and (name == "token_output" or out.columns == odd.columns)
