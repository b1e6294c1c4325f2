import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from attesta.llm import _bpe
from attesta.llm._hash import slices
from attesta.llm.token_counts import token_counts
from attesta.llm.token_shards import ShardReader, ShardWriter, pack_block, read_shards, token_shards, unpack_block, write_shards

PATH = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    alphabet = list(" \n\t\r'sdtrevmll.,!09aZé²½  ’ñ漢字🙂́​\x1c\x85") + ["  ", "'s", "'re", "'ll", "<|endoftext|>", "ẞ", "ⅷ", "٣"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + ["", None, "'", "a's", "'s's", "x" * 50_000, " " * 5_000, "<|endoftext|>"]


@pytest.mark.parametrize("slots", [1 << 21, 1 << 8])
def test_ids_are_the_librarys(slots):
    import pyarrow as pa

    texts, library = odd_texts(4000), Library.from_file(PATH)
    mine = _bpe.Tokenizer(PATH, slots=slots)
    got = []
    for _, raw, offsets in slices(pa.array(texts)):
        ids, n = mine.run(raw, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("size", [8, 64, 700])
def test_texts_in_parts_are_the_librarys(monkeypatch, size):
    import pyarrow as pa

    from attesta.llm import _hash

    monkeypatch.setattr(_hash, "SLICE_BYTES", size)
    texts, library = ["".join(t or "" for t in odd_texts(60, seed)) for seed in range(40)] + odd_texts(500, 77), Library.from_file(PATH)
    mine = _bpe.Tokenizer(PATH)
    assert mine.cuts
    got, parts = [[] for _ in texts], 0
    for at, raw, offsets, whole in _hash.token_parts(pa.array(texts)):
        ids, n = mine.run(raw, offsets)
        parts += not whole
        for i, x in enumerate(np.split(ids, np.cumsum(n)[:-1])):
            got[at + i] += x.tolist()
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts] and parts > 100


def test_counts_of_a_whole_table(spark, sf_dir):
    library = Library.from_file(PATH)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: (len(r.text.encode()), len(library.encode(r.text, add_special_tokens=False).ids)) for r in docs.collect()}
    rows = token_counts(docs, PATH).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_odd_rows(spark, docs_of, name):
    path, texts = public_tokenizers.path(name), odd_texts(150, 2)
    if name.endswith(".json"):
        library = Library.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a null id"), (3, "again"), (3, "again")]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts(docs_of(rows), path).collect())
    assert got == sorted((str(d), len((t or "").encode()), count(t or "")) for d, t in rows)
    assert token_counts(docs_of([]), path).count() == 0


@pytest.mark.parametrize("bits", [8, 1])
def test_blocks_round_trip(bits):
    rnd = np.random.default_rng(0)
    for n in (1, 7, 8, 9, 1000):
        ids = rnd.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
        assert unpack_block(pack_block(ids, bits)).tolist() == ids.tolist()


def test_planes_compress_ids(prose):
    ids = np.array(Library.from_file(PATH).encode(prose(20_000, 1), add_special_tokens=False).ids, np.uint32)
    assert len(pack_block(ids)) < 2.1 * len(ids)


def check(rows, got):
    library, start, want = Library.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_shards_of_a_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in token_shards(docs, PATH).collect()])


@pytest.mark.parametrize("block,bits", [(1 << 16, 8), (3, 1), (1, 8)])
def test_shards_of_odd_rows(spark, docs_of, block, bits):
    rows = [(i * 7 % 50, t) for i, t in enumerate(odd_texts(42, 3))] + [(None, "no id"), (60, "long text, 漢字 in parts\n\n " * 30_000), (61, "x" * 300_000)]
    check(rows, [tuple(r) for r in token_shards(docs_of(rows), PATH, block=block, bits=bits).collect()])
    assert token_shards(docs_of([]), PATH).count() == 0


def test_repeated_rows_and_no_end_id(spark, docs_of):
    rows = [(1, "same"), (1, "same"), (2, ""), (3, None)]
    got = sorted(tuple(r) for r in token_shards(docs_of(rows), PATH, end_id=None).collect())
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 0, 1), (1, 1, 1), (2, 2, 0), (3, 2, 0)]


def test_many_shards_a_task(spark, docs_of, prose, tmp_path):
    rows = [(i * 3, prose(20_000, i)) for i in range(40)] + [(500, ""), (None, "x")]  # of parts of 256 kB
    check(rows, [tuple(r) for r in token_shards(docs_of(rows), PATH, shard_bytes=3000).collect()])
    write_shards(docs_of(rows), f"file://{tmp_path}/ids", PATH, shard_bytes=3000, task_bytes=1 << 21)
    readers = [ShardReader(p.open("rb")) for p in tmp_path.glob("ids/part-*")]
    assert len(readers) > 2 * len({r.task for r in readers})
    for task in {r.task for r in readers}:
        own = sorted((r.number, r.first, int(r.docs["n"].sum())) for r in readers if r.task == task)
        assert [n for n, _, _ in own] == list(range(len(own)))
        assert all(b[1] == a[1] + a[2] for a, b in zip(own[:-1], own[1:], strict=True))


def test_a_shard_is_handed_over_in_small_rows(spark, docs_of, prose):
    from functools import partial

    from attesta.llm.token_shards import ROWS, _write

    rows = [(i, prose(4000, i)) for i in range(300)] + [(300, prose(400_000, 7))]  # two shards, the last text in parts
    docs = docs_of(rows).coalesce(1).sortWithinPartitions("doc_id").select("doc_id", "text")
    sizes = [len(r.value) for r in docs.mapInArrow(partial(_write, path=PATH, end_id=2, block=1 << 12, bits=8, shard_bytes=1 << 22), "value binary").collect()]
    assert len(sizes) == 2 * ROWS and sum(sizes) > 2 << 20 and max(sizes) < 1 << 18


def test_starts_of_tasks_need_no_python_workers(spark, docs_of):
    plan = token_shards(docs_of([(1, "a"), (2, "b")]), PATH)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan and "LogicalRDD" not in plan


def test_any_store(spark, store, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    write_shards(spark.read.parquet(store(f"{sf_dir}/documents.parquet")), store.new("ids"), PATH)
    check(rows, [tuple(r) for r in read_shards(spark, store.new("ids")).collect()])


def test_random_access_and_broken_files(spark, tmp_path, prose, docs_of):
    write_shards(docs_of([(i, prose(50, i)) for i in range(20)]), f"file://{tmp_path}/ids", PATH, block=64)
    with next(tmp_path.glob("ids/part-*")).open("rb") as f:
        reader = ShardReader(f)
        n = int(reader.docs["n"].sum())
        whole = reader.ids(0, n)
        assert len(whole) == n and reader.ids(70, 200).tolist() == whole[70:200].tolist() and len(reader.ids(5, 5)) == 0
    with open(tmp_path / "bad", "wb") as out:
        ShardWriter(out).add(np.arange(3, dtype=np.uint32), np.zeros(0, [("id", "<i8"), ("null", "u1"), ("n", "<u8")]))
    with pytest.raises(ValueError), open(tmp_path / "bad", "rb") as f:
        ShardReader(f)

