import math

import numpy as np
import pytest

from attesta.llm.topk import Shard, top_k

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k=10):
    ints = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    out = []
    for place, (q, mine) in enumerate(ints):
        if q % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(mine, v)), i) for n, (i, v) in enumerate(ints) if n != place)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert result(top_k(df)) == brute([(r.vec_id, r.embedding) for r in df.collect()])


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "equal"])
def test_shards_and_blocks(spark, monkeypatch, kind):
    from attesta.llm import topk

    monkeypatch.setattr(topk, "DOCS", 64)
    rnd = np.random.default_rng(2)
    x = rnd.standard_normal((900, 24)) * rnd.random(24) ** 3
    x = {"dense": x, "sparse": x * (rnd.random(x.shape) < 0.1), "ties": np.round(x), "equal": x * 0 + 0.5}[kind].astype(np.float32)
    ids = rnd.permutation(900)
    shard = Shard(ids.astype(np.int64), np.floor(1024.0 * x.astype(np.float64)))
    for q in range(0, 900, 100):
        i = int(np.flatnonzero(ids == q)[0])
        found, score = shard.search(q, np.floor(1024.0 * x[i].astype(np.float64)), 10)
        exact = np.floor(1024.0 * x.astype(np.float64)) @ np.floor(1024.0 * x[i].astype(np.float64))
        order = sorted((-exact[j], ids[j]) for j in range(900) if ids[j] != q)[:10]
        assert list(zip((-score).tolist(), found.tolist())) == [(int(s), int(j)) for s, j in order]


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5]), (100, [0.5]), (200, []), (300, None), (400, [float("nan"), 1.0]), (500, [None, 1.0]), (600, [float("inf")]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [-1.0, 0.1, 3.0]), (None, [9.0, 9.0]), (700, [0.2, 0.1]), (700, [0.2, 0.1]), (700, [0.5, -0.1]), (-100, [0.3, 0.3]), (3, [1e30, 1.0]),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS + ", score int, rank int")
    want = [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in brute(rows)]
    assert result(top_k(df)) == want
    assert top_k(df.limit(0)).count() == 0
    assert result(top_k(df.where("vec_id = 0"))) == []


def test_blocks_of_queries_and_first_rows(spark, monkeypatch):
    from attesta.llm import topk

    monkeypatch.setattr(topk, "QUERY_CELLS", 40)
    rnd = np.random.default_rng(4)
    rows = [(i * 50, [float(x) for x in rnd.standard_normal(8)]) for i in range(12)] + [(i, [float(x) for x in rnd.standard_normal(8)]) for i in range(1, 90)]
    assert result(top_k(spark.createDataFrame(rows, VECTORS))) == brute(rows)


@pytest.mark.parametrize("kind", ["dense", "equal"])
def test_a_bound_leaves_out_only_what_is_below_it(kind):
    rnd = np.random.default_rng(3)
    x = np.floor(1024 * (rnd.standard_normal((500, 16)) if kind == "dense" else np.full((500, 16), 0.5)))
    shard = Shard(np.arange(500), x)
    for q in range(0, 500, 50):
        scores = x @ x[q]
        found, score = shard.search(q, x[q], 10)
        bound = float(np.sort(np.delete(scores, q))[-4])
        near, high = shard.search(q, x[q], 10, bound=bound)
        keep = score >= bound
        assert near.tolist() == found[keep].tolist() and high.tolist() == score[keep].tolist()


def test_any_store(spark, store, sf_dir):
    df = spark.read.parquet(store(f"{sf_dir}/embeddings.parquet"))
    assert result(top_k(df)) == brute([(r.vec_id, r.embedding) for r in df.collect()])
