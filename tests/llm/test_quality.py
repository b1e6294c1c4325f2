import zlib

import numpy as np
import pyarrow as pa
import pytest

from attesta.llm._hash import SLICE_BYTES, slices, words
from attesta.llm.quality import _CLASS, CLASSES, FEATURES, PASSAGE, AttentionModel, accepted, encode, encode_long, fit, quality_scores, scores_of


def test_held_out_accuracy_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for d, r in got.items())
    test = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [g.predicted for q, g in test if q == 1], [g.predicted for q, g in test if q == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.25


def test_gradients_are_right():
    rnd = np.random.default_rng(0)
    model = AttentionModel(1)
    x, first, y = rnd.standard_normal((9, FEATURES)).astype(np.float32) * 0.3, np.array([0, 4, 5, 9]), np.array([1, 0, 1], np.float32)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        s = model.forward(x, first)["s"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grads = model.gradients(model.forward(x, first), first, y)
    for name, value in model.p.items():
        flat = value.reshape(-1)
        for i in rnd.choice(len(flat), min(5, len(flat)), replace=False):
            keep, eps = flat[i], 1e-5
            flat[i] = keep + eps
            up = loss()
            flat[i] = keep - eps
            down = loss()
            flat[i] = keep
            assert grads[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * eps), rel=1e-3, abs=1e-6)


def test_features_dont_depend_on_neighbours(prose):
    texts = [prose(200, 1), None, "", "one", prose(64, 2), "A| B|\nC", prose(65, 3), " \t "]
    alone = [encode(raw, off)[0] for t in texts for _, raw, off in slices(pa.array([t], pa.string()))]
    for _, raw, offsets in slices(pa.array(texts)):
        x, first = encode(raw, offsets)
        for i, want in enumerate(alone):
            assert (x[first[i] : first[i + 1]] == want).all() and x[first[i] : first[i + 1]].shape == want.shape


def test_odd_rows(spark, prose):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (7, None, 0), (8, 5, 0)], "doc_id long, quality int, toxic int")
    rows = [(i, prose(80, i) if i % 2 else "$$$ %%% " * 80) for i in range(60)] + [(None, "no id"), (100, None), (101, ""), (101, ""), (102, prose(40_000, 1))]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id long, text string, score double, predicted int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == 101}) == 1
    assert all((r.predicted == 1) == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.doc_id < 60)
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).count() == 0
    kept = accepted(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i in range(60) if i % 2}


def plain_features(text):
    """Features of a text's passages, counted one by one."""
    raw = np.frombuffer(text.encode(), np.uint8)
    h, start, end, _ = words(raw, np.array([0, len(raw)]))
    h, start, end = h.tolist(), start.tolist(), end.tolist()
    out = []
    for k in range(max(1, -(-len(h) // PASSAGE))):
        mine = range(k * PASSAGE, min((k + 1) * PASSAGE, len(h)))
        a = start[mine[0]] if k else 0
        b = start[(k + 1) * PASSAGE] if (k + 1) * PASSAGE < len(h) else len(raw)
        pairs, buckets = np.zeros(CLASSES**2), np.zeros(32)
        for i in range(a, b):
            pairs[(_CLASS[raw[i - 1]] if i else 3) * CLASSES + _CLASS[raw[i]]] += 1
        for i in mine:
            buckets[h[i] % 32] += 1
        n, sizes = max(1, len(mine)), [end[i] - start[i] for i in mine] or [0]
        seen = [h[i] for i in mine]
        shape = [
            len(mine) / PASSAGE, np.mean(sizes) / 10, np.std(sizes) / 10, len(set(seen)) / n, max((seen.count(x) for x in set(seen)), default=0) / n, sum(x == y for x, y in zip(seen, seen[1:], strict=False)) / n,
            sum(text.encode()[start[i] : start[i] + 1].isupper() for i in mine) / n, np.log1p(len(h)) / 10,
        ]
        out.append(np.concatenate([np.sqrt(pairs / max(1, pairs.sum())), np.sqrt(buckets / n), shape]))
    return np.array(out)


def plain_score(model, text):
    """The score of one text, passage by passage."""
    p, passages = model.p, []
    for x in plain_features(text).astype(np.float16).astype(np.float64):
        h = np.tanh(np.clip((x - model.mean) * model.scale, -8, 8) @ p["w"] + p["b"])
        gate = np.tanh(h @ p["v"] + p["vb"]) / (1 + np.exp(-(h @ p["u"] + p["ub"])))
        passages.append((np.exp(gate @ p["a"]), h))
    z = sum(a * h for a, h in passages) / sum(a for a, _ in passages)
    return 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))


def test_scores_are_those_of_a_plain_count(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs.select("doc_id", "text"), labels)
    got = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == pytest.approx(plain_score(model, r.text or ""), abs=2e-3)


def test_long_texts_are_encoded_in_parts_as_a_whole(prose):
    for text in (prose(60_000, 1), "Ab" * SLICE_BYTES + " " + prose(90, 2) + " " + "x" * 3 * SLICE_BYTES, " \n" * SLICE_BYTES, prose(70_000, 3).replace(" ", "\n\n")):
        raw = np.frombuffer(text.encode(), np.uint8)
        assert len(raw) > SLICE_BYTES
        assert np.array_equal(np.concatenate(list(encode_long(raw))), encode(raw, np.array([0, len(raw)]))[0])
        model = AttentionModel(3)
        whole = model.forward(encode(raw, np.array([0, len(raw)]))[0].astype(np.float16).astype(np.float32), np.array([0, len(list(np.concatenate(list(encode_long(raw)))))]))["s"]
        assert next(scores_of(pa.array([text]), model))[1] == pytest.approx(whole, abs=1e-5)


def test_repeated_documents_bring_one_bag_a_label(spark, prose):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] * 3, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, prose(70, i) if i % 2 else "$$$ %%% " * 70) for i in range(20)] * 50, "doc_id long, text string")
    once = fit(docs.dropDuplicates(), labels)
    assert all(np.array_equal(once.p[k], v) for k, v in fit(docs, labels).p.items())
