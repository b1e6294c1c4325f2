"""Quality classifier: multiple-instance learning with gated attention.

A document is a bag of passages of PASSAGE words. A passage is encoded by the
frequencies of its character-class pairs, of its words by hash bucket and of
repetition, then by a learned layer. Gated attention (a tanh and a sigmoid
branch, multiplied) weighs the passages; the weighted sum of their encodings is
the document's representation, which a logistic unit scores. All layers are
trained together on document labels alone. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm._hash import SLICE_BYTES, slices, words
from attesta.session import compact, small_batches

PASSAGE = 64
#: Labelled rows that the model is fitted on, at most; drawn by a hash of the id.
SAMPLE = 4000
#: Passages of one labelled text that the model is fitted on, at most; spread evenly over the whole text. Scores use all passages.
FIT_PASSAGES = 64
THRESHOLD = 0.3
#: Every FOLDS-th id by crc32 is held out of learning.
FOLDS = 5
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 32, 16, 25, 64, 3e-3, 1e-4

_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b".", b",;:", b"!?", b"|", b"\"'`()[]{}", b"#$%&*+@~^=<>\\", b"-_/")
CLASSES = len(_GROUPS) + 4
_CLASS = np.full(256, len(_GROUPS), np.int16)
for _i, _g in enumerate(_GROUPS):
    _CLASS[np.frombuffer(_g, np.uint8)] = _i
_SOLID = ~np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
_CLASS[0xC0:] = len(_GROUPS) + 1
_CLASS[0x80:0xA0] = len(_GROUPS) + 2
_CLASS[0xA0:0xC0] = len(_GROUPS) + 3
BUCKETS, SHAPES = 32, 8
FEATURES = CLASSES * CLASSES + BUCKETS + SHAPES


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo FOLDS; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def encode(raw: np.ndarray, offsets: np.ndarray, before: int = 3, of_words: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and for each text the index of its first (one more at the end). A text without words has one empty passage.

    For a part of a longer text ``before`` is the class of the byte before it and ``of_words`` the whole text's words.
    """
    h, start, end, firsts = words(raw, offsets)
    n_words = np.diff(firsts)
    per_doc = np.maximum(1, -(-n_words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per_doc)])
    total = int(first[-1])
    of = np.repeat(first[:-1], n_words) + (np.arange(len(h)) - np.repeat(firsts[:-1], n_words)) // PASSAGE
    out = np.zeros((total, FEATURES), np.float32)
    if not len(raw):
        return out, first
    kind = _CLASS[raw]
    # A passage's bytes go from its first word to the next passage's, a text's first passage from the text's start.
    nth = np.arange(total) - np.repeat(first[:-1], per_doc)
    begin = np.where(nth == 0, np.repeat(offsets[:-1], per_doc), np.append(start, 0)[np.minimum(np.repeat(firsts[:-1], per_doc) + nth * PASSAGE, len(h))])
    byte_of = np.cumsum(np.bincount(begin[begin < len(raw)], minlength=len(raw))) - 1
    pair = np.empty(len(raw), np.int16)
    pair[1:] = kind[:-1]
    pair[offsets[:-1][offsets[:-1] < len(raw)]] = before
    pair = pair * np.int16(CLASSES) + kind
    byte_of *= CLASSES**2
    byte_of += pair
    grams = np.bincount(byte_of, minlength=total * CLASSES**2).reshape(total, -1)
    out[:, : CLASSES**2] = np.sqrt(grams / np.maximum(grams.sum(axis=1, keepdims=True), 1))
    count = np.bincount(of, minlength=total)
    some = np.maximum(count, 1)
    buckets = np.bincount(of * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), minlength=total * BUCKETS).reshape(total, -1)
    out[:, CLASSES**2 : CLASSES**2 + BUCKETS] = np.sqrt(buckets / some[:, None])
    size = (end - start).astype(np.float64)
    mean = np.bincount(of, size, total) / some
    spread = np.sqrt(np.maximum(np.bincount(of, size * size, total) / some - mean**2, 0))
    order = np.lexsort((h, of))
    o, x = of[order], h[order]
    fresh = np.ones(len(x), bool)
    fresh[1:] = (o[1:] != o[:-1]) | (x[1:] != x[:-1])
    runs = np.diff(np.append(np.flatnonzero(fresh), len(x)))
    most = np.zeros(total)
    np.maximum.at(most, o[fresh], runs)
    twice = np.zeros(len(h), bool)
    twice[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    capital = kind[start] == 1
    shape = [count / PASSAGE, mean / 10, spread / 10, np.bincount(o[fresh], minlength=total) / some, most / some, np.bincount(of, twice, total) / some, np.bincount(of, capital, total) / some, np.log1p(np.repeat(n_words if of_words is None else np.array([of_words]), per_doc)) / 10]
    out[:, CLASSES**2 + BUCKETS :] = np.stack(shape, 1)
    return out, first


def _word_starts(raw: np.ndarray, before: bool) -> np.ndarray:
    """Places where a word begins; ``before``: the byte before the first one belongs to a word."""
    solid = _SOLID[raw]
    return np.flatnonzero(solid & ~np.concatenate([[before], solid[:-1]]))


def encode_long(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Features of one text's passages as encode gives them, in parts of whole passages and about SLICE_BYTES."""
    total = sum(len(_word_starts(raw[i : i + SLICE_BYTES], i > 0 and bool(_SOLID[raw[i - 1]]))) for i in range(0, len(raw), SLICE_BYTES))
    at, reach = 0, SLICE_BYTES
    while at + reach < len(raw):
        begun = _word_starts(raw[at : at + reach], False)
        if len(begun) <= PASSAGE:  # words so long that no passage ends here
            reach *= 2
            continue
        cut = at + int(begun[(len(begun) - 1) // PASSAGE * PASSAGE])
        yield encode(raw[at:cut], np.array([0, cut - at]), int(_CLASS[raw[at - 1]]) if at else 3, total)[0]
        at, reach = cut, SLICE_BYTES
    yield encode(raw[at:], np.array([0, len(raw) - at]), int(_CLASS[raw[at - 1]]) if at else 3, total)[0]


def scores_of(texts: pa.Array, model: AttentionModel) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, scores) of consecutive slices of a string column."""
    rounded = lambda x: x.astype(np.float16).astype(np.float32)  # noqa: E731  as the model was fitted
    for at, raw, offsets in slices(texts):
        if len(raw) <= SLICE_BYTES:
            x, first = encode(raw, offsets)
            yield at, model.forward(rounded(x), first)["s"]
        else:
            seen = [model.attended(rounded(x)) for x in encode_long(raw)]
            h, e = (np.concatenate(c) for c in zip(*seen, strict=True))
            yield at, model.pooled(h, e, np.array([0, len(e)]))[2]


class AttentionModel:
    """Parameters, forward pass and training."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        draw = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        zeros = lambda n: np.zeros(n, np.float32)
        self.p = {"w": draw(FEATURES, HIDDEN), "b": zeros(HIDDEN), "v": draw(HIDDEN, GATE), "vb": zeros(GATE), "u": draw(HIDDEN, GATE), "ub": zeros(GATE), "a": draw(GATE, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "d": zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)

    def _layers(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scaled features, encodings, both branches of the gate and the attention logit of each passage."""
        p = self.p
        x = np.clip((x - self.mean) * self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"] + p["vb"]), 1 / (1 + np.exp(-(h @ p["u"] + p["ub"])))
        return x, h, t, g, (t * g) @ p["a"]

    def attended(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoding and attention logit of each passage, all that a document's score needs of it."""
        _, h, _, _, e = self._layers(x)
        return h, e

    def pooled(self, h: np.ndarray, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Attention weights, documents' representations and scores."""
        at, n = first[:-1], np.diff(first)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        alpha = e / np.repeat(np.add.reduceat(e, at), n)
        z = np.add.reduceat(alpha[:, None] * h, at, axis=0)
        return alpha, z, 1 / (1 + np.exp(-np.clip(z @ self.p["c"] + self.p["d"], -30, 30)))

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        x, h, t, g, e = self._layers(x)
        alpha, z, s = self.pooled(h, e, first)
        return {"x": x, "h": h, "t": t, "g": g, "alpha": alpha, "z": z, "s": s}

    def gradients(self, f: dict[str, np.ndarray], first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n, at = self.p, np.diff(first), first[:-1]
        ds = (f["s"] - y) / len(y)
        dz = np.repeat(ds[:, None] * p["c"], n, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["alpha"] * (da - np.repeat(np.add.reduceat(f["alpha"] * da, at), n))
        dt, dg = de[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["alpha"][:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - f["h"] ** 2)
        return {"w": f["x"].T @ dh, "b": dh.sum(0), "v": f["h"].T @ dt, "vb": dt.sum(0), "u": f["h"].T @ dg, "ub": dg.sum(0), "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ ds, "d": np.array([ds.sum()])}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> AttentionModel:
        if not len(bags):
            self.p = {k: np.zeros_like(v) for k, v in self.p.items()}
            return self
        total, sums, squares = 0, np.zeros(FEATURES), np.zeros(FEATURES)
        for bag in bags:
            wide = bag.astype(np.float64)
            total, sums, squares = total + len(bag), sums + wide.sum(0), squares + (wide * wide).sum(0)
        spread = np.sqrt(np.maximum(squares / total - (sums / total) ** 2, 0))
        self.mean, self.scale = (sums / total).astype(np.float32), (1 / np.maximum(spread, 0.02)).astype(np.float32)
        share = float(np.clip(labels.mean(), 0.01, 0.99))
        self.p["d"][:] = np.log(share / (1 - share))
        r, step = np.random.default_rng(seed), 0
        m, v = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}
        for epoch in range(epochs):
            rate = RATE * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs))
            order = r.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                mine, step = order[i : i + BATCH], step + 1
                first = np.concatenate([[0], np.cumsum([len(bags[j]) for j in mine])])
                grads = self.gradients(self.forward(np.concatenate([bags[j] for j in mine]).astype(np.float32), first), first, labels[mine])
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8) + DECAY * self.p[k])).astype(np.float32)
        return self


def _encode(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """label_id, quality and bag; of a text of more than ``most`` passages, that many, spread evenly."""

    def spread(bag: np.ndarray) -> bytes:
        return (bag if len(bag) <= most else bag[np.arange(most) * len(bag) // most]).astype(np.float16).tobytes()

    for batch in batches:
        for at, raw, offsets in slices(batch.column(2)):
            if len(raw) <= SLICE_BYTES:
                x, first = encode(raw, offsets)
                bags = [spread(x[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            else:
                bags = [spread(np.concatenate([x.astype(np.float16) for x in encode_long(raw)]))]
            n = len(bags)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(bags, pa.binary())], ["label_id", "quality", "bag"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, passages: int = FIT_PASSAGES) -> AttentionModel:
    """A model fitted on ``sample`` labelled rows at most, none of them held out, and ``passages`` passages of each.

    Of documents that share a labelled id one is read, that of the least text,
    so what comes to the driver is bounded by the two parameters.
    """
    spark = docs.sparkSession
    learn = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    learn = learn.withColumn("key", F.xxhash64("doc_id")).orderBy("key", "doc_id", "quality").limit(sample).select(F.col("doc_id").alias("label_id"), "quality").toArrow()
    if not len(learn):
        return AttentionModel().fit([], np.zeros(0))
    kind = labels.schema["doc_id"].dataType.simpleString()
    chosen = F.broadcast(spark.createDataFrame(learn, f"label_id {kind}, quality int"))
    texts = docs.join(chosen, F.col("doc_id") == F.col("label_id")).groupBy("label_id", "quality").agg(F.min("text").alias("text"))
    rows = texts.mapInArrow(partial(_encode, most=passages), f"label_id {kind}, quality int, bag binary").collect()
    rows.sort(key=lambda r: (r["label_id"], r["quality"]))
    bags = [np.frombuffer(r["bag"], np.float16).reshape(-1, FEATURES) for r in rows]
    return AttentionModel().fit(bags, np.array([r["quality"] for r in rows], np.float32))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = [s for _, s in scores_of(batch.column(1), model.value)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(s).astype(np.float64) if s else np.zeros(0))], ["doc_id", "score"])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality. Labels that are
    null or other than 0 and 1 are passed over. Null and empty texts are scored
    as a bag of one empty passage; a long text is encoded in parts, so memory
    doesn't grow with it but for 132 bytes a passage; null ids stay and aren't
    held out; repeated rows get equal scores; other columns are ignored. Without
    any label to learn from every score is 0.5; an empty table gives an empty
    result.
    """
    rows = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, sample))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = small_batches(rows).mapInArrow(partial(_score, model=model), f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns, without a shuffle.

    Each row is judged by its own text, so null and repeated ids make no
    difference; null and empty texts are judged as quality_scores says, and an
    empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.select("doc_id", "text"), labels, sample))
    return compact(small_batches(docs).mapInArrow(partial(_accept, model=model, threshold=threshold, column=docs.columns.index("text")), docs.schema))


def _accept(batches: Iterator[pa.RecordBatch], model, threshold: float, column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, s in scores_of(batch.column(column), model.value):
            yield batch.slice(at, len(s)).filter(pa.array(s >= threshold))
