"""Exact token counts by a two-tier look-up on the map side.

The first tier is a compact hash table of the most frequent pre-tokens' lengths,
broadcast to all tasks; its size is fixed by FREQUENT. It comes from a pass over
the whole corpus in which each task keeps a bounded frequency summary
(Misra-Gries: what occurs in more than 1/FREQUENT of a task's pre-tokens stays);
only these summaries are merged, so no pre-token is shuffled. The second tier is
a cache in each worker for the misses, which the library's model encodes. Either
tier only saves work: every count is the library's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import _bpe
from attesta.llm._hash import mix, token_parts
from attesta.session import Stage, small_batches

#: Pre-tokens in the broadcast table.
FREQUENT = 8192
#: Summaries that one task merges.
FAN_IN = 32

_loaded: dict[tuple[str, bool], _bpe.Tokenizer] = {}


class Counter(_bpe.Tokenizer):
    """A tokenizer whose table starts with the frequent pre-tokens."""

    tier: tuple[np.ndarray, ...] | None = None

    def warm(self) -> None:
        if self.tier is not None:
            k1, k2, size, n = self.tier
            value = np.arange(self.values, self.values + len(n), dtype=np.int32)
            self._add([range(x) for x in n.tolist()])
            self._put(mix(k1 + mix(k2 + size.astype(np.uint64))), k1, k2, size, value)


def loaded(path: str, ids: bool) -> _bpe.Tokenizer:
    """The worker's tokenizer, kept from task to task."""
    if (path, ids) not in _loaded:
        _loaded[path, ids] = (_bpe.Tokenizer if ids else Counter)(path, ids=ids)
    return _loaded[path, ids]


def _keys(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start, size, _ = _bpe.pieces(raw, offsets)
    keep = size <= _bpe.KEY_BYTES
    start, size = start[keep], size[keep]
    padded = np.concatenate([raw, np.zeros(_bpe.KEY_BYTES, np.uint8)])
    view = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
    k1 = view[start] & _bpe._MASKS[np.minimum(size, 8)]
    k2 = view[np.minimum(start + 8, len(raw))] & np.where(size > 8, _bpe._MASKS[np.maximum(size - 8, 0)], np.uint64(0))
    return k1, k2, size.astype(np.uint8)


def _summed(parts: list[tuple[np.ndarray, ...]], keep: int) -> tuple[np.ndarray, ...]:
    """Counts of equal keys added; if more than ``keep`` keys are there, the next count is taken off all."""
    k1, k2, size, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((size, k2, k1))
    k1, k2, size, n = k1[order], k2[order], size[order], n[order]
    if not len(n):
        return k1, k2, size, n
    new = np.ones(len(n), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (size[1:] != size[:-1])
    at = np.flatnonzero(new)
    k1, k2, size, n = k1[at], k2[at], size[at], np.add.reduceat(n, at)
    if len(n) > keep:
        n = n - np.partition(n, -keep - 1)[-keep - 1]
        at = np.flatnonzero(n > 0)
        k1, k2, size, n = k1[at], k2[at], size[at], n[at]
    return k1, k2, size, n


_NONE = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64))
_SUMMARY = "k1 binary, k2 binary, size binary, n binary"


def _row(summary: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in summary], ["k1", "k2", "size", "n"])


def _read(row: dict) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(row[c], t) for c, t in (("k1", np.uint64), ("k2", np.uint64), ("size", np.uint8), ("n", np.int64)))


def _summarise(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    held, waiting = _NONE, []
    for batch in batches:
        for _, raw, offsets, _ in token_parts(batch.column(0)):
            k1, k2, size = _keys(raw, offsets)
            h = mix(k1 + mix(k2 + size.astype(np.uint64)))
            _, at, n = np.unique(h, return_index=True, return_counts=True)
            waiting.append((k1[at], k2[at], size[at], n.astype(np.int64)))
            if len(waiting) >= 8:
                held, waiting = _summed([held, *waiting], keep), []
    yield _row(_summed([held, *waiting], keep))


def _merge(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    held = _NONE
    for batch in batches:
        for row in batch.to_pylist():
            held = _summed([held, _read(row)], keep)
    yield _row(held)


def frequent_lengths(docs: DataFrame, path: str, frequent: int = FREQUENT, text_col: str = "text") -> tuple[np.ndarray, ...]:
    """Keys and token counts of the most frequent pre-tokens of the whole corpus, ``frequent`` at most."""
    spark = docs.sparkSession
    stage = Stage(spark, "frequent")
    level = stage.put(small_batches(docs.select(text_col)).mapInArrow(partial(_summarise, keep=frequent), _SUMMARY), "0")
    rows, depth = level.count(), 0
    while rows > FAN_IN:
        rows, depth = -(-rows // FAN_IN), depth + 1
        level = stage.put(level.repartition(rows).mapInArrow(partial(_merge, keep=frequent), _SUMMARY), str(depth))
    k1, k2, size, _ = _summed([_NONE, *(_read(r.asDict()) for r in level.collect())], frequent)
    stage.drop("")
    text = np.stack([k1, k2], 1).astype("<u8").tobytes()
    counts = [len(x) for x in _bpe.Tokenizer(path, slots=1 << 10).pretokens([text[16 * i : 16 * i + n] for i, n in enumerate(size.tolist())])]
    return k1, k2, size, np.array(counts, np.int32)


def _count(batches: Iterator[pa.RecordBatch], path: str, tier) -> Iterator[pa.RecordBatch]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
    else:
        model = loaded(path, False)
        if model.tier is None and tier is not None:
            model.tier = tier.value
            model._empty()
            model.warm()
    cut = not path.endswith(".model") and model.cuts
    for batch in batches:
        n_bytes, n_tokens = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        for at, raw, offsets, _ in token_parts(batch.column(1), cut):
            rows = slice(at, at + len(offsets) - 1)
            n_bytes[rows] += np.diff(offsets)
            if path.endswith(".model"):
                text = raw.tobytes()
                n_tokens[rows] += [len(x) for x in model.encode([text[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], num_threads=1)]
            else:
                n_tokens[rows] += model.run(raw, offsets)[1]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes), pa.array(n_tokens)], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, limit: int = 1024, frequent: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every text, as the file's library counts.

    ``path`` is a .json file for tokenizers or a .model file for sentencepiece;
    no begin, end or other special token is added, special strings inside texts
    count as the library has it by default, nothing is truncated. Null and empty
    texts have 0 bytes and 0 tokens; a null id stays; repeated rows are counted
    each; other columns are ignored; an empty table gives an empty result. A very
    long text is encoded in parts that pre-tokenisation cuts anyway, where the
    file allows it.
    """
    tier = None
    spark: SparkSession = docs.sparkSession
    if path.endswith(".json") and _bpe.Tokenizer(path, slots=1 << 10).plain:
        tier = spark.sparkContext.broadcast(frequent_lengths(docs, path, frequent, text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    counted = small_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(partial(_count, path=path, tier=tier), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
