"""Benchmark decontamination: SimHash windows of item size, verified exactly.

For each length that an item has, a window of that many words slides over a
document a word at a time. A window's 64-bit SimHash is the sign of the sums of
its shingles' bits, which running sums give for every position at once. Items
are found by a multi-index: a fingerprint within RADIUS bits of an item's must,
in one of four 16-bit blocks, be within a quarter of RADIUS, and the index lists
each item under all such block values. So no fingerprint within the radius is
missed, and the radius is set so that a window of the similarity asked for is
beyond it once in a thousand times. Candidates are then compared by the weighted
Jaccard similarity of their shingle bags.

Windows that hold no shingle of any item have similarity 0 with all of them and
are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import acos, comb, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm._hash import SHINGLE, shingles, word_hashes
from attesta.session import Stage, compact, small_batches

SIMILARITY = 0.8
BITS, BLOCKS = 64, 4
_WIDTH = BITS // BLOCKS
#: Share of windows of just the similarity asked for that may lie beyond the radius.
MISS = 1e-3
#: Items and bytes of item text of one index, which is about 60 MB then; a larger benchmark takes several passes, with one index at a time.
ITEMS_AT_ONCE, TEXT_AT_ONCE = 1000, 4_000_000
_CHUNK = 1 << 15


def radius_for(similarity: float, bits: int = BITS, miss: float = MISS) -> int:
    """Bits that the SimHashes of two bags of this weighted Jaccard similarity differ in, exceeded with probability ``miss``."""
    p = acos(min(1.0, 2 * similarity / (1 + similarity))) / pi
    total = 0.0
    for r in range(bits + 1):
        total += comb(bits, r) * p**r * (1 - p) ** (bits - r)
        if total >= 1 - miss:
            return r
    return bits


def known_places(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of the hashes that are among the sorted ``known``."""
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(h), _CHUNK):
        part = h[at : at + _CHUNK]
        found.append(at + np.flatnonzero(known[np.minimum(np.searchsorted(known, part), len(known) - 1)] == part))
    return np.concatenate(found)


def sums(h: np.ndarray) -> np.ndarray:
    """Running sums of the bits of shingle hashes, one row more than there are shingles."""
    out = np.zeros((len(h) + 1, BITS), np.int32)
    np.cumsum(np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1), axis=0, out=out[1:], dtype=np.int32)
    return out


def fingerprints(running: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the windows of ``width`` shingles at ``starts``."""
    return np.packbits((running[starts + width] - running[starts]) * 2 > width, axis=1).view("<u8").reshape(-1)


class ItemIndex:
    """Bags, fingerprints and block index of the items; those without words are left out."""

    def __init__(self, ids: list[int], texts: list[str | None], similarity: float = SIMILARITY, radius: int | None = None):
        self.similarity = similarity
        self.radius = radius_for(similarity) if radius is None else radius
        self.ids, self.grams, self.words, self.hashes, self.bags = [], [], [], [], []
        for at, h, firsts in word_hashes(pa.array(texts, pa.string())):
            for i in range(len(firsts) - 1):
                if n := int(firsts[i + 1] - firsts[i]):
                    grams, _ = shingles(h[firsts[i] : firsts[i + 1]], np.array([0, n]), min(n, SHINGLE))
                    self.ids.append(ids[at + i])
                    self.words.append(n)
                    self.grams.append(min(n, SHINGLE))
                    self.hashes.append(grams)
        self.prints = np.zeros(len(self.ids), np.uint64)
        for i, h in enumerate(self.hashes):
            self.prints[i] = fingerprints(sums(h), np.array([0]), len(h))[0]
            values, counts = np.unique(h, return_counts=True)
            self.bags.append(dict(zip(values.tolist(), counts.tolist(), strict=True)))
        self.words_of = np.array(self.words, np.int64)
        self.known = {g: np.unique(np.concatenate([h for h, k in zip(self.hashes, self.grams, strict=True) if k == g])) for g in sorted(set(self.grams))}
        self.lengths = {g: sorted({n for n, k in zip(self.words, self.grams, strict=True) if k == g}) for g in self.known}
        masks = np.array([m for m in range(1 << _WIDTH) if m.bit_count() <= self.radius // BLOCKS], np.uint32)
        self.lists = []
        for b in range(BLOCKS):
            value = ((self.prints >> np.uint64(_WIDTH * b)) & np.uint64((1 << _WIDTH) - 1)).astype(np.uint32)
            keys = (value[:, None] ^ masks[None, :]).reshape(-1)
            order = np.argsort(keys, kind="stable")
            at = np.searchsorted(keys[order], np.arange((1 << _WIDTH) + 1))
            self.lists.append((at, np.repeat(np.arange(len(self.ids), dtype=np.int32), len(masks))[order]))

    def near(self, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all items of ``length`` words within the radius of each fingerprint."""
        found = []
        for b, (at, items) in enumerate(self.lists):
            key = ((prints >> np.uint64(_WIDTH * b)) & np.uint64((1 << _WIDTH) - 1)).astype(np.int64)
            n = at[key + 1] - at[key]
            who = np.repeat(np.arange(len(prints)), n)
            item = items[np.repeat(at[key] - (np.cumsum(n) - n), n) + np.arange(len(who))]
            right = self.words_of[item] == length
            who, item = who[right], item[right]
            close = np.bitwise_count(prints[who] ^ self.prints[item]) <= self.radius
            found.append(who[close] * len(self.ids) + item[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.ids), pairs % len(self.ids)

    def overlap(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window's bag of shingles and an item's."""
        bag, left, both = self.bags[item], {}, 0
        for h in window.tolist():
            if h in bag:
                left[h] = left.get(h, 0) + 1
                both += left[h] <= bag[h]
        return both / (len(window) + len(self.hashes[item]) - both)

    def search(self, h: np.ndarray, gram: int) -> dict[int, tuple[float, int, int]]:
        """Item to (similarity, first shingle, shingles) of its best window; of equal ones the first. ``h``: a document's shingles."""
        hits = known_places(h, self.known[gram])
        best: dict[int, tuple[float, int, int]] = {}
        if not len(hits):
            return best
        widest = self.lengths[gram][-1] - gram + 1
        for part in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * widest) + 1):
            for begin in range(max(0, int(part[0]) - widest), int(part[-1]) + 1, _CHUNK):
                stop = min(begin + _CHUNK, int(part[-1]) + 1)
                local = h[begin : min(len(h), stop + widest)]
                running = sums(local)
                near = part[(part >= begin) & (part < stop + widest)] - begin
                for n in self.lengths[gram]:
                    width = min(n - gram + 1, len(h))
                    cover = np.zeros(stop - begin + widest + 1, np.int32)
                    np.add.at(cover, np.maximum(near - width + 1, 0), 1)
                    np.add.at(cover, near + 1, -1)
                    starts = np.flatnonzero(np.cumsum(cover)[: stop - begin] > 0)
                    starts = starts[starts + width <= len(local)]
                    if not len(starts):
                        continue
                    for w, item in zip(*(x.tolist() for x in self.near(fingerprints(running, starts, width), n)), strict=True):
                        at = int(starts[w])
                        s = self.overlap(local[at : at + width], item)
                        if s >= self.similarity and (item not in best or s > best[item][0]):
                            best[item] = (s, begin + at, width)
        return best


def _hits(column: pa.Array, index: ItemIndex) -> Iterator[tuple]:
    """Row, item, similarity, start and words of what the index finds in a column of texts."""
    for at, h, firsts in word_hashes(column):
        for gram, known in index.known.items():
            grams, first = shingles(h, firsts, gram)
            seen = known_places(grams, known)
            for doc in np.unique(np.searchsorted(first, seen, "right") - 1).tolist():
                for item, (s, start, width) in index.search(grams[first[doc] : first[doc + 1]], gram).items():
                    yield at + doc, index.ids[item], s, start, width + gram - 1


def _search(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(_hits(batch.column(1), index.value))
        if rows:
            who, item, s, start, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(who)), pa.array(item, pa.int64()), pa.array(s, pa.float64()), pa.array(start, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "item_id", "similarity", "start_word", "n_words"])


def _clean(batches: Iterator[pa.RecordBatch], index, column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stays = np.ones(batch.num_rows, bool)
        stays[[hit[0] for hit in _hits(batch.column(column), index.value)]] = False
        yield batch.filter(pa.array(stays))


def _indexes(benchmark: DataFrame, similarity: float, radius: int | None) -> Iterator[tuple[ItemIndex, bool]]:
    """Indexes of the benchmark's parts that have words, and whether each is the last."""
    ids, texts, held, ready = [], [], 0, None
    for r in benchmark.select("item_id", "text").where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).orderBy("item_id", "text").toLocalIterator():
        size = len(r["text"].encode())
        if ids and (len(ids) >= ITEMS_AT_ONCE or held + size > TEXT_AT_ONCE):
            if ready is not None:
                yield ready, False
            ready = ItemIndex(ids, texts, similarity, radius)
            ids, texts, held = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        held += size
    if ready is not None:
        yield ready, not ids
    if ids:
        yield ItemIndex(ids, texts, similarity, radius), True


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, start_word and n_words of each document and benchmark item that it holds.

    Words are split at ASCII white space and lower-cased; bags are of five-word
    shingles, of an item of fewer words its one shingle. A document shorter than
    an item is one window. Null and empty texts and items without words match
    nothing; null ids stay; repeated rows are each returned; other columns are
    ignored; an empty table on either side gives an empty result. The benchmark
    is read to the driver in parts of ITEMS_AT_ONCE items and TEXT_AT_ONCE bytes
    at most (one item, if it alone is longer). Each part but the last has its
    hits written before the next index is broadcast, so one is alive at a time.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "decontam")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, similarity double, start_word long, n_words long"
    out = spark.createDataFrame([], schema)
    for n, (index, last) in enumerate(_indexes(benchmark, similarity, radius)):
        sent = spark.sparkContext.broadcast(index)
        found = small_batches(rows).mapInArrow(partial(_search, index=sent), schema)
        if last:
            return found if n == 0 else out.unionByName(found)
        out = out.unionByName(stage.put(compact(found), f"hits-{n}"))
        sent.unpersist()
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int | None = None, text_col: str = "text") -> DataFrame:
    """The rows whose own text holds no benchmark item, whatever their ids, without a shuffle.

    Null and empty texts stay; repeated rows are each judged; all columns stay;
    an empty table on either side removes nothing. A benchmark of several parts
    (see contaminated) takes a pass for each; what is left after all but the
    last is written, so that one index is alive at a time.
    """
    spark, out = docs.sparkSession, docs
    stage = Stage(spark, "decontam")
    for n, (index, last) in enumerate(_indexes(benchmark, similarity, radius)):
        sent = spark.sparkContext.broadcast(index)
        out = small_batches(out).mapInArrow(partial(_clean, index=sent, column=docs.columns.index(text_col)), docs.schema)
        if not last:
            out = stage.put(compact(out), f"left-{n}")
            stage.drop(f"left-{n - 1}")
            sent.unpersist()
    return compact(out)
