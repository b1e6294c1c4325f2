"""How text filters interact: what each removes alone, in every order, and on the average of all orders.

Four filters look at a text alone; the fifth removes exact copies of a smaller
id's text. For it texts are routed by fingerprint (xxhash) to the partitions of
an RDD. A partition holds, for each fingerprint, a chain of the full texts that
have it, each with the smallest id so far, and emits the ids that aren't the
smallest. Tasks first do the same with what they read themselves, so that of any
number of copies each task sends one. Partitions are as many as texts of
CHAIN_BYTES make, so a chain table is bounded whatever the corpus.

What a document fails is a mask of five bits. combineByKey adds up masks to one
vector of 32 counts a part, and all orders follow from these vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import permutations
from math import factorial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm._hash import SLICE_BYTES, windows
from attesta.session import Stage, small_batches

FILTERS = "ABCDE"
#: Least words; least distinct words in a hundred; most capitals in a hundred characters; characters of no prose.
WORDS, DISTINCT, CAPITALS, SIGNS = 100, 80, 10, b"#$%&*|"
COPY = 1 << FILTERS.index("E")
#: Bytes of texts in the chains of a partition, on the average, and of what a task holds before it sends it on.
CHAIN_BYTES, HELD_BYTES = 32 << 20, 32 << 20
_UPPER = bytes(range(0x41, 0x5B))
_MASKS = np.arange(1 << len(FILTERS))
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failing(text: str, raw: bytes) -> int:
    """Mask of the filters A to D that a text fails. Words are maximal runs of bytes other than ASCII white space."""
    n, distinct = 0, set()
    for part in [raw] if len(raw) <= SLICE_BYTES else (x.tobytes() for x in windows(np.frombuffer(raw, np.uint8))):
        words = part.split()
        n += len(words)
        distinct.update(words)
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    signs = len(raw) != len(raw.translate(None, SIGNS))
    return (n < WORDS) | (100 * len(distinct) < DISTINCT * n) << 1 | (100 * capitals > CAPITALS * len(text)) << 2 | signs << 3


class Chains:
    """Texts by fingerprint: a chain of [text, mask, smallest id, rows of that id by part] for each."""

    def __init__(self):
        self.by_print: dict[int, list[list]] = {}
        self.held = 0

    def add(self, key: int, raw: bytes, mask: int, doc_id, parts: dict[str, int]) -> Iterator[tuple]:
        """Take rows of one text and id; gives (id, part, mask, rows) of those that aren't the smallest id's."""
        chain = self.by_print.setdefault(key, [])
        for entry in chain:
            if entry[0] == raw:
                break
        else:
            chain.append([raw, mask, doc_id, dict(parts)])
            self.held += len(raw) + 200
            return
        if doc_id < entry[2]:
            entry[2], doc_id, entry[3], parts = doc_id, entry[2], dict(parts), entry[3]
        elif doc_id == entry[2]:
            for part, n in parts.items():
                entry[3][part] = entry[3].get(part, 0) + n
            return
        for part, n in parts.items():
            yield doc_id, part, mask | COPY, n

    def taken(self) -> Iterator[tuple[int, list]]:
        """Fingerprint and entry of everything that is held, which is given up."""
        while self.by_print:
            key, chain = self.by_print.popitem()
            for entry in chain:
                yield key, entry
        self.held = 0


def _route(rows: Iterator[tuple], held_bytes: int) -> Iterator[tuple[int, tuple]]:
    """Fingerprint and text of the smallest ids that a task has read; settled rows under a hash of their id."""
    from xxhash import xxh64_intdigest

    chains = Chains()
    for doc_id, part, text in rows:
        raw = text.encode()
        mask = failing(text, raw)
        if doc_id is None:
            yield xxh64_intdigest(part), (None, part, mask, 1)
            continue
        for settled in chains.add(xxh64_intdigest(raw), raw, mask, doc_id, {part: 1}):
            yield xxh64_intdigest(str(settled[0])), settled
        if chains.held > held_bytes:
            yield from chains.taken()
    yield from chains.taken()


def _settle(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple]:
    """(id, part, mask, rows) of all rows of a partition."""
    chains = Chains()
    for key, value in rows:
        if isinstance(value, tuple):
            yield value
        else:
            yield from chains.add(key, *value)
    for _, (_, mask, doc_id, parts) in chains.taken():
        for part, n in parts.items():
            yield doc_id, part, mask, n


def verdicts(docs: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text", chain_bytes: int = CHAIN_BYTES, held_bytes: int = HELD_BYTES) -> DataFrame:
    """doc_id, part, mask and n: how many rows of an id and part fail which filters.

    Null texts and parts are empty ones. A row without id is a copy of nothing
    and nothing of it. Rows that repeat an id and its text are no copies of each
    other. Other columns are left out, so their names can't clash; an empty table
    gives an empty result.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(text_col, F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // chain_bytes))
    routed = small_batches(rows).rdd.mapPartitions(partial(_route, held_bytes=held_bytes)).partitionBy(n, partitionFunc=int)
    return spark.createDataFrame(routed.mapPartitions(_settle), f"doc_id {kind}, part string, mask int, n long")


def _vector(row: tuple) -> np.ndarray:
    return _with_row(np.zeros((3, len(_MASKS)), np.int64), row)


def _with_row(vector: np.ndarray, row: tuple) -> np.ndarray:
    mask, n, good, toxic = row
    vector[:, mask] += (n, n * good, n * toxic)
    return vector


def _orders(part: str, vector: np.ndarray) -> Iterator[tuple]:
    """A row for each step of each order of the filters."""
    every, good, toxic = vector
    size = sum(_MASKS >> i & 1 for i in range(len(FILTERS)))
    shared = factorial(len(FILTERS)) // np.maximum(size, 1)  # orders in which a filter is the first of those that a mask fails
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            fails, free = (_MASKS >> i & 1) == 1, (_MASKS & before) == 0
            here = fails & free
            before |= 1 << i
            yield (part, "".join(FILTERS[x] for x in order), step, *(int(x) for x in (
                every[(_MASKS & before) == 0].sum(), every[here].sum(), every[fails & ~free].sum(), every[1 << i], good[here].sum(), toxic[here].sum(), (every * shared)[fails].sum(),
            )))


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each part, order of the five filters and step: documents kept, removed here, failing but removed before, failing nothing else, of good and of toxic label removed here, and the filter's removals summed over all orders.

    ``labels``: doc_id, quality and toxic; of an id's several rows any that says 1
    counts, rows without id count for none. Nulls, repeats and odd columns as in
    verdicts. Verdicts are written to the shared folder before labels meet them,
    added up by id, so that neither an id of many rows nor many copies gather.
    """
    stage = Stage(docs.sparkSession, "audit")
    settled = stage.put(verdicts(docs, part, id_col, text_col), "verdicts")
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    counted = settled.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(marks, "doc_id", "left")
    rows = counted.select("part", "mask", "n", F.coalesce("good", F.lit(0)), F.coalesce("toxic", F.lit(0)))
    vectors = rows.rdd.map(lambda r: (r[0], tuple(r[1:]))).combineByKey(_vector, _with_row, np.add)
    return docs.sparkSession.createDataFrame(vectors.flatMap(lambda x: _orders(*x)), RESULT)
