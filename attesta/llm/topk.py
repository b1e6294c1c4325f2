"""Exact top-k by inner product: MaxScore over shards of vectors.

Each dimension is a term; what it can add to a score lies between the least and
the greatest product of the query's and the shard's components. Terms are
ordered by that range. With the k-th best score so far as the threshold, the
terms of smallest range whose greatest contributions, together with the others'
least, stay below it are non-essential. The essential terms are traversed for
all vectors of a block; the others are probed, widest first, only for vectors
that can still reach the threshold, and those that survive have their exact
score. Shards' lists are merged by rank.

Queries are broadcast a bounded block at a time. One row in FIRST is searched
before all others: the k-th best score there is a bound that no better list falls
below, and it goes along with the query to every shard, which starts with it and
hands on only what reaches it: about k x FIRST rows a query, however many shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.session import Stage, compact, small_batches, with_row_keys

K, SCALE, EVERY = 10, 1024, 100
#: Vectors of one shard and of one block of a shard; components of the queries that are broadcast at once.
SHARD, DOCS, QUERY_CELLS = 200_000, 2048, 8 << 20
#: One row in so many is searched first.
FIRST = 32
#: Non-essential terms probed before the survivors are looked at again.
PROBE = 8


def integers(lists: pa.ListArray) -> np.ndarray:
    """floor(SCALE * x) as doubles, a row for each vector; shorter vectors end in zeros."""
    n = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(n), int(n.max()) if len(n) else 0))
    rows = np.repeat(np.arange(len(n)), n)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = np.floor(SCALE * flat)
    return out


def _fit(x: np.ndarray, d: int) -> np.ndarray:
    return x if x.shape[1] == d else np.pad(x, ((0, 0), (0, d - x.shape[1])))


class Shard:
    """Vectors by dimension, in blocks, with each dimension's least and greatest component."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rows: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, x, self.rows = ids[order], x[order], (np.arange(len(ids)) if rows is None else rows)[order]
        self.low, self.high, self.top = x.min(0), x.max(0), float(np.abs(x).max(initial=0))
        self.blocks = [(i, np.ascontiguousarray(x[i : i + DOCS].T)) for i in range(0, len(x), DOCS)]

    def search(self, query_id: int, q: np.ndarray, k: int, row: int | None = None, bound: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best vectors but the query's own, ties to the smaller id; only of those that reach ``bound``.

        The query's own is that of its id and ``row``, of all that have its id if no row is given.
        """
        if self.top * float(np.abs(q).max(initial=0)) * max(len(q), 1) >= 2.0**53:
            return self._exact(query_id, q, k, row, bound)
        a, b = q * self.low, q * self.high
        least, most = np.minimum(a, b), np.maximum(a, b)
        terms = np.argsort(-(most - least), kind="stable")
        after = np.concatenate([np.cumsum(most[terms][::-1])[::-1], [0.0]])  # greatest sum of the terms from here on
        floor = np.concatenate([[0.0], np.cumsum(least[terms])])  # least sum of the terms before
        ids, scores, threshold = np.zeros(0, np.int64), np.zeros(0), bound
        for at, block in self.blocks:
            here = np.arange(block.shape[1])
            essential = len(terms) if threshold == -np.inf else int(np.argmax(floor + after < threshold)) if (floor + after < threshold).any() else len(terms)
            part = q[terms[:essential]] @ block[terms[:essential]]
            done = essential
            while True:
                alive = part + after[done] >= threshold
                here, part = here[alive], part[alive]
                if done == len(terms) or not len(here):
                    break
                more = terms[done : done + PROBE]
                part = part + q[more] @ block[np.ix_(more, here)]
                done += len(more)
            mine = self.ids[at + here]
            other = mine != query_id
            if row is not None:
                other |= self.rows[at + here] != row
            ids, scores = np.concatenate([ids, mine[other]]), np.concatenate([scores, part[other]])
            if len(ids) > k:
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                threshold = max(bound, scores.min())
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best].astype(np.int64)

    def _exact(self, query_id: int, q: np.ndarray, k: int, row: int | None, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Components too large for doubles: whole scores in Python's integers, held at the limits of 64 bits."""
        mine = [int(v) for v in q]
        found = []
        for at, block in self.blocks:
            for j, column in enumerate(block.T.tolist()):
                if self.ids[at + j] != query_id or row is not None and self.rows[at + j] != row:
                    found.append((-sum(m * int(v) for m, v in zip(mine, column, strict=True)), int(self.ids[at + j])))
        found = sorted(found)[:k]
        held = [(max(-(2**63), min(2**63 - 1, -s)), i) for s, i in found]
        held = [(s, i) for s, i in held if s >= bound]
        return np.array([i for _, i in held], np.int64), np.array([s for s, _ in held], np.int64)


def _search(batches: Iterator[pa.RecordBatch], queries, k: int) -> Iterator[pa.RecordBatch]:
    """The best of each shard for every query of the broadcast block: ids, rows, vectors and bounds."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        d = max(x.shape[1] for _, x, _ in held)
        shard = Shard(np.concatenate([h[0] for h in held]), np.concatenate([_fit(h[1], d) for h in held]), np.concatenate([h[2] for h in held]))
        held.clear()
        ids, rows, q, bounds = queries.value
        q = _fit(q, d) if q.shape[1] <= d else q[:, :d]
        for first in range(0, len(ids), 1024):
            out = []
            for query_id, row, v, bound in zip(*(x[first : first + 1024] for x in (ids.tolist(), rows.tolist(), q, bounds.tolist())), strict=True):
                found, score = shard.search(query_id, v, k, row, bound)
                out.append((np.full(len(found), query_id, np.int64), np.full(len(found), row, np.int64), found, score))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "query_row", "vec_id", "score"])

    rows = 0
    for batch in batches:
        if len(batch):
            held.append((batch.column(0).to_numpy(), integers(batch.column(1)), batch.column(2).to_numpy()))
            rows += len(batch)
        if rows >= SHARD:
            yield from flush()
            rows = 0
    if held:
        yield from flush()


def _block(queries: DataFrame) -> tuple[np.ndarray, ...]:
    """Ids, rows, integer vectors and bounds, as yet none, of a block of queries."""
    rows = queries.toArrow()
    ids, places = rows.column("vec_id").to_numpy(), rows.column("row").to_numpy()
    return ids, places, integers(pa.concat_arrays(rows.column("embedding").chunks) if len(ids) else pa.array([], pa.list_(pa.float64()))), np.full(len(ids), -np.inf)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _one_in(rows: DataFrame, n: int, pick: Column) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64("row"), F.lit(n)) == pick)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k vectors of greatest inner product for each query.

    Queries are the rows whose id ``every`` divides, each for itself; candidates
    are all rows but the query's own, those that share its id included. Rows are
    told apart by file and place. Components are floor(1024 x), scores integers,
    ties go to the smaller id. Null vectors, vectors with a null or non-finite
    component and rows of a null id take no part; missing dimensions count as 0
    and an empty vector scores 0. Scores beyond 64 bits are held at the limit.
    Other columns are ignored; an empty table gives an empty result.
    """
    stage = Stage(vectors.sparkSession, "topk")
    vectors, key = with_row_keys(stage, vectors)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.xxhash64(key).alias("row"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    queries = stage.put(compact(rows.where(F.col("vec_id") % every == 0)), "queries")
    cells = queries.agg(F.sum(F.size("embedding") + 4)).first()[0] or 0
    passes = -(-cells // QUERY_CELLS)
    kind, spark, done = "query_id long, query_row long, vec_id long, score long", vectors.sparkSession, []
    for i in range(passes):
        block = _block(_one_in(queries, passes, F.lit(i)))
        if not len(block[0]):
            continue
        first = small_batches(_one_in(rows, FIRST, F.lit(0))).mapInArrow(partial(_search, queries=spark.sparkContext.broadcast(block), k=k), kind)
        bounds = _best(first, k).where(F.col("rank") == k).select("query_id", "query_row", F.col("score").alias("bound"))
        known = {(r["query_id"], r["query_row"]): float(r["bound"]) for r in bounds.collect()}  # a row a query of the block
        held = np.array([known.get(x, -np.inf) for x in zip(block[0].tolist(), block[1].tolist(), strict=True)])
        found = small_batches(rows).mapInArrow(partial(_search, queries=spark.sparkContext.broadcast((*block[:3], held)), k=k), kind)
        done.append(stage.put(compact(_best(found, k)).select("query_id", "rank", "vec_id", "score"), f"best-{i}"))
    if not done:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    stage.drop("queries")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
