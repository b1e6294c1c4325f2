"""Mixing sources to target weights by the cube method.

A source's target over its size says how often its documents are taken on
average; the whole part of that is taken of all, the fraction is the inclusion
probability of one more copy. The cube method draws these copies: the
probabilities move along the null space of two constraints (documents and
words), so that both totals stay what they were while one probability after
another becomes 0 or 1. Each step looks at three undecided documents, and the
undecided ones that a task is left with, two a source at most, go through the
same steps with those of other tasks. The last two of a source are rounded to
the combination that comes nearest to the target.

Targets fill up by weight: a source's is its weight times a level that all
share, or its limit if that is less. The level is raised step by step, each an
aggregate over the sources' table, to where the targets add up; no source is
gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm._hash import fresh
from attesta.session import Stage, compact, numbered, small_batches, with_row_keys

#: Of the sources in order, null last.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words to take, as a share of all words, and the most copies of a document.
SHARE, MOST = 1.5, 2.0
#: Documents that one task moves at the first level.
TASK_ROWS = 50_000
#: Tasks whose undecided documents one task of the next level takes.
FAN_IN = 1000
#: Sources up to which the table of targets is broadcast; a longer one is joined by shuffle.
BROADCAST_SOURCES = 10_000
#: Takes, as rows of _TAKE_BYTES, that are broadcast at once.
TAKE_BYTES, _TAKE_BYTES = 64 << 20, 40
_EPS = 1e-9


def targets(sources: DataFrame, stage: Stage, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds target: words to take of each source (source, size), by weight, but no more than ``most`` times its size; what is over goes to the others by weight.

    Weights go round by the sources' order, null last.
    """
    placed = numbered(stage, sources, [F.col("source").isNull(), F.col("source")], "rank", "placed")
    placed = placed.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))).drop("rank")
    limit, level = F.col("size") * float(most), 0.0
    some = F.col("size") > 0
    while True:
        full = some & (F.col("weight") * level >= limit)
        got = placed.agg(F.sum("size").alias("all"), F.sum(F.when(full, limit)).alias("held"), F.sum(F.when(some & ~full, F.col("weight"))).alias("free")).collect()[0]
        if not got["free"]:
            break
        raised = (share * got["all"] - (got["held"] or 0.0)) / got["free"]
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return placed.withColumn("target", F.when(some, F.least(F.col("weight") * level, limit)).otherwise(0.0)).drop("weight")


class Flight:
    """The flight phase over a stream of units; no more than three are held undecided.

    A unit is (size, probability, seed, payload). Decided units go to ``out``
    as (payload, 0 or 1).
    """

    def __init__(self, out):
        self.out, self.held = out, []

    def add(self, size: float, p: float, seed: int, payload) -> None:
        if p < _EPS or p > 1 - _EPS:
            self.out(payload, int(p > 0.5))
            return
        self.held.append([size, p, seed, payload])
        if len(self.held) == 3:
            self.step()

    def land(self) -> None:
        """Round what is held to the combination whose words, then documents, come nearest to what is expected."""
        units, self.held = self.held, []
        words, count = sum(u[0] * u[1] for u in units), sum(u[1] for u in units)
        chosen = lambda m: [u for i, u in enumerate(units) if m >> i & 1]
        best = min(range(1 << len(units)), key=lambda m: (abs(sum(u[0] for u in chosen(m)) - words), abs(len(chosen(m)) - count), m))
        for i, u in enumerate(units):
            self.out(u[3], best >> i & 1)

    def step(self) -> None:
        """Move along the vector that changes neither the sum of probabilities nor that of probability times size."""
        (a, p, i, _), (b, q, j, _), (c, r, k, _) = self.held
        u = (c - b, a - c, b - a)
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = min((1 - x if d > 0 else x) / abs(d) for x, d in zip((p, q, r), u, strict=True) if d)
        down = min((x if d > 0 else 1 - x) / abs(d) for x, d in zip((p, q, r), u, strict=True) if d)
        move = up if _uniform(3 * i + 5 * j + 7 * k) < down / (up + down) else -down
        still = []
        for unit, d in zip(self.held, u, strict=True):
            unit[1] += move * d
            if unit[1] < _EPS or unit[1] > 1 - _EPS:
                self.out(unit[3], int(unit[1] > 0.5))
            else:
                still.append(unit)
        self.held = still


def _uniform(seed: int) -> float:
    x = (seed ^ 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 33) * 0xC4CEB9FE1A85EC53 & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 33) / 2**64


_COLUMNS = ["doc_id", "size", "source", "source_size", "target", "base", "p", "seed", "row_key"]


def _fly(batches: Iterator[pa.RecordBatch], last: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by source: sets ``extra`` where it gets decided, ``p`` where it doesn't. ``last``: rounds what is left of each source."""
    done: list[tuple] = []
    flight, source, began = Flight(lambda row, x: done.append((*row, x))), None, False

    def leave() -> None:
        if last:
            flight.land()
        for unit in flight.held:
            done.append((*unit[3][:6], unit[1], *unit[3][7:], -1))
        flight.held = []

    def packed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
        done.clear()
        return batch

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if began and row[2] != source:
                leave()
            source, began = row[2], True
            flight.add(float(row[1]), row[6], row[7], row)
        if done:
            yield packed()
    leave()
    if done:
        yield packed()


def sizes_of(text) -> F.Column:
    """Words: maximal runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words) of every document, and its ``key`` as row_key, if one is given.

    Draws depend on ids and texts alone, so reruns agree. Null ids stay; rows of
    a null source are a source of their own, last in order; documents without
    words are drawn but take nothing; repeated rows are drawn each; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "mix")
    held = F.lit(None).cast("int") if key is None else key
    rows = stage.keep(docs.select(F.col(id_col).alias("doc_id"), sizes_of(F.col(text_col)).alias("size"), F.col(source_col).alias("source"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("seed"), held.alias("row_key")))
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), stage, weights, share, most)
    often = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    plan = sources.select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target", F.floor(often).cast("int").alias("base"), (often - F.floor(often)).alias("p"), "n")
    plan = stage.keep(plan)
    count, documents = plan.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).collect()[0]
    plan = plan.drop("n")
    units = rows.join(F.broadcast(plan) if count <= BROADCAST_SOURCES else plan, F.col("source").eqNullSafe(F.col("of"))).select(*_COLUMNS)
    schema = T.StructType([*units.schema.fields, T.StructField("extra", T.IntegerType())])
    arrow = _arrow(schema)
    tasks = max(1, -(-documents // TASK_ROWS))
    order = ("source", "seed", "doc_id", "size")
    fly = lambda df, last: small_batches(df.sortWithinPartitions(*order)).mapInArrow(partial(_fly, last=last, schema=arrow), schema)
    table = stage.put(compact(fly(units.repartition(tasks, "seed"), False)), "level0")
    parts, level = [table.where("extra >= 0")], 0
    while tasks > FAN_IN:
        tasks, level = -(-tasks // FAN_IN), level + 1
        table = stage.put(compact(fly(table.where("extra < 0").select(*_COLUMNS).repartition(tasks, "seed"), False)), f"level{level}")
        parts.append(table.where("extra >= 0"))
    parts.append(stage.put(compact(fly(table.where("extra < 0").select(*_COLUMNS).repartition("source"), True), 0.25), "landing"))
    stage.close(*(f"level{i}" for i in range(level + 1)), "landing")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    copies = (F.col("base") + F.col("extra")).cast("long")
    columns = ["doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")]
    return out.select(*columns, *(["row_key"] if key is not None else []))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def mixed_documents(docs: DataFrame, limit: int = TAKE_BYTES, **kwargs) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    Rows are told apart by file and place, not by id, so null and repeated ids
    and repeated rows each have their own count; documents that aren't a table
    of files are written as one first. See mix for nulls and empty tables.

    What is taken meets the table by file and place, broadcast in passes of
    ``limit`` bytes that each read files of their own: no text is shuffled. A pass
    of more than twice as many joins by shuffle.
    """
    stage = Stage(docs.sparkSession, "mixed")
    docs, key = with_row_keys(stage, docs)
    file, row, count = (fresh(n, docs.columns) for n in ("mixed_file", "mixed_row", "mixed_copies"))
    plan = mix(docs, key=key, **kwargs).where("copies > 0").select(F.col("row_key.file").alias(file), F.col("row_key.row").alias(row), F.col("copies").cast("int").alias(count))
    plan = stage.put(compact(plan, 0.25), "takes")
    passes = max(1, -(-plan.count() * _TAKE_BYTES // limit))
    share = F.pmod(file, F.lit(passes))
    sizes = {r[0]: r[1] * _TAKE_BYTES for r in plan.groupBy(share).count().collect()} if passes > 1 else {}
    placed, joined = docs.withColumns({file: key["file"], row: key["row"]}), None
    for i in range(passes):
        some = plan.where(share == i)
        part = placed.where(share == i).join(F.broadcast(some) if sizes.get(i, 0) <= 2 * limit else some, [file, row])
        joined = part if joined is None else joined.unionByName(part)
    copies = F.explode(F.sequence(F.lit(1), F.col(count)))
    return compact(joined.select(*docs.columns, copies.alias(fresh("mixed_copy", docs.columns))).drop(fresh("mixed_copy", docs.columns)))
