"""Merging one field's contributions in their order, however many there are.

What is held is a value's key and its confidence. A contribution of the same key
lowers the confidence to its own if that is smaller; one of another key takes over
if its confidence is greater. Up to CHUNK contributions of a field are folded by
an expression. More are cut into chunks of consecutive ones, and a chunk's effect
is a table: what is held after it for each key that may be held before (one of the
chunk's, or any other) and each range of confidence. Tables are put one after
another to find what each chunk begins with; then all chunks are followed side by
side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators.scans import RANK
from attesta.session import Stage, numbered, small_batches

#: Contributions of a field that are folded at once.
CHUNK = 1024
CONFLICT = "struct<kept:string,existing_confidence:double,incoming_confidence:double,incoming_source_url:string,source_chunk_id:string,existing_value:string,incoming_value:string>"
#: Nothing held before, and nothing taken over: no rank is one of these.
NONE = -1


def follow(keys: np.ndarray, sure: np.ndarray, ranks: np.ndarray, key: np.ndarray, confidence: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is held after contributions (keys, sure, ranks), for each of several states held before."""
    for k, c, r in zip(keys, sure, ranks, strict=True):
        same = key == k
        take = ~same & (c > confidence)
        confidence = np.where(take, c, np.where(same, np.minimum(confidence, c), confidence))
        key, rank = np.where(take, k, key), np.where(take, r, rank)
    return key, confidence, rank


def effect(keys: np.ndarray, sure: np.ndarray, ranks: np.ndarray) -> pd.DataFrame:
    """A chunk's table: for each key held before (``other``: any that the chunk hasn't) and each confidence from ``least`` to the next one's what is held after.

    ``rank`` is NONE where nothing took over: then the key stays and its confidence
    is the smaller of the one before and ``confidence``.
    """
    known, levels = np.unique(keys), np.append(-np.inf, np.unique(sure))
    other = np.int64(0)
    while np.isin(other, known):
        other += 1
    states = np.append(known, other)
    key, before = np.repeat(states, len(levels)), np.tile(levels, len(states))
    # A confidence between two levels acts as the lower one does: no contribution lies in between.
    after, confidence, rank = follow(keys, sure, ranks, key.copy(), before.copy(), np.full(len(key), NONE - 1))
    stayed = rank == NONE - 1
    out = pd.DataFrame({"other": key == other, "key": key, "least": before, "after": after, "confidence": confidence, "rank": np.where(stayed, NONE, rank)})
    # Neighbouring levels of the same outcome are one.
    same = (out["rank"].eq(out["rank"].shift()) & out["after"].eq(out["after"].shift()) & (out["confidence"].eq(out["confidence"].shift()) | (out["rank"].eq(NONE) & out["rank"].shift().eq(NONE))) & pd.Series(key).eq(pd.Series(key).shift())).to_numpy()
    lowest = pd.Series(sure).groupby(keys).min()
    out["confidence"] = np.where(stayed, np.where(key == other, np.inf, pd.Series(key).map(lowest).fillna(np.inf)), confidence)
    return out[~same]


def _runs(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal values in sorted frames, one at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        mark = frame[columns].ne(frame[columns].shift()).any(axis=1)
        for _, part in frame.groupby(mark.cumsum(), sort=False):
            if held and tuple(held[-1][columns].iloc[0]) != tuple(part[columns].iloc[0]):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _effects(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for run in _runs(frames, ["field_id", "chunk"]):
        table = effect(run["h"].to_numpy(), run["confidence"].to_numpy(), run["rank"].to_numpy())
        yield table.assign(field_id=run["field_id"].iloc[0], chunk=run["chunk"].iloc[0])[["field_id", "chunk", "other", "key", "least", "after", "confidence", "rank"]]


def _begins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each chunk of a field begins with, from the tables in order."""
    at, key, sure, rank = None, 0, -np.inf, NONE
    for run in _runs(frames, ["field_id", "chunk"]):
        field, chunk = run["field_id"].iloc[0], run["chunk"].iloc[0]
        if field != at:
            at, key, sure, rank = field, 0, -np.inf, NONE
        yield pd.DataFrame({"field_id": [field], "chunk": [chunk], "held_h": [key], "held_confidence": [sure], "held_rank": [rank]})
        mine = run[run["key"].eq(key) & ~run["other"] & (rank != NONE)]
        mine = mine if len(mine) else run[run["other"]]
        row = mine[mine["least"] <= sure].sort_values("least").iloc[-1]
        if row["rank"] == NONE:
            sure = min(sure, row["confidence"])
        else:
            key, sure, rank = int(row["after"]), float(row["confidence"]), int(row["rank"])


def _followed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each contribution what was held before it."""
    for run in _runs(frames, ["field_id", "chunk"]):
        key, sure, rank = run["held_h"].iloc[0], run["held_confidence"].iloc[0], run["held_rank"].iloc[0]
        out = []
        for h, c, r in zip(run["h"], run["confidence"], run["rank"], strict=True):
            out.append((rank, sure, rank != NONE and h != key, rank != NONE and h != key and c > sure))
            if rank == NONE or (h != key and c > sure):
                key, sure, rank = h, c, r
            elif h == key:
                sure = min(sure, c)
        found = pd.DataFrame(out, columns=["before_rank", "before_confidence", "conflict", "took"])
        found["rank"], found["field_id"], found["chunk"] = run["rank"].to_numpy(), run["field_id"].to_numpy(), run["chunk"].to_numpy()
        found["end_rank"], found["end_confidence"] = rank, sure
        yield found[["field_id", "chunk", "rank", "before_rank", "before_confidence", "conflict", "took", "end_rank", "end_confidence"]]


def merged_in_chunks(stage: Stage, rows: DataFrame, group: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """One row of each group and field (value, confidence, conflicts, first), as the fold of their contributions in order."""
    keys = [*group, "field"]
    rows = numbered(stage, rows, [F.col(c) for c in (*keys, "ord", "nth")], RANK, "contributions")
    rows = rows.withColumn("field_id", F.xxhash64(*keys)).withColumn("chunk", F.floor(F.col(RANK) / chunk).cast("long"))
    narrow = rows.select("field_id", "chunk", F.col(RANK).alias("rank"), F.xxhash64("key").alias("h"), "confidence")
    dealt = small_batches(narrow.repartition("field_id", "chunk").sortWithinPartitions("field_id", "chunk", "rank"))
    tables = stage.put(dealt.mapInPandas(_effects, "field_id long, chunk long, other boolean, key long, least double, after long, confidence double, rank long"), "effects")
    begins = small_batches(tables.repartition("field_id").sortWithinPartitions("field_id", "chunk")).mapInPandas(_begins, "field_id long, chunk long, held_h long, held_confidence double, held_rank long")
    dealt = narrow.join(stage.put(begins, "begins"), ["field_id", "chunk"])
    dealt = small_batches(dealt.repartition("field_id", "chunk").sortWithinPartitions("field_id", "chunk", "rank"))
    states = stage.put(dealt.mapInPandas(_followed, "field_id long, chunk long, rank long, before_rank long, before_confidence double, conflict boolean, took boolean, end_rank long, end_confidence double"), "states")
    values = rows.select(F.col(RANK).alias("rank"), "value")
    last = states.groupBy("field_id").agg(F.max_by(F.struct("end_rank", "end_confidence"), "rank").alias("end")).select("field_id", "end.*")
    ends = last.join(values, F.col("end_rank") == F.col("rank")).select("field_id", "value", F.col("end_confidence").alias("confidence"))
    noted = rows.withColumnRenamed(RANK, "rank").join(states.where("conflict").select("rank", "before_rank", "before_confidence", "took"), "rank").join(values.select(F.col("rank").alias("before_rank"), F.col("value").alias("existing")), "before_rank")
    note = F.struct(F.when(F.col("took"), "incoming").otherwise("existing").alias("kept"), F.col("before_confidence").alias("existing_confidence"), F.col("confidence").alias("incoming_confidence"), F.col("source_url").alias("incoming_source_url"), F.col("chunk_id").alias("source_chunk_id"), F.col("existing").alias("existing_value"), F.col("value").alias("incoming_value")).cast(CONFLICT)
    notes = noted.groupBy("field_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", note.alias("note")))), lambda x: x["note"]).alias("conflicts"))
    first = rows.groupBy("field_id", *keys).agg(F.min(F.struct("ord", "nth")).alias("first"))
    out = first.join(ends, "field_id").join(notes, "field_id", "left")
    return out.select(*keys, "value", "confidence", F.coalesce("conflicts", F.array().cast(f"array<{CONFLICT}>")).alias("conflicts"), "first")


def united_lists(rows: DataFrame, group: Sequence[str], form) -> DataFrame:
    """Lists of each group and field as one, items once by their ``form`` (a function of a JSON text), in the order they come.

    Equal items meet before anything is gathered.
    """
    keys = [*group, "field"]
    items = rows.select(*keys, "ord", "nth", F.posexplode(F.from_json("value", "array<variant>")).alias("at", "v")).withColumn("v", F.to_json("v"))
    once = items.groupBy(*keys, form(F.col("v")).alias("k")).agg(F.min(F.struct("ord", "nth", "at", "v")).alias("x"))
    joined = once.groupBy(*keys).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return joined.select(*keys, F.concat(F.lit("["), F.array_join(F.transform("xs", lambda x: x["v"]), ","), F.lit("]")).alias("united"))
