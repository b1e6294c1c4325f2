"""Near-duplicate classes by BagMinHash: weighted Jaccard of word-shingle bags.

A document is the bag of its five-word shingles; a shingle's weight is how often
it occurs. Each (shingle, unit of weight) has a Poisson process of its own, and
these processes are split off, level by level, from one over ROOT units: halving
an interval leaves its first point to one half and starts the other half anew
from there, so intervals beyond a shingle's weight are dropped without being
looked at. Points hit random registers; each register keeps its earliest point.
Two bags agree in a register with the probability of their weighted Jaccard
similarity, whatever their sizes.

Registers are banded; documents that share a band are candidates, and every pair
of candidates is compared or proven to be connected already. First each document
is compared with one leader of each of its bands, the one that shares most bands
with others: a leader's bag is held and its candidates' bags pass by, a crowded
leader's in parts of PART, so this is linear. Most bands are connected by that.
In those that aren't, the documents that their leader didn't reach are compared
with all others, block by block, and a task emits only the links that join what
it hadn't joined before; so pairs are never written out. The same holds for
bands of every size. A link counts if the bags' overlap, computed in full,
reaches the similarity asked for; classes are what links connect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm._hash import SHINGLE, bags, fresh, mix, salt, shingles, unit, word_hashes
from attesta.session import Stage, compact, small_batches, with_row_keys

SIMILARITY = 0.8
#: Bands and registers a band: a pair of similarity 0.8 meets in some band but for 3 in a million.
BANDS, ROWS = 24, 4
#: Units of weight below one root process; a greater weight has several roots.
ROOT_BITS = 8
#: Members of a block, and candidates that one copy of their leader's bag is compared with.
BLOCK, PART = 128, 1024
#: Least and most bits of the broadcast filter for candidates; what it lets through in excess, a join removes.
FILTER_BITS = (1 << 16, 1 << 26)
#: Rows that go, as (file, row) pairs of _ROW_BYTES, that are broadcast at once.
DROP_BYTES, _ROW_BYTES = 64 << 20, 32
#: Share of a table's partitions that tables of links, labels and ids are written in.
NARROW = 0.25
#: Units of weight whose points are drawn at once.
_UNITS = 1 << 16
_LEVEL = [salt(100 + i) for i in range(ROOT_BITS + 1)]
_POINT, _GAP, _TURN, _ROOT = salt(1), salt(2), salt(3), salt(4)


def _exp(h: np.ndarray) -> np.ndarray:
    return -np.log1p(-unit(h))


def _leaves(elem: np.ndarray, weight: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each unit of weight below the root processes at ``low``: index of its root, key of its process, time of its first point."""
    who = np.arange(len(elem))
    t = _exp(mix(elem ^ mix(low.astype(np.uint64) + _ROOT))) / (1 << ROOT_BITS)
    for level in range(ROOT_BITS - 1, -1, -1):
        half = 1 << level
        h = mix(elem[who] ^ (low.astype(np.uint64) * _POINT + _LEVEL[level]))
        left_has = (h & np.uint64(1)).astype(bool)
        later = t + _exp(mix(h ^ _TURN)) / half
        right = low + half < weight[who]
        t_left = np.where(left_has, t, later)
        if right.any():
            t_right = np.where(left_has, later, t)[right]
            who, low, t = np.concatenate([who, who[right]]), np.concatenate([low, low[right] + half]), np.concatenate([t_left, t_right])
        else:
            t = t_left
    return who, mix(elem[who] + low.astype(np.uint64) * _GAP), t


def signatures(row: np.ndarray, elem: np.ndarray, weight: np.ndarray, rows: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """(rows, registers) identities of the earliest points; row, elem and weight give the bags. A row without elements has zeros.

    About _UNITS units of weight are followed at a time, so memory doesn't grow with a bag.
    """
    best, ident = np.full(rows * registers, np.inf), np.zeros(rows * registers, np.uint64)
    for some in range(0, len(elem), _UNITS):
        part = slice(some, some + _UNITS)
        roots = (weight[part] + (1 << ROOT_BITS) - 1) >> ROOT_BITS
        who = np.repeat(np.arange(len(roots)), roots)
        low = (np.arange(len(who)) - np.repeat(np.cumsum(roots) - roots, roots)) << ROOT_BITS
        units = np.cumsum(np.minimum(weight[part][who] - low, 1 << ROOT_BITS))
        cuts = np.searchsorted(units, np.arange(0, int(units[-1]) + _UNITS, _UNITS), "right")
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            mine = some + who[a:b]
            at, key, t = _leaves(elem[mine], weight[mine], low[a:b])
            _follow(best, ident, row[mine[at]], key, t, rows, registers)
    return ident.reshape(rows, registers)


def _follow(best: np.ndarray, ident: np.ndarray, at_row: np.ndarray, key: np.ndarray, t: np.ndarray, rows: int, registers: int) -> None:
    """Follow processes point by point while any may still be the earliest of a register."""
    point, points = 0, 1
    while len(key):
        k = np.arange(point, point + points, dtype=np.uint64)
        ids = mix(key[:, None] + k * _POINT)
        if point:
            times = t[:, None] + np.cumsum(_exp(mix(ids ^ _GAP)), axis=1)
        else:
            times = t[:, None]
        to = at_row[:, None] * registers + ((ids >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        sooner = times < best[to]
        where, when, what = to[sooner], times[sooner], ids[sooner]
        np.minimum.at(best, where, when)
        won = when == best[where]
        ident[where[won]] = what[won]
        t = times[:, -1]
        go = t < best.reshape(rows, registers).max(axis=1)[at_row]
        key, t, at_row = key[go], t[go], at_row[go]
        point, points = point + points, 1 if not point else min(points * 2, 64)


def band_keys(sig: np.ndarray, bands: int, width: int) -> np.ndarray:
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), salt(1000 + b), np.uint64)
        for r in range(width):
            h = mix(h + sig[:, b * width + r])
        out[:, b] = h
    return out.view(np.int64)


def _prints(hashes: np.ndarray, firsts: np.ndarray) -> list[bytes]:
    """128-bit fingerprint of each text's sequence of words."""
    words, cuts = memoryview(np.ascontiguousarray(hashes)).cast("B"), (firsts * 8).tolist()
    return [hashlib.md5(words[a:b], usedforsecurity=False).digest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _sign(batches: Iterator[pa.RecordBatch], bands: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, h, firsts in word_hashes(batch.column(1)):
            n, some, prints = len(firsts) - 1, np.diff(firsts) > 0, _prints(h, firsts)
            grams, firsts = shingles(h, firsts)
            del h
            keys = band_keys(signatures(*bags(grams, firsts), n, bands * width), bands, width)
            del grams
            ends = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.array(prints, pa.binary()), lists], ["doc_id", "print", "bands"])


def _units(elem: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Hashes of each unit of weight, sorted."""
    out, at = np.empty(int(weight.sum()), np.uint64), 0
    for some in range(0, len(elem), _UNITS):
        w = weight[some : some + _UNITS]
        nth = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
        out[at : at + len(nth)] = mix(np.repeat(elem[some : some + _UNITS], w) + nth.astype(np.uint64) * _GAP)
        at += len(nth)
    out.sort()
    return out


def _bags(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    """print and bag of the texts that the filter lets through: their distinct (shingle, unit of weight) hashes, sorted."""
    bits = wanted.value
    for batch in batches:
        for _, h, firsts in word_hashes(batch.column(0)):
            prints = _prints(h, firsts)
            place = np.frombuffer(b"".join(p[:8] for p in prints), "<u8") % np.uint64(64 * len(bits))
            keep = np.flatnonzero(bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1))
            out = []
            for i in keep.tolist():
                grams, first = shingles(h[firsts[i] : firsts[i + 1]], np.array([0, firsts[i + 1] - firsts[i]]))
                _, elem, weight = bags(grams, first)
                out.append(_units(elem, weight).tobytes())
                del grams, elem, weight
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([prints[i] for i in keep.tolist()], pa.binary()), pa.array(out, pa.binary())], ["print", "bag"])


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two bags."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) and not len(y):
        return 1.0
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
    return both / (len(x) + len(y) - both)


def linked(values: list[np.ndarray], sides: np.ndarray, similarity: float, labels: Sequence | None = None) -> list[tuple[int, int]]:
    """Pairs of bags of similarity or more, enough of them to connect all that such pairs connect.

    ``sides``: 0 for the first block's bags, 1 for the second's; pairs are across
    blocks or, if there is one block, within it. Bags that are connected already,
    by equal ``labels`` or by pairs found, aren't compared.
    """
    sizes = np.array([len(v) for v in values])
    order = np.lexsort((sizes, sides))
    values, sides, sizes = [values[i] for i in order], sides[order], sizes[order]
    flat = np.concatenate(values) if len(values) else np.zeros(0, np.uint64)
    distinct, ids = np.unique(flat, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    group, one, out = np.arange(len(values)), not sides.any(), []
    if labels is not None:
        codes: dict = {}
        group = np.array([codes.setdefault(labels[i], n) for n, i in enumerate(order.tolist())])
    mark = np.zeros(len(distinct), bool)
    for x in np.flatnonzero(sides == 0).tolist():
        if one:
            low, high = x + 1, len(values)
        else:
            low, high = int(np.searchsorted(sides, 1)), len(values)
        low += int(np.searchsorted(sizes[low:high], np.ceil(sizes[x] * similarity - 1e-9), "left"))
        high = low + int(np.searchsorted(sizes[low:high], np.floor(sizes[x] / similarity + 1e-9), "right"))
        if low >= high or (group[low:high] == group[x]).all():
            continue
        mine = ids[starts[x] : starts[x + 1]]
        mark[mine] = True
        hits = np.concatenate([[0], np.cumsum(mark[ids[starts[low] : starts[high]]])])
        mark[mine] = False
        both = hits[starts[low + 1 : high + 1] - starts[low]] - hits[starts[low:high] - starts[low]]
        union = sizes[x] + sizes[low:high] - both
        for y in (low + np.flatnonzero((both >= similarity * union - 1e-9) & (group[low:high] != group[x]))).tolist():
            if group[y] != group[x]:
                out.append((int(order[x]), int(order[y])))
                group[group == group[y]] = group[x]
    return out


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])


def _stars(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Links of (leader, part, role, print, bag) rows sorted by the first three: one bag is held, the leader's (role 0)."""
    leader, held = b"", b""
    for batch in batches:
        found = []
        for of, role, print_, bag in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
            if role == 0:
                leader, held = of, bag
            elif of == leader and overlap(held, bag) >= similarity - 1e-9:
                found.append((leader, print_))
        if found:
            yield _links(found)


def _compare(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Links of each (band, i, j) in turn; rows come sorted by these."""
    held: list[tuple] = []
    at = None

    def done() -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            pairs = linked([np.frombuffer(h[1], np.uint64) for h in held], np.array([h[0] for h in held]), similarity, [h[3] for h in held])
            if pairs:
                yield _links([(held[a][2], held[b][2]) for a, b in pairs])
        held.clear()

    for batch in batches:
        for cell, i, j, side, print_, bag, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (cell, i, j) != at:
                yield from done()
                at = (cell, i, j)
            held.append((side, bag, print_, label))
    yield from done()


def components(stage: Stage, edges: DataFrame, name: str) -> DataFrame:
    """node and label (its component's smallest node) of the nodes of ``edges`` (a, b).

    Each round hooks every node to its smallest neighbour, takes that one's hook,
    and goes on with the edges between hooks, far fewer each time (half the nodes
    go at least). Only whether edges are left comes to the driver. Each round's
    hooks and edges are written out, so lineage and plans stay short. The rounds'
    hooks are put together at the end.
    """
    pair = lambda x, y: (F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    left = stage.put(compact(edges.where("a != b").select(*pair("a", "b")).distinct(), NARROW), f"{name}-0")
    hooks: list[DataFrame] = []
    while not left.isEmpty():
        near = left.select(F.col("a").alias("node"), F.col("b").alias("near")).union(left.select("b", "a")).groupBy("node").agg(F.min("near").alias("near"))
        first = stage.keep(near.select("node", F.least("node", "near").alias("up")))
        hook = first.join(first.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up"))
        hook = stage.put(compact(hook, NARROW), f"{name}-hook-{len(hooks)}")
        stage.release(first)
        side = lambda c, h=hook: h.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}"))
        across = left.join(side("a"), "a").join(side("b"), "b").select(*pair("up_a", "up_b"))
        # A hook that itself hangs on another one keeps that edge.
        hanging = hook.where("node != up").join(hook.select(F.col("up").alias("node")).distinct(), "node", "left_semi").select(*pair("node", "up"))
        after = across.union(hanging).where("a != b").distinct()
        hooks.append(hook)
        left = stage.put(compact(after, NARROW), f"{name}-{len(hooks)}")
    if not hooks:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = hooks[-1].select("node", F.col("up").alias("label"))
    for hook in reversed(hooks[:-1]):
        above = labels.select(F.col("node").alias("up"), "label")
        labels = hook.join(above, "up", "left").select("node", F.coalesce("label", "up").alias("label"))
    return stage.put(compact(labels, NARROW), f"{name}-labels")


def _filter_of(prints: DataFrame) -> np.ndarray:
    """Bit set of the prints' places, 16 bits a print within FILTER_BITS; a row for each 64 bits at most comes to the driver."""
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], 1 << (16 * prints.count()).bit_length()))
    low = F.concat(*(F.substring(F.hex("print"), 2 * i + 1, 2) for i in range(7, -1, -1)))
    place = F.conv(F.substring(low, 9, 8), 16, 10).cast("long") % bits  # the low 32 bits suffice: ``bits`` divides them
    got = prints.select((place / 64).cast("int").alias("w"), place.alias("p")).withColumn("bit", F.expr("shiftleft(1L, cast(p % 64 as int))"))
    rows = got.groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _star_links(pairs: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """Links of (leader, print) pairs whose bags are similar. A leader's bag is copied once for PART candidates."""
    parts = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    dealt = pairs.join(parts, "leader").withColumn("part", F.pmod(F.xxhash64("print"), "parts").cast("int"))
    members = dealt.join(bag, "print").select("leader", "part", F.lit(1).alias("role"), "print", "bag")
    heads = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(bag.withColumnRenamed("print", "leader"), "leader")
    heads = heads.select("leader", "part", F.lit(0).alias("role"), F.col("leader").alias("print"), "bag")
    rows = heads.unionByName(members).repartition("leader", "part").sortWithinPartitions("leader", "part", "role")
    return small_batches(rows).mapInArrow(partial(_stars, similarity=similarity), "a binary, b binary")


def _rest_links(stage: Stage, members: DataFrame, labels: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """Links within the bands whose members, but for the leader, are of several components.

    Those outside the leader's component are compared with one another and with
    those inside. Of bands of the same members one is gone through. ``members``:
    band, leader, print.
    """
    named = members.join(labels.select(F.col("node").alias("print"), "label"), "print", "left").withColumn("label", F.coalesce("label", "print"))
    led = F.col("print") != F.col("leader")
    of = lambda c: F.when(led, c)
    bands = named.groupBy("band").agg(F.min(of(F.col("label"))).alias("low"), F.max(of(F.col("label"))).alias("high"), F.max(F.when(~led, F.col("label"))).alias("chief"), F.count_if(led).alias("n"), F.sum(of(F.xxhash64("print").cast("decimal(38,0)"))).alias("sum"))
    open_ = bands.where("low != high").groupBy("n", "sum").agg(F.min_by(F.struct("band", "chief"), "band").alias("b")).select("b.band", "b.chief")
    rows = named.where(led).join(open_, "band").select("band", "print", "label", (F.col("label") != F.col("chief")).alias("out"))
    rows = stage.keep(rows)
    blocks = lambda c: F.ceil(F.count_if(c) / BLOCK).cast("int")
    sizes = rows.groupBy("band").agg(blocks(F.col("out")).alias("outs"), blocks(~F.col("out")).alias("ins"))
    dealt = rows.join(sizes, "band")
    mine = F.when(F.col("out"), F.pmod(F.xxhash64("print"), "outs")).otherwise(F.col("outs") + F.pmod(F.xxhash64("print"), "ins")).cast("int")
    other = F.when(F.col("out"), F.sequence(F.lit(0), F.col("outs") + F.col("ins") - 1)).otherwise(F.sequence(F.lit(0), F.col("outs") - 1))
    dealt = dealt.withColumn("m", mine).withColumn("k", F.explode(other))
    dealt = dealt.select("band", F.least("m", "k").alias("i"), F.greatest("m", "k").alias("j"), (F.col("m") > F.col("k")).cast("int").alias("side"), "print", "label")
    cells = dealt.join(bag, "print").select("band", "i", "j", "side", "print", "bag", "label").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return stage.put(compact(small_batches(cells).mapInArrow(partial(_compare, similarity=similarity), "a binary, b binary")), "rest")


def duplicate_classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, width: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and class_id (the class's smallest doc_id) of every row.

    Words are split at ASCII white space and lower-cased. Texts of the same
    words are of one class; so are texts whose bags of shingles have a weighted
    Jaccard similarity of ``similarity`` or more, and what such links connect.
    A text of one to four words has one shingle. Null and empty texts and those
    of white space have no words and are one class. Null ids stay and never
    name a class unless all its ids are null; repeated rows are each returned;
    other columns are ignored; an empty table gives an empty result. A very long
    text is read in parts; its bag, 8 bytes a word, is held as a whole.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "neardup")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = stage.keep(small_batches(rows).mapInArrow(partial(_sign, bands=bands, width=width), f"doc_id {kind}, print binary, bands array<long>"))
    ids = signed.select("doc_id", "print")

    nodes = signed.where(F.size("bands") > 0).groupBy("print").agg(F.first("bands").alias("bands")).select(F.explode("bands").alias("band"), "print")
    shared = nodes.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage.put(compact(nodes.join(shared, "band")), "members")
    central = members.groupBy("print").agg(F.sum("n").alias("degree"))
    ranked = members.join(central, "print").groupBy("band").agg(F.max(F.struct("degree", "print")).alias("top")).select("band", F.col("top.print").alias("leader"))
    led = stage.put(compact(members.select("band", "print").join(ranked, "band")), "led")
    stage.drop("members")

    wanted = spark.sparkContext.broadcast(_filter_of(led.select("print").distinct()))
    bag = small_batches(rows.select("text")).mapInArrow(partial(_bags, wanted=wanted), "print binary, bag binary")
    bag = stage.keep(bag.groupBy("print").agg(F.first("bag").alias("bag")))
    pairs = stage.keep(led.where("leader != print").select("leader", "print").distinct())
    links = _star_links(pairs, bag, similarity)
    labels = components(stage, links, "stars")
    stage.release(pairs)
    rest = _rest_links(stage, led, labels, bag, similarity)
    stage.drop("led")
    stage.release(bag)
    if not rest.isEmpty():
        labels = components(stage, labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(rest), "labels")

    first = ids.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    named = stage.keep(first.join(labels.select(F.col("node").alias("print"), "label"), "print", "left").withColumn("label", F.coalesce("label", "print")))
    lowest = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    classes = named.join(lowest, "label").select("print", "class_id")
    out = stage.put(compact(ids.join(classes, "print").select("doc_id", "class_id")), "classes")
    stage.close("classes")
    wanted.unpersist()
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = DROP_BYTES, **kwargs) -> DataFrame:
    """One row of each class, that of the smallest id, decided for each row by its id and text.

    Rows without id come after those with one: a class without ids keeps one row.
    Texts that share an id stand for themselves, each in its own class. Of equal
    ids in a class the text of the smallest SHA-256 stays, of rows equal in both
    that of the smallest hash of all columns (maps aside), and of wholly equal ones
    one. Null and empty texts are a class; all columns stay, whatever their names;
    an empty table gives an empty result.

    Rows are told apart by file and place, and the ones that go meet the table by
    these, broadcast in passes of ``limit`` bytes that each read files of their own:
    no text is shuffled. A pass of more than twice as many joins by shuffle.
    """
    stage = Stage(docs.sparkSession, "dedup")
    docs, place = with_row_keys(stage, docs)
    body = F.col(text_col)
    sha = F.substring(F.unhex(F.sha2(F.coalesce(body, F.lit("")), 256)), 1, 16)
    plain = [F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    zero = F.lit("0").cast(docs.schema[id_col].dataType)
    key = F.struct(F.col(id_col).isNull().alias("lost"), F.coalesce(F.col(id_col), zero).alias("id"), body.isNull().alias("void"), sha.alias("sha"), F.xxhash64(*plain).alias("all"), place["file"].alias("file"), place["row"].alias("row"))
    classes = duplicate_classes(docs.select(key.alias("row_key"), body.alias("row_text")), id_col="row_key", text_col="row_text", **kwargs)
    file, row = fresh("gone_file", docs.columns), fresh("gone_row", docs.columns)
    gone = classes.where("doc_id != class_id").select(F.col("doc_id.file").alias(file), F.col("doc_id.row").alias(row))
    gone = stage.put(compact(gone, NARROW), "gone")
    passes = max(1, -(-gone.count() * _ROW_BYTES // limit))
    share = F.pmod(file, F.lit(passes))
    sizes = {r[0]: r[1] * _ROW_BYTES for r in gone.groupBy(share).count().collect()} if passes > 1 else {}
    placed, out = docs.withColumns({file: place["file"], row: place["row"]}), None
    for i in range(passes):
        some = gone.where(share == i)
        left = placed.where(share == i).join(F.broadcast(some) if sizes.get(i, 0) <= 2 * limit else some, [file, row], "left_anti")
        out = left if out is None else out.unionByName(left)
    return compact(out.drop(file, row))


__all__ = ["SHINGLE", "deduplicated", "duplicate_classes", "overlap", "signatures"]
