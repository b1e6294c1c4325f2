"""Conversations as a trie of shared prefixes, with sums over subtrees by heavy paths.

A node is a distinct sequence of first turns; its key is a sum, over its turns, of
hashes of turn and depth, so that a conversation's keys are running sums.
Running sums are taken in two levels, within chunks of CHUNK rows and over the
chunks' totals, so that no conversation or path, however long, is one group.

For sums over subtrees each node's heavy child is that of most conversations
(the smallest id of equals). Nodes that follow one another as heavy children are
a path; each ends in a leaf, and the leaf's smallest conversation names it. The
number of light nodes before a path's head is its level, and a level holds at
most half the conversations of the one before, so levels are logarithmic. From
the deepest level on, sums are suffix sums along the paths' arrays, and those of
the heads are attached to their parents, one level up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.session import Stage, numbered, small_batches, with_row_keys

#: Rows of a running sum that are one group; at most as many ids are put together as one text at once.
CHUNK = 4096
#: Most turns that a conversation may share with its base, and one more: what the checksum is divided by.
SHARED = 6
#: Conversations to each base.
FAMILY = 100
LANES = ("s1", "s2", "s3", "s4")
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def running(df: DataFrame, keys: list[str], place: str, sums: dict[str, Column], back: bool = False, chunk: int = CHUNK) -> DataFrame:
    """The rows with running sums (from the end, if ``back``) over each group of ``keys`` in the order of ``place``, numbers that are nearly consecutive.

    A group is summed in chunks; the totals of the chunks before are added, which
    are one row for ``chunk`` rows.
    """
    at, order = "_chunk", (lambda c: F.col(c).desc() if back else F.col(c).asc())
    df = df.withColumn(at, F.floor(F.col(place) / chunk).cast("long"))
    inner = Window.partitionBy(*keys, at).orderBy(order(place)).rowsBetween(Window.unboundedPreceding, 0)
    within = df.withColumns({f"_{name}": F.sum(value).over(inner) for name, value in sums.items()})
    outer = Window.partitionBy(*keys).orderBy(order(at)).rowsBetween(Window.unboundedPreceding, -1)
    long = df.groupBy(*keys, at).agg(*(F.sum(value).alias(f"_t{name}") for name, value in sums.items()))
    before = long.withColumns({f"_t{name}": F.sum(f"_t{name}").over(outer) for name in sums}).where(F.col(f"_t{next(iter(sums))}").isNotNull())
    out = within.join(before, [*keys, at], "left")
    return out.withColumns({name: F.col(f"_{name}") + F.coalesce(f"_t{name}", F.lit(0)) for name in sums}).drop(at, *(f"_{x}{n}" for n in sums for x in ("", "t")))


def _lanes() -> dict[str, Column]:
    """Four 32-bit hashes of a turn at its depth: their sums stay within 64 bits for two thousand million turns."""
    one, two, low = F.xxhash64("digest", "depth"), F.xxhash64("depth", "digest"), 0xFFFFFFFF
    return {"s1": one.bitwiseAND(low), "s2": F.shiftrightunsigned(one, 32), "s3": two.bitwiseAND(low), "s4": F.shiftrightunsigned(two, 32)}


def _key(names: tuple[str, str], depth: Column, lanes: list[Column]) -> list[Column]:
    return [F.xxhash64(depth, *lanes).alias(names[0]), F.xxhash64(*reversed(lanes), depth).alias(names[1])]


def rebuilt_turns(conversations: DataFrame, stage: Stage, shared: int = SHARED, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth from 1, digest, chars of the text, whether it is the last), and conv_id with the length of each.

    A conversation's turns are in the order of turn (null first), equal ones by
    role and the SHA-256 of role and text; null roles and texts are empty. Rows
    without conv_id belong to no conversation.
    """
    rows, key = with_row_keys(stage, conversations)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256)
    turns = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.unhex(digest).alias("digest"), F.char_length(text).cast("long").alias("chars"), F.xxhash64(key).alias("row"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("row")]
    turns = numbered(stage, turns, order, "rank").select("conv_id", "digest", "chars", "rank")
    base = F.col("conv_id") - F.col("conv_id") % family
    own = turns.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count("*").alias("n")).withColumns({"base": base, "h": F.crc32(F.col("conv_id").cast("string")) % shared})
    bases = own.where(F.col("conv_id") == F.col("base")).select("base", F.col("n").alias("base_n"))
    convs = own.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = stage.put(convs.withColumn("length", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).select("conv_id", "base", "first", "h", "k", "length"), "convs")
    placed = turns.join(convs, "conv_id").withColumn("place", F.col("rank") - F.col("first") + 1)
    tails = placed.where(F.col("place") > F.col("h")).select("conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "digest", "chars", "length")
    heads = placed.where((F.col("conv_id") == F.col("base")) & (F.col("place") < shared)).select("base", F.col("place").alias("depth"), "digest", "chars")
    heads = convs.where(F.col("k") > 0).select("conv_id", "base", "k", "length").join(heads, "base").where(F.col("depth") <= F.col("k"))
    turns = tails.unionByName(heads.select(tails.columns)).withColumn("last", F.col("depth") == F.col("length"))
    return turns.drop("length"), convs.select("conv_id", "length")


def _digests(ends: DataFrame, chunk: int) -> DataFrame:
    """k1, k2, n_ends and the SHA-256 of the comma-joined ids, ascending, of what ends at each node.

    Ids of a chunk are joined side by side; the hash, which has no other way than
    one byte after the other, gets a row for each chunk, and holds one at a time.
    """
    import hashlib

    import pandas as pd

    def hashed(frames):
        key, sha, n = None, None, 0
        for frame in frames:
            out = []
            for k1, k2, ids, more in zip(frame.k1, frame.k2, frame.ids, frame.n, strict=True):
                if key != (k1, k2):
                    if key is not None:
                        out.append((*key, n, sha.hexdigest()))
                    key, sha, n = (k1, k2), hashlib.sha256(ids.encode()), more
                else:
                    sha.update(b"," + ids.encode())
                    n += more
            yield pd.DataFrame(out, columns=["k1", "k2", "n_ends", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, n, sha.hexdigest())], columns=["k1", "k2", "n_ends", "ends_sha256"])

    at = F.floor(F.col("conv_id") / chunk).alias("at")
    joined = ends.groupBy("k1", "k2", at).agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"), F.count("*").alias("n"))
    counted = joined.groupBy("k1", "k2").agg(F.count("*").alias("chunks"), F.first("ids").alias("ids"), F.sum("n").alias("n_ends"))
    alone = counted.where("chunks = 1").select("k1", "k2", "n_ends", F.sha2(F.encode("ids", "UTF-8"), 256).alias("ends_sha256"))
    several = joined.join(counted.where("chunks > 1").select("k1", "k2"), ["k1", "k2"], "left_semi")
    several = small_batches(several.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "at").select("k1", "k2", "ids", "n")).mapInPandas(hashed, "k1 long, k2 long, n_ends long, ends_sha256 string")
    return alone.unionByName(several)


def prefix_trie(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens over its subtree, ends_sha256; beside them n_ends.

    Conversations are rebuilt first (rebuilt_turns); those without turns are
    members of the root alone, whose parent is null. Very long texts come in only
    as a digest and a length. Repeated rows are turns of their own; other columns
    are left out; an empty table has no node. Steps between shuffles are written
    to the shared folder and given up but for what the result reads.
    """
    stage = Stage(conversations.sparkSession, "trie")
    turns, convs = rebuilt_turns(conversations, stage)
    lanes = _lanes()
    turns = stage.put(turns.withColumns({f"own_{c}": lanes[c] for c in LANES}).drop("digest"), "turns")
    sums = running(turns, ["conv_id"], "depth", {c: F.col(f"own_{c}") for c in LANES}, chunk=chunk)
    before = [F.col(c) - F.col(f"own_{c}") for c in LANES]
    members = stage.put(sums.select("conv_id", "depth", "chars", "last", *_key(("k1", "k2"), F.col("depth"), [F.col(c) for c in LANES]), *_key(("q1", "q2"), F.col("depth") - 1, before)), "members")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("chars"), (F.col("length") == 0).alias("last"), *_key(("k1", "k2"), zero, [zero] * len(LANES)), *(F.lit(None).cast("long").alias(q) for q in ("q1", "q2")))
    every = members.unionByName(roots)
    key = ["k1", "k2"]

    nodes = stage.put(every.groupBy(key).agg(F.min("conv_id").alias("conv_id"), *(F.max(c).alias(c) for c in ("depth", "q1", "q2", "chars")), F.count("*").alias("n_convs")), "nodes")
    heavy = F.min(F.struct(-F.col("n_convs"), "conv_id"))["conv_id"]
    kids = nodes.where("depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"), heavy.alias("heavy"))
    nodes = stage.put(nodes.join(kids, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "parents")
    above = nodes.where("n_children > 0").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.col("heavy").alias("chosen"))
    light = F.col("depth").eqNullSafe(0) | (F.col("conv_id") != F.col("chosen"))
    nodes = stage.put(nodes.drop("heavy").join(above, ["q1", "q2"], "left").withColumn("light", light).drop("chosen"), "linked")

    # A leaf's smallest conversation walks down its path: light nodes on its way give the level, and what follows the last one is the path.
    leaves = nodes.where("n_children = 0").select("conv_id")
    turned = nodes.where("light AND depth > 0").select(*key, F.lit(1).alias("turned"))
    walks = members.join(leaves, "conv_id", "left_semi").select("conv_id", "depth", *key).join(turned, key, "left").unionByName(roots.join(leaves, "conv_id", "left_semi").select("conv_id", "depth", *key, F.lit(0).alias("turned")))
    walks = stage.put(walks.select(F.col("conv_id").alias("path"), "depth", *key, F.coalesce("turned", F.lit(0)).alias("turned")), "walks")
    levels = walks.groupBy("path").agg(F.sum("turned").alias("level"))
    paths = running(walks, ["path"], "depth", {"level": F.col("turned")}, chunk=chunk).join(levels, ["path", "level"], "left_semi").select(*key, "path", "level")
    placed = stage.put(nodes.join(paths, key).withColumn("level", F.col("level").cast("int")), "placed", "level")
    stage.drop("turns", "numbered", "rows", "nodes", "parents", "linked", "walks")

    top = placed.agg(F.max("level")).first()[0]
    attached, done = None, []
    for level in range(-1 if top is None else top, -1, -1):
        rows = placed.where(F.col("level") == level).withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")})
        if attached is not None:
            rows = rows.join(attached, key, "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}).drop("more_leaves", "more_saved")
        rows = stage.put(rows, f"arrays-{level}")
        summed = stage.put(running(rows, ["path"], "depth", {"n_leaves": F.col("leaves"), "saved_tokens": F.col("saved")}, back=True, chunk=chunk), f"sums-{level}")
        attached = summed.where("light AND depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        stage.drop(f"arrays-{level}")
        done.append(summed)
    stage.drop("placed")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    if not done:
        return nodes.sparkSession.createDataFrame([], ", ".join(f"{c} long" for c in columns) + ", ends_sha256 string, n_ends long")
    out = done[0]
    for summed in done[1:]:
        out = out.unionByName(summed)
    digests = _digests(every.where("last").select(*key, "conv_id"), chunk)
    out = out.join(digests, key, "left")
    return out.select(*columns, F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"), F.coalesce("n_ends", F.lit(0)).alias("n_ends"))
