"""The prefix trie against a plain one, built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from attesta.llm import prefix_trie as pt
from attesta.llm.queries import ORACLES, op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            own[conv_id].append((turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        base, h = c - (abs(c) % 100) * (1 if c > 0 else -1), zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = sum(not any(len(m) == len(n) + 1 and m[:-1] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        children = sum(len(n) == len(node) + 1 for n in below)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children, leaves, saved, digest))
    return sorted(out, key=str)


def trie(spark, rows, **more):
    got = pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), **more).collect()
    return sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str)


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(3)
    rows = []
    for c in rnd.sample(range(330), 90) + [0, 100, -100, -103, -7, 1000005]:
        stem = rnd.choice([[], ["hi"], ["hi", "so"], ["hi", "so", "é漢"]])
        texts = stem + [rnd.choice(["a", "bb", "", "ccc"]) for _ in range(rnd.randrange(1, 9))]
        rows += [(c, t, rnd.choice(["user", "user", "assistant"]) if t > 1 else "user", x) for t, x in enumerate(texts)]
    return rows


@pytest.mark.parametrize("chunk", [pt.CHUNK, 2])
def test_as_built_turn_by_turn(spark, talks, chunk):
    assert trie(spark, talks, chunk=chunk) == plain(talks)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, None, ""), (1, 0, "", None), (1, 1, "user", "x"), (1, 1, "user", "x"), (1, 1, "user", "y"), (None, 0, "user", "x"), (2, 0, "ab", "c"), (3, 0, "a", "bc"), (201, 5, "user", "x")]
    assert trie(spark, rows) == plain(rows)
    assert trie(spark, []) == []


def test_a_long_conversation_and_many_copies(spark):
    rows = [(100, t, "user", f"t{t}") for t in range(60)] + [(c, t, "user", f"t{t % 7}") for c in range(200, 290) for t in range(9)]
    assert trie(spark, rows, chunk=8) == plain(rows)


def test_further_columns(spark, talks):
    frame = spark.createDataFrame([(*r, 1, "x") for r in talks], f"{SCHEMA}, depth int, path string")
    assert sorted((tuple(r[c] for c in COLUMNS) for r in pt.prefix_trie(frame).collect()), key=str) == plain(talks)


def test_the_query_equals_its_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op13_prefix_trie']})").fetchall()
    got = op13_prefix_trie(spark, sf_dir).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert len(got) > 30
