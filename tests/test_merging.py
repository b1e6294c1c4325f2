"""Fields of any number of contributions against a fold one by one."""

from __future__ import annotations

import random

import numpy as np
import pytest

from attesta.operators import merging
from attesta.operators.records import merge_fields

SCHEMA = "g string, ord long, nth int, field string, value string, key string, confidence double, source_url string, chunk_id string"


def one_by_one(rows):
    out = {}
    for g, o, nth, field, value, key, sure, url, chunk in sorted(rows):
        held = out.get((g, field))
        if held is None:
            out[g, field] = [value, key, sure, [], (o, nth)]
        elif held[1] == key:
            held[2] = min(held[2], sure)
        else:
            better = sure > held[2]
            held[3].append(("incoming" if better else "existing", held[2], sure, url, chunk, held[0], value))
            if better:
                held[:3] = [value, key, sure]
    return {k: (v[0], v[2], v[3], v[4]) for k, v in out.items()}


def some(seed, n, keys, levels):
    rnd = random.Random(seed)
    rows = []
    for o in range(n):
        k = rnd.choice(keys)
        rows.append((rnd.choice(["x", "x", "x", "y"]), o, rnd.randrange(3), rnd.choice(["a", "a", "b"]), f'"{k}{rnd.randrange(2)}"', k, rnd.choice(levels), f"s{o % 3}", f"c{o}"))
    return rows


@pytest.mark.parametrize(("n", "keys", "levels", "chunk"), [(300, "pq", [0.1, 0.5, 0.9], 8), (500, [f"k{i}" for i in range(40)], [i / 50 for i in range(50)], 32), (200, "p", [0.3, 0.2], 1024)])
def test_chunks_are_the_fold(spark, n, keys, levels, chunk):
    rows = some(n, n, keys, levels)
    got = merge_fields(spark.createDataFrame(rows, SCHEMA).repartition(3), ["g"], chunk=chunk).collect()
    assert {(r["g"], r["field"]): (r["value"], r["confidence"], [tuple(c) for c in r["conflicts"]], tuple(r["first"])) for r in got} == one_by_one(rows)
    assert len(got) == len(one_by_one(rows))


def test_a_chunks_table_is_what_following_it_gives():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        n = int(rnd.integers(1, 12))
        keys, sure, ranks = rnd.integers(5, 8, n), rnd.integers(0, 5, n) / 4, np.arange(n)
        table = merging.effect(keys, sure, ranks)
        for key in (5, 6, 7, 99):
            for before in (-np.inf, 0.0, 0.1, 0.25, 0.6, 1.0, 2.0):
                mine = table[table["key"].eq(key) & ~table["other"]]
                mine = mine if len(mine) else table[table["other"]]
                row = mine[mine["least"] <= before].sort_values("least").iloc[-1]
                got = (key, min(before, row["confidence"]), -7) if row["rank"] == merging.NONE else (row["after"], row["confidence"], row["rank"])
                want = merging.follow(keys, sure, ranks, np.array([key]), np.array([before]), np.array([-7]))
                assert got == tuple(x[0] for x in want)


def test_lists_are_united_once_and_in_order(spark):
    rows = [("x", o, 0, "t", f'["v{o % 50}", "V{o % 50}", {o % 20}]', f"k{o}", 0.5 + o % 2 / 4, "s", "c") for o in range(3000)] + [("y", 1, 0, "t", '["one", "one"]', "k", 0.4, "s", "c"), ("z", 1, 0, "t", '["one"]', "k", 0.4, "s", "c"), ("z", 2, 0, "t", '"text"', "l", 0.9, "s", "c")]
    got = {r["g"]: r for r in merge_fields(spark.createDataFrame(rows, SCHEMA), ["g"]).collect()}
    seen = {}
    for o in range(3000):
        for v in (f'"v{o % 50}"', f'"V{o % 50}"', str(o % 20)):
            seen.setdefault(v.lower(), v)
    assert got["x"]["value"] == "[" + ",".join(seen.values()) + "]"
    assert (got["x"]["confidence"], got["x"]["conflicts"]) == (0.5, [])
    assert got["y"]["value"] == '["one","one"]'
    assert got["z"]["value"] == '"text"'
