"""The filter audit against a plain count over all orders."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest

from attesta.llm import filter_audit as fa
from attesta.llm.queries import ORACLES, op12_filter_audit

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain(docs, labels):
    """Each document passed through each order of the filters."""
    good, toxic = ({d for d, *x in labels if d is not None and x[i] == 1} for i in (0, 1))
    rows = []
    for doc_id, lang, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, _, t in docs) else set()
        rows.append((doc_id, lang or "", fails))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        left = rows
        for step, f in enumerate(order, 1):
            gone = [r for r in left if f in r[2]]
            left = [r for r in left if f not in r[2]]
            for part in {r[1] for r in rows}:
                own = [r for r in gone if r[1] == part]
                shapley[part, f] += len(own)
                failing = [r for r in rows if r[1] == part and f in r[2]]
                out[part, "".join(order), step] = [sum(r[1] == part for r in left), len(own), len(failing) - len(own), sum(len(r[2]) == 1 for r in failing), sum(r[0] in good for r in own), sum(r[0] in toxic for r in own)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, labels):
    rows = fa.filter_audit(spark.createDataFrame(docs, "doc_id long, lang string, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def corpus(prose):
    long, flat = prose(150, 1), "same word again " * 60
    docs = [(1, "en", long), (2, "en", long), (3, "de", long), (3, "de", long), (0, "de", flat), (4, "de", flat), (5, None, None), (6, "", ""), (7, "en", "SHOUT " * 120), (8, "en", f"{long} 100 %"), (9, "fr", f"{long} | TABLE"), (None, "en", long), (None, "en", "$"), (10, "en", "a\x0bb　c\x85d")]
    return docs, [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (7, 0, 1), (None, 1, 1), (99, 1, 1)]


def test_all_orders_are_as_counted_one_by_one(spark, corpus):
    docs, labels = corpus
    assert audited(spark, docs, labels) == plain(docs, labels)


def test_copies_in_any_partition_and_many_flushes(spark, corpus, monkeypatch):
    docs, labels = corpus
    monkeypatch.setattr(fa, "HELD_BYTES", 1)
    frame = spark.createDataFrame(docs * 3 + [(100 - i, "en", docs[0][2]) for i in range(60)], "doc_id long, lang string, text string").repartition(7)
    small = sorted((tuple(r) for r in fa.verdicts(frame, chain_bytes=500, held_bytes=1).groupBy("doc_id", "part", "mask").sum("n").collect()), key=str)
    assert small == sorted((tuple(r) for r in fa.verdicts(frame).groupBy("doc_id", "part", "mask").sum("n").collect()), key=str)
    assert sum(r[3] for r in small) == 3 * len(docs) + 60
    assert {r[0] for r in small if r[2] & fa.COPY} == {*range(41, 101), 2, 3, 4, 6} - {1}


def test_equal_fingerprints_of_different_texts(monkeypatch):
    chains = fa.Chains()
    out = [x for i, raw in enumerate([b"x", b"y", b"x", b"y"]) for x in chains.add(7, raw, 0, 9 - i, {"": 1})]
    assert out == [(9, "", fa.COPY, 1), (8, "", fa.COPY, 1)]
    assert sorted((e[0], e[2]) for _, e in chains.taken()) == [(b"x", 7), (b"y", 6)]


def test_long_texts_in_windows(monkeypatch):
    text = "one two　three " * 400 + "X" * 300
    whole = fa.failing(text, text.encode())
    monkeypatch.setattr(fa, "SLICE_BYTES", 64)
    assert fa.failing(text, text.encode()) == whole


def test_empty_tables_and_clashing_columns(spark, corpus):
    docs, labels = corpus
    assert audited(spark, [], labels) == {}
    assert audited(spark, docs, []) == plain(docs, [])
    odd = spark.createDataFrame([(*d, 5, "m", 1) for d in docs], "doc_id int, lang string, text string, part int, mask string, quality int")
    marks = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, n int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in fa.filter_audit(odd, marks).collect()}
    assert got == plain(docs, labels)


def test_the_query_equals_its_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = con.execute(f"SELECT part, filter_order, step, {', '.join(COLUMNS)} FROM ({ORACLES['op12_filter_audit']})").fetchall()
    got = [tuple(r) for r in op12_filter_audit(spark, sf_dir).select("part", "filter_order", "step", *COLUMNS).collect()]
    assert sorted(got) == sorted(want)
    assert len(got) > 600
