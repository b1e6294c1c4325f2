import random
import re

import pytest
from attesta.llm.mixing import Flight, mix, mixed_documents, targets
from attesta.session import Stage


def water(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by bisecting the level at which every source takes weight times level, up to its limit."""
    w = [weights[i % 3] for i in range(len(sizes))]
    low, high = 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(most * s, mid * x) for s, x in zip(sizes, w)) < share * sum(sizes) else (low, mid)
    return [min(most * s, high * x) for s, x in zip(sizes, w)]


@pytest.mark.parametrize("seed", range(6))
def test_targets_fill_up_by_weight(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 1, rnd.randint(0, 100), rnd.randint(0, 10**6)]) for _ in range((1, 2, 3, 17, 200, 3000)[seed])]
    names = sorted({f"{rnd.choice('aéBz𝒳')}{rnd.random()}" for _ in sizes})[: len(sizes) - 1] + [None]
    rows = list(zip(names, sizes, strict=True))
    out = targets(spark.createDataFrame(rnd.sample(rows, len(rows)), "source string, size long").repartition(5), Stage(spark, "test")).collect()
    got = {r.source: r.target for r in out}
    assert len(out) == len(rows) and sum(got.values()) == pytest.approx(1.5 * sum(sizes)) and all(got[n] <= 2 * s for n, s in rows)
    assert [got[n] for n in names] == pytest.approx(water(sizes), rel=1e-6, abs=1e-6)


def test_flight_keeps_both_totals():
    rnd, out = random.Random(0), {}
    flight = Flight(out.__setitem__)
    sizes = [rnd.choice([0, 1, 5, rnd.randint(1, 5000)]) for _ in range(3000)]
    for i, s in enumerate(sizes):
        flight.add(s, 0.37, rnd.getrandbits(60), i)
    held = {u[3]: u[1] for u in flight.held}
    assert len(held) <= 2 and len(out) + len(held) == len(sizes)
    assert sum(out.values()) + sum(held.values()) == pytest.approx(0.37 * len(sizes), abs=1e-3)
    assert sum(sizes[i] * x for i, x in [*out.items(), *held.items()]) == pytest.approx(0.37 * sum(sizes), rel=1e-6)


def test_inclusion_probabilities():
    for place in (0, 7, 19):
        hits = 0
        for seed in range(2000):
            out = {}
            flight = Flight(out.__setitem__)
            for i in range(20):
                flight.add((i * 37) % 11 + 1, 0.3, seed * 1000 + i, i)
            hits += out.get(place, 0) + next((u[1] for u in flight.held if u[3] == place), 0)
        assert hits / 2000 == pytest.approx(0.3, abs=0.05)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, water([sizes[s] for s in order])))
    taken, longest = dict.fromkeys(order, 0), dict.fromkeys(order, 0)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-6, abs=1e-6)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for s in order:
        assert abs(taken[s] - want[s]) <= longest[s] + 1e-6
    return taken, want


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = mix(docs).collect()
    assert {(r.doc_id, r.size) for r in got} == {(r.doc_id, words(r.text)) for r in docs.collect()}
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], got)
    assert sorted(map(tuple, mix(docs.repartition(3)).collect())) == sorted(map(tuple, got))


def test_many_tasks_come_near_the_targets(spark, prose, monkeypatch):
    from attesta.llm import mixing

    monkeypatch.setattr(mixing, "TASK_ROWS", 30)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rnd = random.Random(5)
    rows = [(i, prose(rnd.randint(1, 200), i), rnd.choice(["é", "a", "B", "zz", None, "a", "a", "a"])) for i in range(1500)]
    taken, want = check(rows, mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 200 for s in want)


def test_odd_rows(spark, prose):
    rows = [(1, None, None), (2, "", "x"), (3, "\x0b \x1f\x00 é", "x"), (3, "\x0b \x1f\x00 é", "x"), (None, "no id", "y"), (5, prose(50_000, 1), "z")]
    schema = "doc_id long, text string, source string, size long, target string"
    df = spark.createDataFrame([(*r, 7, "t") for r in rows], schema)
    check(rows, mix(df).collect())
    assert mix(df.limit(0)).count() == 0
    assert {r.taken for r in mix(df.where("doc_id = 2")).collect()} == {0}
    out = mixed_documents(df)
    assert out.columns == df.columns and sum(words(r.text) for r in out.where("doc_id = 5").collect()) % 50_000 == 0


def test_rows_of_null_and_repeated_ids_keep_their_own_count(spark, prose, tmp_path):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, None, 1, 2, 3]), prose(rnd.randint(1, 60), i % 30), rnd.choice("abc"), "k") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row_key string")
    df.write.parquet(str(tmp_path / "docs"))
    taken = sum(r.taken for r in mix(df).collect())
    for docs in (df, spark.read.parquet(str(tmp_path / "docs")), df.unionAll(df.limit(0))):
        out = mixed_documents(docs)
        assert out.columns == df.columns
        got = out.collect()
        assert {(r.doc_id, r.text, r.source, "k") for r in got} <= set(rows)
        assert sum(words(r.text) for r in got) == taken
    assert mixed_documents(df.limit(0)).count() == 0


def test_no_text_is_shuffled_and_passes_give_the_same_rows(spark, prose, tmp_path):
    rnd = random.Random(3)
    rows = [(i % 150, prose(rnd.randint(1, 60), i % 90), rnd.choice("abc")) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9).write.parquet(str(tmp_path / "docs"))
    docs, name = spark.read.parquet(str(tmp_path / "docs")), "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        whole = mixed_documents(docs)
        plan = whole._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set(name, held)
    assert sorted(map(tuple, mixed_documents(docs, limit=2000).collect())) == sorted(map(tuple, whole.collect()))
