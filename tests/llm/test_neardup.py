import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from attesta.llm._hash import bags
from attesta.llm import neardup
from attesta.llm.neardup import BANDS, ROWS, deduplicated, duplicate_classes, linked, overlap, signatures
from attesta.session import Stage


def bag(text):
    words = (text or "").lower().translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
    words = [w for w in words if w]
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 1.0


def brute(rows, similarity=0.8):
    """Class of each row by comparing all pairs that share a shingle."""
    found, where = [bag(t) for _, t in rows], defaultdict(list)
    for i, b in enumerate(found):
        for s in b or [()]:
            where[s].append(i)
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    seen = set()
    for same in where.values():
        for i in same:
            for j in same:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    if jaccard(found[i], found[j]) >= similarity:
                        up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted((str(d), str(least.get(top(i)))) for i, (d, _) in enumerate(rows))


def classes(df):
    return sorted((str(r.doc_id), str(r.class_id)) for r in df.collect())


def test_signatures_estimate_the_weighted_similarity():
    rnd = np.random.default_rng(1)
    for share, weight in ((0.5, 1), (0.8, 3), (0.3, 300)):
        n = 200
        a = {i: int(rnd.integers(1, weight + 1)) for i in range(n)}
        b = {i if rnd.random() < share else i + n: int(rnd.integers(1, weight + 1)) for i in range(n)}
        true = sum(min(a.get(i, 0), b.get(i, 0)) for i in {*a, *b}) / sum(max(a.get(i, 0), b.get(i, 0)) for i in {*a, *b})
        hashes = np.concatenate([np.repeat(np.fromiter(x, np.uint64), np.fromiter(x.values(), np.int64)) for x in (a, b)])
        firsts = np.array([0, sum(a.values()), sum(a.values()) + sum(b.values())])
        row, elem, w = bags(hashes * np.uint64(0x9E3779B97F4A7C15), firsts)
        s = signatures(row, elem, w, 2, 4096)
        assert abs(float((s[0] == s[1]).mean()) - true) < 4 * (true * (1 - true) / 4096) ** 0.5 + 1e-3


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert classes(duplicate_classes(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("block,part", [(128, 1024), (7, 3), (5, 10)])
def test_chains_bridges_and_crowded_bands(docs_of, prose, monkeypatch, block, part):
    """A crowd of texts that share most of a passage, with single links across it, keeps every link, however it is cut into blocks."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "PART", part)
    rnd = random.Random(3)
    base = prose(120, 1).split()
    rows = []
    for i in range(60):
        words = list(base)
        for j in rnd.sample(range(len(words)), rnd.randint(0, 9)):
            words[j] = f"w{rnd.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    chain = prose(200, 2).split()
    for i in range(12):  # each near the one before, the ends far apart
        chain = [*chain[6:], *(f"c{i}x{k}" for k in range(6))]
        rows.append((100 + i, " ".join(chain)))
    assert classes(duplicate_classes(docs_of(rows))) == brute(rows)


def test_odd_rows(docs_of, prose):
    long = prose(30000, 5)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "two words"), (7, long), (8, long + " end"), (8, long + " end"), (None, long), (None, "alone here"), (9, "A b c d e"), (10, "a B\tc d\ne")]
    out = classes(duplicate_classes(docs_of(rows)))
    assert out == brute(rows)
    assert ("9", "9") in out and ("10", "9") in out and ("3", "1") in out and ("None", "None") in out


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert duplicate_classes(docs_of([])).count() == 0
    df = spark.createDataFrame([(1, "a b c", "x", "y"), (2, "a b c", "x", "y")], "doc_id long, text string, band string, label string")
    assert classes(duplicate_classes(df)) == [("1", "1"), ("2", "1")]
    assert [r.doc_id for r in deduplicated(df).collect()] == [1]
    df = spark.createDataFrame([(1, "a b c", "x", "y"), (2, "a b c", "x", "y")], "doc_id long, text string, row_key string, kept_key string")
    assert [tuple(r) for r in deduplicated(df).collect()] == [(1, "a b c", "x", "y")]


def test_one_of_each_class_stays(docs_of, prose):
    text, other, third = prose(100, 8), prose(90, 10), prose(80, 11)
    rows = [(3, text), (1, text), (1, text), (2, prose(50, 9)), (None, text), (5, text), (5, other), (7, third), (None, prose(20, 12)), (None, prose(20, 12))]
    kept = sorted((str(r.doc_id), r.text) for r in deduplicated(docs_of(rows)).collect())
    assert kept == sorted([("1", text), ("2", prose(50, 9)), ("5", other), ("7", third), ("None", prose(20, 12))])
    assert deduplicated(docs_of([])).count() == 0


def test_signatures_in_parts_are_the_same(monkeypatch):
    rnd = np.random.default_rng(2)
    row, elem, w = np.zeros(3000, np.int64), rnd.integers(0, 2**63, 3000, dtype=np.uint64), rnd.integers(1, 700, 3000)
    whole = signatures(row, elem, w, 1)
    once = signatures(row, elem, w * 0 + 1, 1)
    for units in (1 << 8, 1 << 12):
        monkeypatch.setattr(neardup, "_UNITS", units)
        assert (signatures(row, elem, w, 1) == whole).all() and (signatures(row, elem, w * 0 + 1, 1) == once).all()


def test_band_arithmetic():
    assert 1 - (1 - 0.8**ROWS) ** BANDS == pytest.approx(1, abs=1e-5)


@pytest.mark.parametrize("two", [False, True])
def test_blocks_keep_all_that_is_connected(two):
    rnd = np.random.default_rng(5)
    base = np.unique(rnd.integers(0, 2**63, 60, dtype=np.uint64))
    for _ in range(20):
        values = [np.unique(np.concatenate([rnd.choice(base, rnd.integers(30, 60), replace=False), rnd.integers(0, 2**63, rnd.integers(0, 12), dtype=np.uint64)])) for _ in range(40)] + [base, base.copy(), base[:48]]
        sides = rnd.integers(0, 2, len(values)) if two else np.zeros(len(values), np.int64)

        def parts(pairs):
            up = list(range(len(values)))
            for a, b in pairs:
                up = [up[a] if u == up[b] else u for u in up]
            return sorted(tuple(i for i, u in enumerate(up) if u == g) for g in set(up))

        every = [(a, b) for a in range(len(values)) for b in range(a) if (sides[a] != sides[b] or not two) and overlap(values[a].tobytes(), values[b].tobytes()) >= 0.8]
        got = linked(values, sides, 0.8)
        assert parts(got) == parts(every) and len(got) < len(values)
        assert all(overlap(values[a].tobytes(), values[b].tobytes()) >= 0.8 for a, b in got)


def test_components(spark):
    rnd = random.Random(9)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(150)] + [(2000, 2001 + i) for i in range(80)] + [(5, 5)]
    up = {n: n for e in edges for n in e}
    for a, b in edges:
        low, high = sorted((up[a], up[b]))
        up = {n: low if u == high else u for n, u in up.items()}
    lone = {n for n in up if all(n not in e or e[0] == e[1] for e in edges)}
    out = neardup.components(Stage(spark, "test"), spark.createDataFrame(edges, "a long, b long"), "c")
    assert {r.node: r.label for r in out.collect()} == {n: u for n, u in up.items() if n not in lone}
    assert neardup.components(Stage(spark, "test"), spark.createDataFrame([], "a long, b long"), "c").count() == 0


def test_survivors_are_the_same_each_time_and_in_passes(spark, prose, docs_of):
    text = prose(80, 5)
    rows = [(i, text if i % 2 else prose(60, i), "s", "en", i % 7) for i in range(40)] + [(3, text, "t", "de", 1), (3, text, "a", "fr", 2), (1, text, "q", "es", 4), (1, text, "p", "es", 4)] * 2
    want = None
    for parts, limit in ((1, 1 << 20), (5, 200), (3, 40)):
        got = sorted(map(tuple, deduplicated(docs_of(rows).repartition(parts), limit=limit).collect()), key=str)
        assert len(got) == 21 and sum(r[1] == text for r in got) == 1
        assert want in (None, got)
        want = got


def test_pages_of_one_template_stay_apart(spark, prose, docs_of):
    frame = prose(110, 9)
    rows = [(i, f"{frame} {prose(40, 1000 + i)}") for i in range(60)]
    got = duplicate_classes(docs_of(rows)).collect()
    assert all(r["doc_id"] == r["class_id"] for r in got)


def test_plans_hold_few_copies_of_the_steps_below(spark, docs_of, prose):
    """The driver holds the plans, and each holds those of all kept tables that it reads, as often as it reads them."""
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    texts = [prose(60, seed=i) for i in range(4)]
    rows = [(10 * i + k, " ".join(t.split(" ")[k:])) for i, t in enumerate(texts) for k in range(3)]
    bus.waitUntilEmpty(30_000)
    before = max([store.executionsList().apply(i).executionId() for i in range(store.executionsCount())], default=-1)
    assert sorted(r.doc_id for r in deduplicated(docs_of(rows)).collect()) == [0, 10, 20, 30]
    bus.waitUntilEmpty(30_000)
    ran = [x for i in range(store.executionsCount()) if (x := store.executionsList().apply(i)).executionId() > before]
    assert len(ran) > 5
    assert max(x.physicalPlanDescription().count("MapInArrow") for x in ran) <= 20
