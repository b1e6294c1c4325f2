import random
from collections import Counter

import numpy as np
import pyarrow as pa

from attesta.llm._hash import low, shingles, slices, words
from attesta.llm import decontam
from attesta.llm.decontam import ItemIndex, contaminated, decontaminated, radius_for


def brute(docs, items, similarity=0.8):
    out = set()
    for item, text in items:
        need = (text or "").lower().split()
        if not need:
            continue
        g = min(5, len(need))
        want = Counter(tuple(need[i : i + g]) for i in range(len(need) - g + 1))
        for doc, t in docs:
            have = (t or "").lower().split()
            if len(have) < g or not set(need) & set(have):
                continue
            grams = [tuple(have[i : i + g]) for i in range(len(have) - g + 1)]
            width = min(len(need) - g + 1, len(grams))
            if not set(grams) & set(want):
                continue
            best = 0.0
            for i in range(len(grams) - width + 1):
                both = sum((Counter(grams[i : i + width]) & want).values())
                best = max(best, both / (width + sum(want.values()) - both))
            if best >= similarity:
                out.add((str(doc), item, round(best, 9)))
    return out


def found(df):
    return {(str(r.doc_id), r.item_id, round(r.similarity, 9)) for r in df.collect()}


def test_whole_tables_against_brute_force(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = found(contaminated(docs, items))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got


def test_edited_passages(spark, docs_of, prose):
    rnd = random.Random(4)
    items = [(i, prose(n, 100 + i)) for i, n in enumerate((1, 2, 4, 5, 6, 15, 30, 30, 59, 120))]
    docs = []
    for d in range(80):
        words_ = items[d % len(items)][1].split()
        for _ in range(rnd.randint(0, 3)):
            words_[rnd.randrange(len(words_))] = rnd.choice(["x", "yy", "zzz"])
        if rnd.random() < 0.2:
            words_ = words_[: -max(1, len(words_) // 10)]
        docs.append((d, " ".join([prose(rnd.randint(0, 300), d), *words_, prose(rnd.randint(0, 90), d + 1000)])))
    assert found(contaminated(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_no_fingerprint_within_the_radius_is_missed(prose):
    index = ItemIndex(list(range(50)), [prose(30, i) for i in range(50)])
    rnd = np.random.default_rng(0)
    for i in range(0, 50, 5):
        for distance in (0, 1, index.radius - 1, index.radius, index.radius + 1):
            flips = np.bitwise_or.reduce(np.uint64(1) << rnd.choice(64, distance, replace=False).astype(np.uint64)) if distance else np.uint64(0)
            _, item = index.near(np.array([index.prints[i] ^ flips]), 30)
            near = np.flatnonzero(np.bitwise_count(index.prints ^ (index.prints[i] ^ flips)) <= index.radius)
            assert item.tolist() == near.tolist()


def test_radius_covers_the_similarity():
    assert radius_for(1.0) == 0 and 15 <= radius_for(0.8) <= 22 and radius_for(0.5) > radius_for(0.8)


def test_odd_rows(spark, docs_of, prose):
    item = prose(40, 1)
    items = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, " ", "x"), (1, item, "x")], "item_id long, text string, doc_id string")
    docs = [(1, None), (2, ""), (3, item), (None, item), (3, item), (4, prose(200_000, 3) + " " + item), (5, " ".join(item.split()[:37]))]
    got = contaminated(docs_of(docs), items.dropDuplicates())
    assert found(got) == brute(docs, [(1, item)])
    assert sorted(map(str, (r.doc_id for r in decontaminated(docs_of(docs), items).collect()))) == ["1", "2"]
    kept = decontaminated(docs_of([(6, item), (6, "clean words only"), (None, item), (None, None), (7, "x"), (7, "x")]), items)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("6", "clean words only"), ("7", "x"), ("7", "x"), ("None", "None")]
    assert decontaminated(docs_of(docs), items.limit(0)).count() == len(docs) and decontaminated(docs_of([]), items).count() == 0
    assert contaminated(docs_of([]), items).count() == 0
    assert contaminated(docs_of(docs), items.limit(0)).count() == 0


def test_word_hashes_agree_with_python(prose):
    texts = [prose(n, n) for n in (0, 1, 4, 5, 9)] + [None, "  a\tb ", "É é", "a  b", "x" * 100]
    for _, raw, offsets in slices(pa.array(texts)):
        raw, offsets = low(raw, offsets)
        h, start, end, firsts = words(raw, offsets)
        text = raw.tobytes()
        mine = [[text[a:b].decode() for a, b in zip(start[firsts[i] : firsts[i + 1]], end[firsts[i] : firsts[i + 1]])] for i in range(len(texts))]
        assert mine == [(t or "").lower().split() for t in texts]
        names = {}
        assert all(names.setdefault(w, x) == x for ws, i in zip(mine, range(len(texts))) for w, x in zip(ws, h[firsts[i] : firsts[i + 1]].tolist()))
        assert len(set(names.values())) == len(names)
        _, first = shingles(h, firsts)
        assert np.diff(first).tolist() == [max(min(len(w), 1), len(w) - 4) for w in mine]


def test_a_benchmark_of_several_parts(spark, docs_of, prose, monkeypatch):
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 2)
    items = [(i, prose(30, i)) for i in range(5)] + [(9, None), (10, "")]
    docs = [(i, f"{prose(20, 50 + i)} {items[i % 5][1]}" if i % 2 else prose(60, 70 + i)) for i in range(20)]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found(contaminated(docs_of(docs), table)) == brute(docs, items)
    assert sorted(r.doc_id for r in decontaminated(docs_of(docs), table).collect()) == list(range(0, 20, 2))
