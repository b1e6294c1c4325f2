import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from attesta.llm.queries import URL_RULES
from attesta.llm.url_filter import _CODE, END, MIN_CONTEXT, ORDER, SIZE, CharModel, _grams, url_filter

URLS = "page_id long, url string"


def split(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def rule_of(url, rules=URL_RULES):
    host, path = split(url)
    fit = [(len(r), r, v) for v, r in rules if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return max(fit)[1:] if fit else (None, None)


ODD = [
    "http://example.org/es/x", "http://A.B.Example.ORG/es/x?q#f", "https://example.org/en/12", "https://example.org/en/2", "https://badexample.org/es/", "http://x.com/fr/", "http://x.com/fr", "http://com/de/1",
    "http://notcom/de/1", "http://example.org", "http://example.org?x=/es/", "http://example.org#/es/", "no scheme.org/es/", "", None, "://", "a://b://c.org/", "http://ÄB.org/ü", "http://u@h.org:80/", "http://x.org/es\n/", "HTTP://X.NET/FR/",
]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([*enumerate(ODD), (None, "http://x.org/"), (3, ODD[3]), (3, ODD[3])], URLS)
    rows = url_filter(df, URL_RULES).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        if r.page_id is not None:
            url = ODD[r.page_id]
            rule, verdict = rule_of(url)
            assert (r.host, r.path, r.rule) == (*split(url), rule)
            assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_models_learn_what_the_rules_say(spark):
    rows = [(i, f"http://site{i % 37}.com/{lang}/{i}") for i in range(600) for lang in ("fr", "de")]
    held = [(10_000 + i, f"http://other{i}.net/{lang}/{i * 7}") for i in range(40) for lang in ("fr", "de")]
    got = {(r.page_id, r.path[1:3]): r for r in url_filter(spark.createDataFrame(rows + held, URLS), URL_RULES).where("page_id >= 10000").collect()}
    right = sum((r.verdict == "allow") == (lang == "fr") for (_, lang), r in got.items())
    assert right == len(got) == 80 and all(r.rule is None for r in got.values())


def test_probabilities_sum_to_one():
    raw, offsets = np.frombuffer(b"http://abc.dehttp://abd.fr", np.uint8), np.array([0, 13, 26])
    _, codes = _grams(raw, offsets, 3)
    every, n = np.unique(np.concatenate(codes), return_counts=True)
    model = CharModel(every, n, 1)
    for i in (0, 5, 11):
        bases = [c[i] // SIZE * SIZE for c in codes]
        p = np.exp(model.log_prob([b + np.arange(SIZE) for b in bases]))
        assert abs(p.sum() - 1) < 1e-9


def test_nothing_to_learn_from(spark):
    got = url_filter(spark.createDataFrame([(1, "http://x.net/"), (2, None)], URLS), URL_RULES).collect()
    assert {(r.score, r.p_allow, r.verdict) for r in got} == {(0.0, 0.5, "allow")}
    assert url_filter(spark.createDataFrame([], URLS), URL_RULES).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://x.org/", "h", 1.0)], URLS + ", host string, score double")
    assert url_filter(df, URL_RULES).first().host == "x.org"


def symbols(url):
    return [_CODE[b] for b in url.encode()] + [END]


def plain_model(urls):
    """Counts of each symbol after 0 to ORDER symbols; before a URL's start there are ends."""
    counts = defaultdict(Counter)
    for url in urls:
        padded = [END] * ORDER + symbols(url)
        for i in range(ORDER, len(padded)):
            for k in range(ORDER + 1):
                counts[tuple(padded[i - k : i])][padded[i]] += 1
    return counts


def plain_log(counts, url):
    padded, total = [END] * ORDER + symbols(url), 0.0
    for i in range(ORDER, len(padded)):
        p = 1 / SIZE
        for k in range(ORDER + 1):
            seen = counts.get(tuple(padded[i - k : i]), {})
            n = sum(seen.values())
            if seen and (k == 0 or n >= MIN_CONTEXT):
                p = (seen.get(padded[i], 0) + len(seen) * p) / (n + len(seen))
        total += math.log(p)
    return total


def test_scores_and_verdicts_are_those_of_a_plain_count(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    more = [(10_000 + i, f"http://shop{i % 13}.com/{'fr' if i % 2 else 'de'}/item-{i * 7919 % 1000}?q={i}") for i in range(300)] + [(20_000 + i, u) for i, u in enumerate(ODD) if u]
    pages = pages.union(spark.createDataFrame(more, URLS))
    rows = [(r.page_id, r.url or "", r.held) for r in pages.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(5)) == 0).collect()]
    said = {True: "allow", False: "block"}
    models = {v: plain_model([u for _, u, held in rows if not held and rule_of(u)[1] == said[v]]) for v in (True, False)}
    score = {u: (plain_log(models[True], u) - plain_log(models[False], u)) / (len(u.encode()) + 1) for _, u, _ in rows}
    held = [(score[u], rule_of(u)[1] == "allow") for _, u, h in rows if h and rule_of(u)[1]]
    x, y = np.array([s for s, _ in held]), np.array([g for _, g in held], float)
    w = np.where(y == 1, 1 / y.sum(), 1 / (1 - y).sum())
    a, b = 1.0, 0.0
    for _ in range(20_000):  # the same curve by plain descent
        g = w * (1 / (1 + np.exp(-(a * x + b))) - y)
        a, b = a - 0.5 * ((g * x).sum() + 1e-3 * (a - 1)), b - 0.5 * (g.sum() + 1e-3 * b)
    got = url_filter(pages, URL_RULES).collect()
    unsure = 0
    for r, (_, u, _) in zip(sorted(got, key=lambda r: r.page_id), sorted(rows), strict=True):
        assert math.isclose(r.score, score[u], abs_tol=1e-9)
        p = 1 / (1 + math.exp(-(a * score[u] + b)))
        assert abs(p - r.p_allow) < 0.03
        unsure += abs(p - 0.5) < 0.03
        if not rule_of(u)[1] and abs(p - 0.5) >= 0.03:
            assert r.verdict == ("allow" if p >= 0.5 else "block")
    assert unsure < len(rows) / 10 and len(held) > 20
