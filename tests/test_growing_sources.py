"""Throttle slots, the ledger of calls, the pages source, the crawl frontier, the registry in batches, counters and arrays."""

from __future__ import annotations

import heapq
import json
from collections import defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.operators import crawl, extraction, sources
from attesta.sources import files, pages, providers
from attesta.sources.ledger import Ledger
from attesta.sources.registry import Registry


def test_starts_of_a_host_are_a_delay_apart_in_the_order_asked_for(spark):
    urls = spark.createDataFrame([(i, f"http://{'hot' if i % 3 else f'h{i % 4}'}.org/{i}") for i in range(60)], "ord long, url string").repartition(5)
    rows = providers.with_slots(urls, 4, 0.5).collect()
    by_host = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["ord"]):
        by_host[r["url"].split("/")[2]].append(r)
    for mine in by_host.values():
        assert [r["starts"] for r in mine] == [0.5 * i for i in range(len(mine))]
    assert {r["lane"] for r in by_host["hot.org"]} == {0, 1, 2, 3}
    assert sorted(r["starts"] for r in providers.with_slots(urls, 4, 0.5, per_host=False).collect()) == [0.5 * i for i in range(60)]


def test_lanes_wait_for_their_slots(spark, tmp_path):
    began = 1000.0

    def clock():
        files_ = sorted(tmp_path.glob("*"))
        return began + sum(float(p.read_text()) for p in files_)

    def wait(seconds):
        (tmp_path / f"{len(list(tmp_path.glob('*'))):05d}").write_text(str(seconds))

    urls = spark.createDataFrame([(i, f"http://a.org/{i}") for i in range(6)], "ord long, url string")
    got = providers.acquire(urls, lambda url: {"raw_markdown": str(clock())}, concurrency=1, pause=2.0, clock=clock, wait=wait).collect()
    assert [(r["ord"], float(r["raw_markdown"])) for r in got] == [(i, began + 2.0 * i) for i in range(6)]


def test_results_in_request_order(spark):
    urls = spark.createDataFrame([(0, "u"), (1, "v"), (2, "w")], "ord long, url string")
    got = providers.acquire(urls.where("ord <> 1"), lambda url: {"raw_markdown": url})
    rows = providers.in_request_order(urls, got.unionByName(got.where("url = 'u'"))).orderBy("ord").collect()
    assert [(r["url"], r["success"], r["error"], r["raw_markdown"]) for r in rows] == [("u", True, None, "u"), ("v", False, "the provider gave no result", ""), ("w", True, None, "w")]


def test_a_repeated_task_reads_what_it_paid_for(spark, tmp_path):
    calls, broken = tmp_path / "calls", tmp_path / "broken"
    calls.mkdir()
    ledger = Ledger(f"file://{tmp_path}/ledger")

    def provider(url, content):
        n = len(list(calls.iterdir()))
        (calls / f"{n}-{content}").write_text("")
        return [{"data": {"n": content}, "confidence": 0.5}]

    def fails_once(frames):
        for frame in frames:
            for content in frame["content"]:
                ledger.once(["u", content, "s"], lambda c=content: provider("u", c))
            if not broken.exists():
                broken.write_text("")
                raise RuntimeError("the executor is lost")
            yield frame

    chunks = spark.createDataFrame([("u", f"c{i}", f"text{i}", 0) for i in range(5)], "source_url string, chunk_id string, content string, chunk_index int").coalesce(1)
    with pytest.raises(Exception, match="the executor is lost"):
        chunks.mapInPandas(fails_once, chunks.schema).collect()
    routes = spark.createDataFrame([("u", "semantic")], "source_url string, method string")
    rows = extraction.semantic_extract(chunks, routes, provider, ledger, "s").collect()
    assert sorted(json.loads(r["data"])["n"] for r in rows) == [f"text{i}" for i in range(5)]
    assert len(list(calls.iterdir())) == 5
    assert extraction.semantic_extract(chunks, routes, provider, ledger, "another schema").count() == 5
    assert len(list(calls.iterdir())) == 10


def test_a_failed_call_leaves_nothing_and_an_unknown_store_is_an_error(tmp_path):
    ledger = Ledger(str(tmp_path / "l"))
    with pytest.raises(ZeroDivisionError):
        ledger.once(["x"], lambda: 1 // 0)
    assert ledger.once(["x"], lambda: [1]) == [1] == ledger.once(["x"], lambda: [2])
    with pytest.raises(Exception, match="(?i)unrecognized|filesystem"):
        Ledger("dbfs:/x")


def test_the_pages_source(spark, sf_dir, tmp_path):
    pages.register(spark)
    read = lambda **o: spark.read.format(pages.NAME).options(path=f"{sf_dir}/pages.parquet", **o).load()
    want = {r["url"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = read(lanes=3).collect()
    assert {r["url"]: r["html"] for r in rows} == want
    assert sorted(r["ord"] for r in rows) == list(range(len(rows)))
    assert read(limit=3).count() == 3
    one = sorted(want)[0]
    asked = read().where(F.col("url") == one)
    assert [r["html"] for r in asked.collect()] == [want[one]]
    some = read(urls=f"{one}\nhttp://none.org/x").orderBy("ord").collect()
    assert [(r["url"], r["success"], r["error"]) for r in some] == [(one, True, None), ("http://none.org/x", False, "LookupError: not found")]


def test_a_whole_fixture_is_read_by_row_groups(spark, tmp_path):
    pages.register(spark)
    rows = [(f"http://a.org/{i % 40}" if i % 10 else None, f"page {i}" if i % 7 else None) for i in range(1000)]
    for n in range(2):
        pq.write_table(pa.table({"url": [u for u, _ in rows[n::2]], "html": [h for _, h in rows[n::2]]}), tmp_path / f"{n}.parquet", row_group_size=90)
    rows = rows[::2] + rows[1::2]
    read = lambda **o: spark.read.format(pages.NAME).options(path=str(tmp_path), **o).load()
    got = sorted((r["ord"], r["url"], r["html"], r["raw_markdown"], r["success"]) for r in read().collect())
    assert got == [(o, u, h, h or "", True) for o, (u, h) in enumerate(rows) if u]  # repeated URLs have their own pages
    one = read().where(F.col("url") == "http://a.org/3")
    assert sorted(r["ord"] for r in one.collect()) == [o for o, (u, _) in enumerate(rows) if u == "http://a.org/3"]
    assert sorted(r["ord"] for r in read(limit=123).collect()) == [o for o, (u, _) in enumerate(rows[:123]) if u]


def test_a_fixture_is_read_once_for_all_urls_and_never_listed(spark, tmp_path, monkeypatch):
    pq.write_table(pa.table({"url": [f"http://a.org/{i}" for i in range(1000)], "html": [f"page {i}" for i in range(1000)]}), tmp_path / "p.parquet", row_group_size=100)
    passes, whole = [], pq.ParquetFile.iter_batches
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda self, size, groups, columns: passes.extend(groups) or whole(self, size, groups, columns))
    schema = T.StructType.fromDDL(providers.FETCHED)

    def run(reader, parts):
        return sorted((r["ord"], r["url"], r["html"], r["error"]) for p in parts for b in reader.read(p) for r in b.to_pylist())

    reader = pages.PagesReader({"path": str(tmp_path), "urls": "\n".join(f"http://a.org/{i}" for i in range(300, 1100)), "lanes": "1"}, schema)
    got = run(reader, reader.partitions())
    assert got[0] == (0, "http://a.org/300", "page 300", None) and got[-1] == (799, "http://a.org/1099", None, "LookupError: not found")
    assert len(got) == 800 and passes == list(range(3, 10))
    monkeypatch.setattr(pages, "PART_BYTES", 1)
    reader = pages.PagesReader({"path": str(tmp_path)}, schema)
    assert [len(p.pieces) for p in reader.partitions()] == [1] * 10
    stream = pages.PagesStream({"path": str(tmp_path), "batch": "150"}, schema)
    at, seen = stream.initialOffset(), []
    for _ in range(8):
        end = stream.latestOffset()
        seen += [o for o, *_ in run(stream, stream.partitions(at, end))] if end != at else []
        at = end
    assert seen == list(range(1000))


def test_pages_as_a_stream(spark, sf_dir, tmp_path):
    pages.register(spark)
    known = [r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").limit(7).collect()]
    asked = tmp_path / "urls"
    asked.write_text("".join(f"{u}\n" for u in known[:5]) + known[5])  # the last line is still being written
    stream = spark.readStream.format(pages.NAME).options(path=f"{sf_dir}/pages.parquet", urls=str(asked), batch=2).load()

    def run():
        q = stream.select("ord", "url", "success").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "out"))
        try:
            for _ in range(60):
                q.awaitTermination(1)
                done = (q.lastProgress or {}).get("sources")
                if done and int("".join(c for c in str(done[0]["endOffset"]) if c.isdigit())) >= len(asked.read_text().split("\n")) - 1:
                    break
        finally:
            q.stop()
        return sorted((r["ord"], r["url"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == list(enumerate(known[:5]))


def plain_crawl(starts, links, terms, max_depth, max_pages, a_round):
    """The frontier in plain Python."""
    host = lambda u: u.split("/")[2]
    waiting, seen, used, out, n = [(s, s, "", 0) for s in starts], {(s, s) for s in starts}, defaultdict(int), [], 0
    while waiting:
        score = lambda w: sum(t in f"{w[1]} {w[2]}".lower() for t in terms)
        by_host = defaultdict(list)
        for w in waiting:
            heapq.heappush(by_host[host(w[1])], ((-score(w), w[3], w[1], w[0]), w))
        now = []
        for h, heap in by_host.items():
            ranked = [heapq.heappop(heap)[1] for _ in range(len(heap))]
            now += ranked if n == 0 else [w for i, w in enumerate(ranked[:a_round], 1) if used[h] + i <= max_pages]
        if not now:
            break
        fresh = {}
        for s, u, _, d in now:
            if d:
                used[host(u)] += 1
                out.append((s, u, d))
            for link, title in links.get(u, []) if d < max_depth else []:
                if (s, link) not in seen and host(link) == host(s) and not link.endswith(".pdf"):
                    fresh[s, link] = min(fresh.get((s, link), (d + 1, u, title)), (d + 1, u, title))
        seen |= set(fresh)
        waiting = [w for w in waiting if w not in now] + [(s, u, t, d) for (s, u), (d, _, t) in fresh.items()]
        waiting = [w for w in waiting if used[host(w[1])] < max_pages]
        n += 1
    return sorted(out)


@pytest.mark.parametrize(("max_pages", "a_round"), [(100, 100), (7, 2)])
def test_the_frontier_takes_the_best_of_each_host(spark, max_pages, a_round):
    links = {}
    for h in ("a", "b"):
        for i in range(12):
            links[f"http://{h}.org/{i}"] = [(f"http://{h}.org/{j}", f"owl {j}" if j % 3 == 0 else f"crow {j}") for j in ((i * 2 + 1) % 12, (i * 3 + 2) % 12, (i + 5) % 12)]
    links["http://a.org/0"] += [("http://a.org/x.pdf", "owl"), ("http://z.org/0", "owl")]
    table = spark.createDataFrame([(u, to, title) for u, all_ in links.items() for to, title in all_], "url string, link string, title string").persist()
    starts = ["http://a.org/0", "http://b.org/0", "http://a.org/1"]
    found = crawl.crawl(spark.createDataFrame([(s,) for s in [*starts, "junk"]], "url string"), lambda wanted: wanted.join(table, "url").select("url", "link", "title"), ["OWL"], 3, max_pages, a_round).collect()
    assert sorted((r["start_url"], r["url"], r["depth"]) for r in found) == plain_crawl(starts, links, ["owl"], 3, max_pages, a_round)
    assert all(r["parent_url"] in links and r["success"] for r in found)


def test_batches_are_one_registry_and_touch_their_own_buckets(spark, tmp_path):
    kind = "ord long, url string, origin string, title string, description string, provider string, seed boolean, preferred boolean, metadata map<string,string>"
    rows = [(i, f"http://h{i % 9}.org/{'#x' * (i % 2)}", ["s", "t", ""][i % 3], "" if i % 4 else f"T{i}", "", ["Web", "web", "API"][i % 3], i % 5 == 0, False, {"k": str(i), f"k{i % 2}": "v"}) for i in range(40)] + [(50, "junk", "s", "", "", "", False, False, {})]
    found = spark.createDataFrame(rows, kind)
    held = Registry(spark, f"file://{tmp_path}/registry", 16)
    first = held.merge(found.where("ord % 3 = 2"))
    touched = held.merge(found.where("ord % 3 <> 2 and url like '%h1.org%'"))
    assert len(touched) == 1 < len(first)
    versions = json.loads((tmp_path / "registry/manifest.json").read_text())["versions"]
    assert len(set(versions.values())) == 2 and list(versions.values()).count(versions[str(touched[0])]) == 1
    held.merge(found)
    columns = ["canonical_url", "ord", "title", "description", "user_seed", "preferred_domain_match", "original_urls", "origins", "providers", "metadata", "domain"]
    as_text = lambda df: sorted(str(tuple(sorted(r[c].items()) if c == "metadata" else r[c] for c in columns)) for r in df.select(columns).collect())
    assert as_text(Registry(spark, f"file://{tmp_path}/registry").read()) == as_text(sources.registry_upsert(found))


def test_counters_are_taken_while_a_stage_is_written(spark, tmp_path):
    run = files.Run(spark, str(tmp_path), "r")
    with pytest.raises(RuntimeError, match="of"):
        run.path("x")
    run.of("a")
    seen = []
    make = lambda: (seen.append(1), spark.range(10))[1]
    for _ in range(2):
        run.stage("numbers", make, {"n": F.count("*"), "odd": F.count_if(F.col("id") % 2 == 1)})
    assert (len(seen), run.counted("numbers"), run.counted("none")) == (1, {"n": 10, "odd": 5}, None)
    run.of("b")
    assert not run.has("numbers")


def test_an_array_has_the_bytes_of_an_indented_list(spark, tmp_path):
    rows = [{"a": i, "b": {"c": ["é", None, f"x,\n{i}"]}} for i in range(25)]
    df = spark.createDataFrame([(r["a"], (r["b"]["c"],)) for r in rows], "a long, b struct<c:array<string>>").repartitionByRange(4, "a").sortWithinPartitions("a")
    files.write_records(df, str(tmp_path / "x.json"), "json")
    assert (tmp_path / "x.json").read_text() == json.dumps(rows, ensure_ascii=False, indent=2) + "\n"
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.json"]
