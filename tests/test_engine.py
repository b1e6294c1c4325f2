import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from attesta.operators import sources
from attesta.plans.engine import Engine, NotApproved
from attesta.sources import config, files, planning, providers
from attesta.streaming import ingest

REQUEST = {
    "name": "people", "schema": [{"field_name": "full_name", "type": "string", "required": True}, {"field_name": "age", "type": "integer"}], "identity_fields": ["full_name"], "profiles": ["structured", "rag", "graph_rag"],
    "rules": [{"id": "r", "method": "regex", "url_pattern": "prose", "patterns": {"full_name": r"Name: (\w+)"}}],
}
PROFILE = "ord long, url string, preview_text string, source_type string, content_depth string, authority_score double, technical_depth_score double, information_density_score double, extractability_score double, recency_score double, content_characteristics array<string>, topic_relevance_score double, preview_success boolean"
TABLE = "Some words before the table so that the document is long enough.\n\n| Full Name | Age |\n|---|---|\n| Ada | 36 |\n| Bob | 7 |\n"


def inputs(spark):
    urls = ["http://a.com/table", "http://b.com/prose", "http://c.com/copy"]
    profiles = [(i, u, f"preview {min(i, 2)}", "doc", "deep", 0.9, 0.8, 0.9, 0.9, None, ["x"], 0.9, True) for i, u in enumerate(urls)]
    texts = [TABLE, "Name: Ada. " + "More words are here to read. " * 4, TABLE.replace("Bob", "Cy")]
    fetched = [(u, None, True, None, t, None, "", {"title": f"T{i}"}) for i, (u, t) in enumerate(zip(urls, texts))]
    return spark.createDataFrame(profiles, PROFILE), spark.createDataFrame(fetched, "url string, redirected_url string, success boolean, error string, raw_markdown string, fit_markdown string, html string, metadata map<string,string>")


def test_a_run_from_candidates_to_files(spark, tmp_path):
    candidates, fetched = inputs(spark)
    settings = config.Settings(minimum_content_words=5, output_format="jsonl")
    engine = Engine(spark, str(tmp_path / "runs"), "people run/1", REQUEST, settings)
    with pytest.raises(NotApproved):
        engine.execute(candidates, fetched, str(tmp_path / "out"))
    engine.approve("tester")
    counts = engine.execute(candidates, fetched, str(tmp_path / "out"))
    assert counts == {"structured": 3, "rag": 3, "graphrag": 3}
    rag = [json.loads(x) for p in Path(tmp_path, "out/rag").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(r["text"] for r in rag) == ["Full Name: Ada\nAge: 36", "Full Name: Bob\nAge: 7", "Full Name: Cy\nAge: 7"]
    ada = next(r for r in rag if "Ada" in r["text"])
    assert len(ada["source_urls"]) == 3
    graph = [json.loads(x) for p in Path(tmp_path, "out/graphrag").glob("part-*") for x in p.read_text().splitlines()]
    assert all([e["name"] for e in g["entities"]] == [c["value"].strip('"') for c in g["claims"] if c["predicate"] == "full_name"] and g["record_key"] for g in graph)
    manifest = engine.run.manifest()
    m = manifest["metrics"]
    assert manifest["status"] == "completed" and manifest["outputs"] == counts
    assert (m["evaluation_select"], m["requested"], m["routing_table"], m["routing_regex"], m["gate_true"], m["resolution_total"], m["resolution_cross_source"], m["output_records"]) == (3, 3, 2, 1, 5, 3, 1, 3)
    gold = {r.title + r.resolution_key: r for r in spark.read.parquet(engine.run.path("gold")).collect()}
    assert sorted(len(r.contributors) for r in gold.values()) == [1, 1, 3] and all(len(r.source_titles) == len(r.source_urls) for r in gold.values())
    assert spark.read.parquet(engine.run.path("registry_after")).where("selection_state = 'selected'").count() == 3
    again = Engine(spark, str(tmp_path / "runs"), "people run/1", REQUEST, settings)
    assert again.execute(candidates, fetched.limit(0), str(tmp_path / "out")) == counts
    again.cancel()
    with pytest.raises(NotApproved):
        again.schema()


def test_what_stages_turn_away_and_another_request(spark, tmp_path):
    candidates, fetched = inputs(spark)
    bad = spark.createDataFrame([(7, "http://d.com/none", "p7", "doc", "deep", 0.9, 0.8, 0.9, 0.9, None, ["x"], 0.9, True), (8, "http://e.com/poor", "p8", "doc", "deep", 0.1, 0.1, 0.1, 0.1, None, ["x"], 0.1, True), (9, "junk", "p9", "doc", "deep", 0.9, 0.8, 0.9, 0.9, None, ["x"], 0.9, True)], PROFILE)
    settings = config.Settings(minimum_content_words=5, output_format="json", save_clean_content=True)
    engine = Engine(spark, str(tmp_path / "runs"), "r", REQUEST, settings)
    engine.approve("tester")
    crawled = spark.createDataFrame([("http://a.com/table", 0, "http://a.com/more", "t", 1, "http://a.com/table", True), ("http://a.com/table", 1, "http://z.com/x", "t", 1, "http://a.com/table", True)], "start_url string, ord long, url string, title string, depth int, parent_url string, success boolean")
    engine.execute(candidates.union(bad), fetched, str(tmp_path / "out"), crawled=crawled)
    gone = {(r.stage, r.what) for r in spark.read.parquet(engine.run.path("rejections")).collect()}
    assert {("evaluation", "http://e.com/poor"), ("acquisition", "http://d.com/none")} <= gone and ("registry", "junk") in gone
    assert [r.url for r in spark.read.parquet(engine.run.path("explored")).collect()] == ["http://a.com/more"]
    known = {r.canonical_url: r for r in spark.read.parquet(engine.run.path("registry_after")).collect()}
    assert known["http://a.com/more"].origins == ["exploration:http://a.com/table"] and known["http://a.com/more"].selection_state == "pending"
    assert len(known) == 6
    assert len(json.loads((tmp_path / "out/structured.json").read_text())) == 3 and len(json.loads((tmp_path / "out/clean.json").read_text())) == 3
    other = Engine(spark, str(tmp_path / "runs"), "r", REQUEST | {"max_sources": 1}, settings)
    assert other.execute(candidates, fetched, str(tmp_path / "out2"))["structured"] < 3


def test_previews_decide_and_seeds_fill_in(spark, tmp_path):
    candidates, fetched = inputs(spark)
    seen = spark.createDataFrame([("http://a.com/table", True, "a text", "T"), ("HTTP://B.com/prose", True, "b text", "T"), ("http://c.com/copy", False, "", "T")], "url string, fetch_success boolean, relevant_text string, title string").withColumn("error", F.lit(None).cast("string"))
    settings = config.Settings(minimum_content_words=5)
    engine = Engine(spark, str(tmp_path / "runs"), "p", REQUEST, settings)
    evaluated = engine.evaluate(candidates.drop("preview_success", "preview_text"), seen)
    assert {(r.url, r.preview_text, r.decision) for r in evaluated.collect()} == {("http://a.com/table", "a text", "select"), ("http://b.com/prose", "b text", "select"), ("http://c.com/copy", "", "reject")}
    state = sources.registry_previews(sources.registry_decisions(engine.register(candidates), evaluated.select("canonical_url", "decision", F.col("hard_reasons").alias("reasons"))), seen.limit(2))
    assert sorted((r.canonical_url[7], r.preview_status, r.evaluation_status, r.selection_state) for r in state.collect()) == [("a", "success", "completed", "selected"), ("b", "success", "completed", "selected"), ("c", "pending", "completed", "rejected")]
    drawn = sources.schema_previews(engine.select(evaluated), seen)
    assert sorted((r.url, r.has_preview) for r in drawn.collect()) == [("http://a.com/table", True), ("http://b.com/prose", True)]
    seeds = spark.createDataFrame([(2, "http://y.com/", True), (1, "http://x.com/", True), (0, "http://w.com/", False)], "ord long, url string, user_seed boolean")
    assert [(r.url, r["rank"]) for r in sources.seed_fallback(evaluated.limit(0), seeds).orderBy("rank").collect()] == [("http://x.com/", 1), ("http://y.com/", 2)]
    assert sources.seed_fallback(evaluated, seeds).count() == 0


def test_research_finds_and_previews_candidates(spark, tmp_path):
    request = {"topic": "Birds", "research": {"queries": ["owls", "owls ", "crows"]}, "sources": {"seed_urls": ["http://seed.org/"], "preferred_domains": ["b.com"]}}
    engine = Engine(spark, str(tmp_path / "runs"), "s", request, config.Settings(fetch_delay_seconds=0.0, fetch_retries=0))
    found = engine.search(lambda query, most: [{"url": f"http://{x}.com/{query}", "title": query} for x in "ab"] + [{"title": "no url"}])
    rows = found.orderBy("ord").collect()
    assert [(r.url, r.seed, r.preferred) for r in rows] == [("http://seed.org/", True, False), ("http://a.com/owls", False, False), ("http://b.com/owls", False, True), ("http://a.com/crows", False, False), ("http://b.com/crows", False, True)]
    assert engine.run.manifest()["plan"]["research_topic"] == "Birds"

    def fetch(url):
        if "crows" in url:
            raise ValueError("unauthorized")
        return {"raw_markdown": f"# Head\n\ntext of {url}", "metadata": {"title": "T"}}

    cache = spark.createDataFrame([("http://seed.org/", None, True, "known")], "url string, query string, fetch_success boolean, relevant_text string")
    seen = {r.url: r for r in engine.preview(found, fetch, cache).collect()}
    assert len(seen) == 5 and seen["http://seed.org/"].relevant_text == "known" and seen["http://a.com/owls"].headings == ["Head"] and not seen["http://b.com/crows"].fetch_success


def test_nothing_acquired_ends_the_run(spark, tmp_path):
    candidates, fetched = inputs(spark)
    engine = Engine(spark, str(tmp_path / "runs"), "n", REQUEST, config.Settings(require_schema_approval=False))
    with pytest.raises(RuntimeError):
        engine.execute(candidates, fetched.limit(0), str(tmp_path / "out"))


def test_acquisition_keeps_order_and_failures(spark):
    def fetch(url):
        if "bad" in url:
            raise ValueError("no")
        return {"raw_markdown": url, "metadata": {"title": "t"}}

    urls = spark.createDataFrame([(i, f"http://{'bad' if i == 2 else 'ok'}{i}.com/") for i in range(5)], "ord long, url string")
    got = providers.acquire(urls, fetch, retries=0).orderBy("ord").collect()
    assert [r.success for r in got] == [True, True, False, True, True] and got[2].error == "ValueError: no" and got[4].raw_markdown == "http://ok4.com/"


def test_retries():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("reset")
        return "ok"

    assert providers.with_retries(flaky, retries=2, wait=waits.append) == "ok" and waits == [1.0, 2.0]
    with pytest.raises(ValueError):
        providers.with_retries(lambda: (_ for _ in ()).throw(ValueError("Authentication failed")), wait=waits.append)
    assert len(waits) == 2


def test_errors_that_may_pass():
    coded = lambda name, code: type("Coded", (Exception,), {name: code})()
    final = [Exception(m) for m in ("Authentication failed", "missing API key", "bad configuration", "Invalid model x", "VALIDATION ERROR", "Forbidden")]
    final += [coded("status_code", 404), coded("status", 422), type("ValidationError", (ValueError,), {})("x")]
    assert not any(map(providers.is_retryable, final))
    assert all(map(providers.is_retryable, [Exception("invalid response"), Exception("not found"), ValueError("bad"), coded("status_code", 503), TimeoutError()]))


def test_search_seeds_and_preview_cache(spark):
    hits = providers.search(spark, ["q"], lambda q, n: [{"url": "http://a.com", "title": "A"}, {"title": "no url"}], 5)
    assert [(r.url, r.origin) for r in hits.union(providers.seeds(spark, ["http://s.com"])).orderBy("ord").collect()] == [("http://s.com", "seed"), ("http://a.com", "search:q")]
    wanted = spark.createDataFrame([("u", "q"), ("u", None), ("v", "q")], "url string, query string")
    assert sorted(r.url for r in providers.missing_previews(wanted, wanted.limit(1)).collect()) == ["u", "v"]


def test_configuration(tmp_path):
    raw = {"research": {"reference_urls": ["a"], "preferred_domains": ["x"], "goal": "g"}, "sources": {"preferred_domains": ["y"]}}
    assert config.normalise_request(raw) == {"research": {"preferred_domains": ["x"], "goal": "g"}, "sources": {"preferred_domains": ["y"], "seed_urls": ["a"]}}
    assert raw["research"]["reference_urls"] == ["a"]
    (tmp_path / "domain.json").write_text('{"a": 1, "quality": {"q": 0}}')
    (tmp_path / "validation.json").write_text('{"quality": {"q": 1}}')
    assert config.load_domain(tmp_path) == {"a": 1, "quality": {"q": 1}, "research": {}, "sources": {}, "mock_sources": []}
    assert config.read_config(tmp_path / "none.json") == {}
    with pytest.raises(ValueError):
        config.load_domain(tmp_path / "none")
    assert config.Settings.load(environment={"ATTESTA_CHUNK_TARGET_TOKENS": "50", "ATTESTA_CHUNK_OVERLAP_TOKENS": "5", "ATTESTA_CHUNKING_ENABLED": "no"}).chunk_target_tokens == 50
    with pytest.raises(ValueError):
        config.Settings.load(environment={"ATTESTA_CHUNK_TARGET_TOKENS": "0"})


def test_plans_and_contracts():
    made = planning.plan({"research": {"queries": ["Q one", "q ONE", "two"]}, "sources": {"source_policy": {"blocked_source_types": ["forum"]}}}, "Topic", 2)
    assert made["search_queries"] == ["Q one", "q ONE"] and made["excluded_source_types"] == ["forum"] and planning.query_terms(made) == ["Topic", "Q one"]
    assert planning.plan({}, "") == {} and planning.plan({}, "T")["search_queries"] == ["T"]
    strict = planning.strict_schema({"title": "x", "properties": {"a": {"type": "object", "default": 1}, "b": {"anyOf": [{"type": "object", "properties": {"c": {}}}]}}})
    assert strict["required"] == ["a", "b"] and strict["properties"]["a"] == {"type": "object", "additionalProperties": False, "required": []} and strict["properties"]["b"]["anyOf"][0]["required"] == ["c"] and "title" not in strict
    assert planning.json_safe({1: (1, None, {2})}) == {"1": [1, None, "{2}"]}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "a long, b string").coalesce(1)
    files.write_records(df, str(tmp_path / "x.json"), "json")
    assert json.loads((tmp_path / "x.json").read_text()) == [{"a": 1, "b": "é"}, {"a": 2}]
    files.write_records(df.limit(0), str(tmp_path / "y.json"), "json")
    assert json.loads((tmp_path / "y.json").read_text()) == []
    files.write_records(df, str(tmp_path / "l"), "jsonl")
    assert files.load_fixture(spark, str(tmp_path / "x.json")).count() == 2 == spark.read.json(str(tmp_path / "l")).count()
    with pytest.raises(ValueError):
        files.write_records(df, str(tmp_path / "z"), "xml")
    assert files.safe_name("a b/ç:c") == "a_b_c" and files.safe_name("//") == "run"


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("http://a.com/#1", "2024-01-01 00:00:00"), ("http://A.com/", "2024-01-01 00:01:00"), ("http://b.com/x", "2024-01-01 00:20:00"), ("junk", "2024-01-01 00:20:00")], "url string, seen_at string")
    rows.withColumn("seen_at", F.to_timestamp("seen_at")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.stream_of(spark, str(tmp_path / "in"), "url string, seen_at timestamp")
    q = ingest.new_candidates(stream).writeStream.format("memory").queryName("fresh").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.canonical_url for r in spark.table("fresh").collect()) == ["http://a.com/", "http://b.com/x"]
    docs = spark.createDataFrame([("menu\nHello  there",)], "content string")
    docs.write.parquet(str(tmp_path / "docs"))
    q = ingest.clean_into(ingest.stream_of(spark, str(tmp_path / "docs"), "content string"), str(tmp_path / "clean"), str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.cleaned_content for r in spark.read.parquet(str(tmp_path / "clean")).collect()] == ["Hello there"]


def test_proposals_that_dont_agree_end_the_run(spark, tmp_path):
    candidates, fetched = inputs(spark)
    plain = candidates.select("ord", "url", "preview_text", "preview_success")
    said = candidates.drop("ord", "preview_text", "preview_success")
    settings = config.Settings(minimum_content_words=5, require_schema_approval=False)
    bad = said.where("url <> 'http://c.com/copy'").unionByName(said.limit(1)).unionByName(said.limit(1).withColumn("url", F.lit("http://x.org/")))
    engine = Engine(spark, str(tmp_path / "runs"), "bad", REQUEST, settings)
    with pytest.raises(RuntimeError, match="duplicate: http://a.com/table; missing: http://c.com/copy; unknown: http://x.org/"):
        engine.evaluate(plain, proposals=bad)
    assert engine.run.manifest()["status"] == "failed"
    good = Engine(spark, str(tmp_path / "runs"), "good", REQUEST, settings)
    assert {r.decision for r in good.evaluate(plain, proposals=said).collect()} == {"select"}


def test_nothing_eligible_ends_the_run(spark, tmp_path):
    candidates, fetched = inputs(spark)
    poor = candidates.withColumns({"topic_relevance_score": F.lit(0.0), "authority_score": F.lit(0.0)})
    engine = Engine(spark, str(tmp_path / "runs"), "poor", REQUEST, config.Settings(require_schema_approval=False))
    with pytest.raises(RuntimeError, match="eligible"):
        engine.execute(poor, fetched, str(tmp_path / "out"))
    assert engine.run.manifest()["status"] == "failed"


def test_searches_of_one_name_are_kept_apart(spark, tmp_path):
    find = lambda query, most: [{"url": f"http://{query}.org/"}]
    urls = [[r.url for r in Engine(spark, str(tmp_path / "runs"), "people", {"topic": topic}, config.Settings()).search(find).collect()] for topic in ("alpha", "beta", "alpha")]
    assert urls == [["http://alpha.org/"], ["http://beta.org/"], ["http://alpha.org/"]]


def test_relations_of_a_records_document(spark, tmp_path):
    candidates, fetched = inputs(spark)
    texts = fetched.withColumn("raw_markdown", F.when(F.col("url") == "http://b.com/prose", F.lit("Name: Ada. Grace Hopper met Alan Turing. " + "More words are here to read. " * 4)).otherwise(F.col("raw_markdown")))
    engine = Engine(spark, str(tmp_path / "runs"), "graph", REQUEST | {"profiles": ["graph_rag"]}, config.Settings(minimum_content_words=5, require_schema_approval=False))
    engine.execute(candidates.where("ord = 1"), texts, str(tmp_path / "out"))
    graph = [json.loads(x) for p in Path(tmp_path, "out/graphrag").glob("part-*") for x in p.read_text().splitlines()]
    pairs = {(r["source"], r["target"], r["type"]) for g in graph for r in g["relations"]}
    assert ("Grace Hopper", "Alan Turing", "RELATED_TO") in pairs
    assert all(r["source_url"] == "http://b.com/prose" and r["chunk_id"] for g in graph for r in g["relations"])
