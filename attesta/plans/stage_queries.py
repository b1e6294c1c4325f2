"""Queries of what stages hand on: projections, caches, states, routes, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text, urls
from attesta.operators import crawl, enrich, evidence, extraction, outputs, records, silver, sources
from attesta.plans.queries import _EVAL, _FINAL, _PREVIEW, _QUALITY, documents, profiled, qualified, query
from attesta.plans.record_queries import _IDS, _TURNS, doc_chunks, doc_records, turn_records
from attesta.session import Stage, table
from attesta.sources import pages, providers, registry

_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a provider returns them; every ninth failed."""
    p = F.col("page_id")
    pages = table(spark, sf_dir, "pages").withColumn("title", F.regexp_extract("html", r"<title>([^<]*)</title>", 1))
    meta = F.map_concat(
        F.create_map(F.lit("title"), F.col("title"), F.lit("canonical"), urls.canonical_url(F.col("url"))),
        F.when(p % 2 == 0, F.create_map(F.lit("lang"), F.lit(" en "))).otherwise(F.create_map(F.lit("og:locale"), F.lit("fr"))),
        F.when(p % 3 == 0, F.create_map(F.lit("published_time"), F.col("title"))).otherwise(F.create_map(F.lit("datePublished"), p.cast("string"), F.lit("modified_time"), F.lit(""))),
    )
    none = F.lit(None).cast("string")
    return sources.normalise_acquired(pages.select("url", none.alias("redirected_url"), (p % 9 != 0).alias("success"), none.alias("error"), F.col("html").alias("raw_markdown"), none.alias("fit_markdown"), meta.alias("metadata")))


# Sources


@query(f"SELECT {{canonical}} AS source, {_TITLE} AS title, sha256(html) AS content_hash FROM pages WHERE page_id % 9 <> 0")
def pipeline_documents(spark, sf_dir):
    return sources.as_pipeline_documents(fetched(spark, sf_dir)).select("source", "title", F.sha2(F.encode("content", "UTF-8"), 256).alias("content_hash"))


@query(f"SELECT {{canonical}} AS url, CASE WHEN page_id % 2 = 0 THEN 'en' ELSE 'fr' END AS language, CASE WHEN page_id % 3 <> 0 THEN page_id::VARCHAR WHEN trim({_TITLE}) <> '' THEN trim({_TITLE}) END AS publication_date, NULL::VARCHAR AS updated_date FROM pages")
def preview_metadata(spark, sf_dir):
    return sources.previews(fetched(spark, sf_dir), 40).select("url", "language", "publication_date", "updated_date")


@query("SELECT page_id FROM (SELECT page_id, url, CASE WHEN page_id % 3 > 0 THEN 'q' || page_id % 2 END AS q FROM pages) w WHERE NOT EXISTS (SELECT 1 FROM pages c WHERE contains(c.url, '/fr/') AND c.url = w.url AND coalesce(w.q, '') = CASE WHEN c.page_id % 3 > 0 THEN 'q0' ELSE '' END)")
def preview_cache(spark, sf_dir):
    """Wanted previews that the cached ones, of French pages, don't answer."""
    p = F.col("page_id")
    pages = table(spark, sf_dir, "pages")
    wanted = pages.select("page_id", "url", F.when(p % 3 > 0, F.concat(F.lit("q"), (p % 2).cast("string"))).alias("query"))
    cache = pages.where(F.contains("url", F.lit("/fr/"))).select("url", F.when(p % 3 > 0, "q0").alias("query"))
    return providers.missing_previews(wanted, cache).select("page_id")


@query(
    f"""WITH q AS (SELECT *, {_QUALITY} AS quality, {_PREVIEW} AS body FROM (SELECT *, {_FINAL} AS fs FROM {_EVAL})),
    b AS (SELECT *, first_value(url) OVER (PARTITION BY body ORDER BY quality DESC, page_id) AS best FROM q) SELECT page_id FROM b WHERE len(hard) = 0 AND preview_success AND topic_relevance_score >= 0.5 AND fs >= 0.55 AND (body = '' OR best = url)"""
)
def eligible_sources(spark, sf_dir):
    rows = sources.mark_preview_duplicates(qualified(spark, sf_dir).withColumn("preview_text", F.col("title")))
    return rows.where(sources.eligible()).select("page_id")


_SEEN = f"(SELECT {{canonical}} AS u, page_id, contains(url, '/de/') AS ok, {_TITLE} AS t FROM pages)"


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews of all pages; those of German ones succeeded."""
    return table(spark, sf_dir, "pages").select("url", F.contains("url", F.lit("/de/")).alias("fetch_success"), F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("relevant_text"), F.lit(None).cast("string").alias("error"))


@query(f"SELECT s.page_id, m.ok AS preview_success, m.t AS preview_text FROM {_SEEN} s JOIN (SELECT u, bool_or(ok) AS ok, coalesce(max(t) FILTER (ok), max(t)) AS t FROM {_SEEN} GROUP BY 1) m ON s.u = m.u")
def previewed_candidates(spark, sf_dir):
    rows = profiled(spark, sf_dir).drop("preview_success")
    return sources.with_previews(rows, seen(spark, sf_dir)).select("page_id", "preview_success", "preview_text")


@query(f"SELECT min(page_id) + 1 AS rank, bool_or(ok) AS has_preview FROM {_SEEN} GROUP BY u")
def schema_previews(spark, sf_dir):
    selected = table(spark, sf_dir, "pages").select("url", (F.col("page_id") + 1).alias("rank"))
    return sources.schema_previews(selected, seen(spark, sf_dir)).select("rank", "has_preview")


@query(f"SELECT u AS canonical_url, CASE WHEN bool_or(ok) THEN 'success' WHEN bool_or(t <> '') THEN 'failed' ELSE 'pending' END AS preview_status FROM {_SEEN} GROUP BY 1")
def preview_states(spark, sf_dir):
    """States of all candidates, given the previews that have a title."""
    registry = table(spark, sf_dir, "pages").select(urls.any_canonical_url(F.col("url")).alias("canonical_url")).distinct()
    return sources.registry_previews(registry, seen(spark, sf_dir).where("relevant_text <> '' or fetch_success")).select("canonical_url", "preview_status")


@query("SELECT page_id AS ord, url, NOT contains(url, '/de/') AS success, CASE WHEN contains(url, '/de/') THEN 'ValueError: unauthorized' END AS error, CASE WHEN contains(url, '/de/') THEN '' ELSE 'text of ' || url END AS raw_markdown FROM pages")
def fetched_pages(spark, sf_dir):
    def fetch(url):
        if "/de/" in url:
            raise ValueError("unauthorized")
        return {"raw_markdown": f"text of {url}"}

    return providers.acquire(table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), "url"), fetch, 8).select("ord", "url", "success", "error", "raw_markdown")


@query(f"SELECT page_id, translate(lower(trim({_TITLE})), ' -', '__') AS label FROM pages")
def label_forms(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.label(F.regexp_extract("html", r"<title>([^<]*)</title>", 1)).alias("label"))


# Documents


@query(r"SELECT 'chunking' AS stage, source AS source_url FROM documents WHERE regexp_full_match(text, '[\t\n\x0b\f\r ]*') OR contains(text, '$$$')")
def empty_errors(spark, sf_dir):
    """Error rows of texts that are empty but for white space and of those with a certain mark, which is blanked."""
    c = F.when(F.contains("content", F.lit("$$$")), " ").otherwise(F.col("content"))
    docs = documents(spark, sf_dir).withColumn("content_status", text.content_status(c, text.word_count(c), 60))
    return silver.empty_errors(docs).select("stage", "source_url")


@query("SELECT source AS source_url, 'title ' || max(doc_id) AS title, CASE WHEN contains(lower(arg_max(text, doc_id)), 'the') THEN 'the' ELSE 'general' END AS category FROM documents GROUP BY 1 UNION ALL SELECT 'none', '', 'general'")
def base_documents(spark, sf_dir):
    docs = enrich.classify(documents(spark, sf_dir).withColumn("cleaned_content", F.col("content")), ["the"])
    merged = docs.select(F.col("source").alias("source_url")).union(spark.createDataFrame([("none",)], "source_url string")).distinct()
    return enrich.with_base_documents(merged, docs).select("source_url", "title", "category")


@query(
    r"""SELECT doc_id, CASE WHEN len(w) > 0 AND words <= 50 THEN 'table' ELSE 'semantic' END AS method, CASE WHEN len(w) > 0 AND words <= 50 THEN len(w) ELSE 0 END::INTEGER AS n_records
    FROM (SELECT doc_id, regexp_extract_all(text, '[A-Z][a-z]+') AS w, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS words FROM documents)"""
)
def table_routes(spark, sf_dir):
    """Documents with their capitalised words as a table; it is the whole record only where there is little prose beside it."""
    words = F.regexp_extract_all("content", F.lit("[A-Z][a-z]+"), F.lit(0))
    rows = F.array_join(F.transform(words, lambda w: F.concat(F.lit("| "), w, F.lit(" | "), F.length(w).cast("string"), F.lit(" | x |"))), "\n")
    content = F.concat(F.lit("| Full Name | Size | Other |\n|---|---|---|\n"), rows, F.lit("\n\n"), F.translate(F.coalesce("content", F.lit("")), "|", "/"))
    pages = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("source_url"), content.alias("content"), F.lit("").alias("html"))
    fields = [{"field_name": "full_name", "type": "string", "required": True}, {"field_name": "size", "type": "integer"}]
    return extraction.route(pages, fields).select(F.col("source_url").cast("long").alias("doc_id"), "method", F.size("records").alias("n_records"))


@query("SELECT 'c' || doc_id AS chunk_id, CASE WHEN length(text) % 2 = 0 THEN 'c' || doc_id || ':record:0001' END AS local_record_id, CASE WHEN length(text) % 2 = 0 THEN '{\"n\": ' || length(text) || '}' END AS data, CASE WHEN length(text) % 2 > 0 THEN 'ValueError: odd' END AS error FROM documents WHERE lang = 'en'")
def semantic_routes(spark, sf_dir):
    """Chunks that no deterministic route serves, through a provider that fails for odd lengths."""

    def provider(url, content):
        if len(content) % 2:
            raise ValueError("odd")
        return [{"data": {"n": len(content)}, "confidence": 0.5}]

    chunks = doc_chunks(spark, sf_dir).withColumn("source_url", F.col("chunk_id"))
    routes = chunks.select("source_url", F.when(F.col("lang") == "en", "semantic").otherwise("table").alias("method"))
    return extraction.semantic_extract(chunks, routes, provider).select("chunk_id", "local_record_id", "data", "error")


# Evidence and records


@query("SELECT d.doc_id, d.lang <> 'de' AS source_exists, EXISTS (SELECT 1 FROM documents e WHERE d.lang <> 'de' AND e.source = d.source AND e.doc_id = d.doc_id + d.n_chars % 2) AS chunk_exists FROM documents d")
def existence(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.when(F.col("lang") != "de", F.col("source")).otherwise("nowhere").alias("source_url"), F.concat(F.lit("c"), (F.col("doc_id") + F.col("n_chars") % 2).cast("string")).alias("chunk_id"))
    return evidence.existing(rows, doc_chunks(spark, sf_dir)).select("doc_id", "source_exists", "chunk_exists")


_ASCII_WORDS = "regexp_extract_all(text, '[A-Za-z]+')"


@query(f"SELECT doc_id, CASE lang WHEN 'en' THEN array_to_string({_ASCII_WORDS}, '|') WHEN 'de' THEN n_chars || '|' || array_to_string({_ASCII_WORDS}, '|') ELSE lang END AS atoms FROM documents WHERE lang <> 'en' OR len({_ASCII_WORDS}) > 0")
def evidence_atoms(spark, sf_dir):
    """Scalars of a list of words, of an object that holds a number and such a list, and of a text."""
    words = F.to_json(F.regexp_extract_all("content", F.lit("[A-Za-z]+"), F.lit(0)))
    value = F.when(F.col("lang") == "en", words).when(F.col("lang") == "de", F.concat(F.lit('{"a":['), F.col("n_chars").cast("string"), F.lit(',null,""],"b":'), words, F.lit("}"))).otherwise(F.col("lang"))
    return documents(spark, sf_dir).withColumn("value", value).where("value != '[]'").select("doc_id", F.array_join(text.atoms(F.col("value")), "|").alias("atoms"))


@query(f"SELECT doc_id, CASE WHEN lang = 'de' THEN 'nulled' ELSE 'bound' END AS action FROM documents WHERE len({_ASCII_WORDS}) > 0")
def bind_lists(spark, sf_dir):
    """Lists of all words of a text are in it; in German ones there is one more that isn't."""
    words = F.regexp_extract_all("content", F.lit("[A-Za-z]+"), F.lit(0))
    value = F.to_json(F.when(F.col("lang") == "de", F.concat(words, F.array(F.lit("qqqqqqqq")))).otherwise(F.array_distinct(words)))
    own = F.concat(F.lit("c"), F.col("doc_id").cast("string"))
    rows = documents(spark, sf_dir).where(F.size(words) > 0)
    fields = rows.select(F.col("doc_id").alias("record_id"), F.col("source").alias("source_url"), own.alias("chunk_id"), F.lit("semantic").alias("extraction_method"), F.lit("words").alias("field"), value.alias("value"))
    none = fields.select("record_id", "field", "source_url", "chunk_id", F.lit("").alias("evidence_text")).where("false")
    schema = [{"field_name": "words", "type": "array", "nullable": True}]
    return evidence.bind(fields, none, doc_chunks(spark, sf_dir), schema).select(F.col("record_id").alias("doc_id"), "action")


@query(
    r"""WITH w AS (SELECT conv_id, turn, regexp_extract(text, '[A-Za-z]+') AS w FROM conversations WHERE regexp_matches(text, '[A-Za-z]')), l AS (SELECT conv_id, turn, unnest([0, 1]) AS p, unnest([w, upper(w)]) AS v FROM w),
    n AS (SELECT conv_id, count(*) AS n FROM w GROUP BY 1), f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, lower(v) ORDER BY turn, p) AS i FROM l)
    SELECT conv_id, string_agg(v, ',' ORDER BY turn, p) AS words FROM f JOIN n USING (conv_id) WHERE n = 1 OR i = 1 GROUP BY 1"""
)
def merge_normalised_lists(spark, sf_dir):
    """Lists of a word in two spellings, united by what they are without case; a list that is alone stays as it is."""
    w = F.regexp_extract("text", "[A-Za-z]+", 0)
    rows = table(spark, sf_dir, "conversations").withColumn("w", w).where("w != ''").select(
        "conv_id", F.col("turn").alias("ord"), F.lit("s").alias("source_url"), F.col("turn").cast("string").alias("chunk_id"), F.lit(0.9).alias("confidence"), F.create_map().cast("map<string,double>").alias("field_confidence"), F.create_map(F.lit("words"), F.to_json(F.array("w", F.upper("w")))).alias("data"),
    )
    out = records.merge_fields(records.contributions(rows, ["conv_id"]), ["conv_id"])
    return out.select("conv_id", F.array_join(F.from_json("value", "array<string>"), ",").alias("words"))


_KEYS = r"(SELECT doc_id, source, lang, regexp_replace(regexp_replace(lower(text), '\s+', ' ', 'g'), '^ | $', '', 'g') AS k FROM documents)"


@query(f"SELECT min(doc_id) AS first_ord, count(*) AS n_evidence, count(*) AS n_contributors, count(*) AS n_ids FROM {_KEYS} GROUP BY k, lang")
def dedup_provenance(spark, sf_dir):
    """What a record that stays takes over from its duplicates."""
    rows = doc_records(spark, sf_dir).withColumn("provenance", F.create_map(F.lit("ids"), F.array(F.col("ord").cast("string"))))
    out = records.deduplicate(rows)
    first = F.array_min(F.concat(F.array("ord"), F.transform("absorbed", lambda x: x["ord"])))
    return out.select(first.alias("first_ord"), F.size("evidence").cast("long").alias("n_evidence"), F.size("contributors").cast("long").alias("n_contributors"), F.size(F.element_at("provenance", "ids")).cast("long").alias("n_ids"))


@query(f"SELECT stage, n::BIGINT AS n FROM (SELECT 'deduplication:source_or_content' AS stage, sum(c - 1) AS n FROM (SELECT count(*) AS c FROM {_KEYS} GROUP BY k, lang, source) UNION ALL SELECT 'deduplication:exact_normalized_record', sum(c - 1) FROM (SELECT count(DISTINCT source) AS c FROM {_KEYS} GROUP BY k, lang)) WHERE n > 0")
def dedup_rejections(spark, sf_dir):
    return records.dedup_rejections(records.deduplicate(doc_records(spark, sf_dir))).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query(rf"""SELECT '["conv ' || conv_id || '"]' AS resolution_key, count(*) AS n_records, min((turn % 5) / 5.0::DOUBLE) AS evidence_quality_score, 's' AS schema_name FROM {_TURNS} a GROUP BY conv_id""")
def structured_records(spark, sf_dir):
    out = outputs.structured_records(records.resolve(turn_records(spark, sf_dir), _IDS, ["id"]), _IDS, "s", "1.0")
    return out.select("provenance.resolution_key", F.size("provenance.contributing_record_ids").cast("long").alias("n_records"), "quality.evidence_quality_score", F.col("schema_metadata.name").alias("schema_name"))


#: Tokens of two letters beside one for each byte; no letter is in two of them, so SQL can count what merges.
_PAIRS = ("th", "en", "ou", "is")


@query(
    "SELECT doc_id, (octet_length(encode(t)) - " + " - ".join(f"(length(b) - length(replace(b, '{p}', ''))) // 2" for p in _PAIRS) + r""")::INTEGER AS tokens
    FROM (SELECT doc_id, t, regexp_replace(t, '''(s|d|m|t|ll|ve|re)', '''\1|', 'gi') AS b FROM (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents) WHERE t <> '')"""
)
def rank_token_count(spark, sf_dir):
    """Tokens of whole documents by a table of ranks."""
    ranks = {bytes([b]): b for b in range(256)} | {p.encode(): 256 + i for i, p in enumerate(_PAIRS)}
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), "source", F.lit("").alias("title"), F.col("text").alias("cleaned_content"))
    return silver.chunk(docs, enabled=False, by=silver.RankCounter(ranks=ranks)).select(F.col("ord").alias("doc_id"), F.col("token_count").alias("tokens"))


# Sources as they grow


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    pages = table(spark, sf_dir, "pages")
    one = pages.select(p.alias("ord"), "url", F.lit("search").alias("origin"), F.lit("").alias("title"), F.lit("").alias("description"), F.lit("Web").alias("provider"), F.lit(False).alias("seed"), F.lit(False).alias("preferred"), p.alias("page_id"))
    two = pages.select((-1 - p).alias("ord"), F.concat("url", F.lit("#again")).alias("url"), F.lit("crawl").alias("origin"), F.concat(F.lit("t"), p.cast("string")).alias("title"), F.lit("").alias("description"), F.lit("WEB").alias("provider"), (p % 5 == 0).alias("seed"), F.lit(False).alias("preferred"), p.alias("page_id"))
    return one.unionByName(two)


@query("SELECT {canonical} AS canonical_url, min(-1 - page_id) AS ord, arg_max('t' || page_id, page_id) AS title, bool_or(page_id % 5 = 0) AS user_seed, count(DISTINCT url) + count(DISTINCT url || '#again') AS n_urls, 'crawl search' AS origins, 'WEB' AS providers FROM pages GROUP BY 1")
def registry_in_batches(spark, sf_dir):
    """Pages found twice, taken into a registry in two batches of which the later comes first in order."""
    stage = Stage(spark, "registry")
    held = registry.Registry(spark, stage.path("facts"), 8)
    found = _found(spark, sf_dir)
    for rows in (found.where("ord >= 0"), found.where("ord < 0")):
        held.merge(rows.drop("page_id"))
    return held.read().select("canonical_url", "ord", "title", "user_seed", F.size("original_urls").cast("long").alias("n_urls"), F.array_join("origins", " ").alias("origins"), F.array_join("providers", " ").alias("providers"))


def _site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site whose pages are the targets of pages' first links, each linking to the targets that come after."""
    targets = F.filter(sources.links(F.col("html")), lambda x: x.rlike(r"^/[A-Za-z]+$"))
    rows = table(spark, sf_dir, "pages").select(targets.alias("l")).where(F.size("l") > 1)
    at = lambda c: F.concat(F.lit("http://site.org"), c)
    return rows.select(at(F.get("l", F.lit(0))).alias("url"), F.explode(F.slice("l", 2, 1000)).alias("t")).select("url", at(F.col("t")).alias("link"), F.substring("t", 2, 100).alias("title")).distinct()


@query(
    r"""WITH RECURSIVE l AS (SELECT list_filter(list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: trim(x)), lambda x: regexp_matches(x, '^/[A-Za-z]+$')) AS l FROM pages),
    e AS (SELECT DISTINCT l[1] AS a, unnest(l[2:]) AS b FROM l WHERE len(l) > 1),
    s AS (SELECT a FROM e GROUP BY a ORDER BY count(*) DESC, a LIMIT 1),
    r AS (SELECT a AS page, 0 AS depth FROM s UNION SELECT e.b, depth + 1 FROM r JOIN e ON e.a = r.page WHERE depth < 3)
    SELECT 'http://site.org' || page AS url, min(depth) AS depth FROM r, s WHERE page <> a GROUP BY page"""
)
def crawl_frontier(spark, sf_dir):
    """All pages of a site within three links of the one with most links; the round takes whole depths, so a page's depth is the least."""
    site = Stage(spark, "site").put(_site(spark, sf_dir), "links")
    start = site.groupBy("url").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "url").limit(1).select("url")
    found = crawl.crawl(start, lambda wanted: wanted.join(site, "url").select("url", "link", "title"), ["the"], max_depth=3, max_pages=1 << 30, a_round=1 << 30)
    return found.select("url", "depth")


@query(r"SELECT url, html, true AS success FROM pages WHERE url IS NOT NULL")
def pages_source(spark, sf_dir):
    """Pages read through the data source, its fixture being the table."""
    pages.register(spark)
    return spark.read.format(pages.NAME).option("path", pages.fixture(spark, f"{sf_dir}/pages.parquet")).load().select("url", "html", "success")
