"""A run from candidate pages to output files: Bronze, Silver and Gold tables, each written once and reread.

The run stops after the schema draft until it is approved; a run of the same
name, request and settings goes on after the last stage that ended. Stages come
in this order: registry, evaluation, exploration, selection, acquisition,
cleaning, chunking, routing and extraction, evidence, gate, resolution,
enrichment, validation, deduplication, output. What any of them turned away is
in the table of rejections, how much in the manifest's metrics.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text
from attesta.functions.scores import selection_quality
from attesta.functions.urls import any_canonical_url, host_of, matches_any
from attesta.operators import enrich, evidence, extraction, metrics, outputs, records, silver, sources
from attesta.session import Stage, numbered
from attesta.sources import planning, providers
from attesta.sources.config import Settings
from attesta.sources.files import Run, write_records
from attesta.sources.ledger import Ledger

DEFAULT_SCHEMA = [{"field_name": "content", "type": "string", "required": True, "nullable": False}]


def fingerprint(df: DataFrame) -> str:
    """What a table holds, whatever the order of its rows."""
    whole = F.xxhash64(F.to_json(F.struct("*")))
    return "-".join(str(x) for x in df.agg(F.count(F.lit(1)), F.sum(whole.cast("decimal(20,0)"))).first())


class NotApproved(RuntimeError):
    """The schema draft waits for approval."""


class Engine:
    """Stages of one run. ``request``: policy, rules, categories, profiles, schema and what else a configuration has."""

    def __init__(self, spark: SparkSession, folder: str, name: str, request: Mapping[str, Any], settings: Settings | None = None, provider: Callable | None = None):
        self.spark, self.request, self.provider = spark, request, provider
        self.settings = settings or Settings.load(spark)
        self.run = Run(spark, folder, name)
        self.run.of(request, vars(self.settings))  # of the stages before a schema is approved

    # Approval

    def draft_schema(self) -> list[dict]:
        """The request's schema, else one of a single content field; it has no effect before approve()."""
        schema = [dict(f) for f in self.request.get("schema") or DEFAULT_SCHEMA]
        self.run.save_manifest(draft_schema=schema, status=self.run.manifest().get("status", "waiting_for_approval"))
        return schema

    def approve(self, by: str, schema: Sequence[Mapping] | None = None) -> None:
        self.run.save_manifest(approved_schema=list(schema or self.draft_schema()), approved_by=by, status="approved")

    def cancel(self) -> None:
        self.run.save_manifest(status="cancelled")

    def schema(self) -> list[dict]:
        manifest = self.run.manifest()
        if not self.settings.require_schema_approval and manifest.get("status") != "cancelled":
            return [dict(f) for f in manifest.get("approved_schema") or self.request.get("schema") or DEFAULT_SCHEMA]
        if manifest.get("status") == "cancelled" or not manifest.get("approved_schema"):
            raise NotApproved(f"run is {manifest.get('status', 'new')}")
        return manifest["approved_schema"]

    # Research

    def plan(self) -> dict[str, Any]:
        """The research plan of the request's topic, kept in the manifest."""
        made = planning.plan(self.request, str(self.request.get("topic", "")), self.settings.max_queries)
        self.run.save_manifest(plan=made)
        return made

    def search(self, find: Callable[[str, int], list[Mapping]]) -> DataFrame:
        """Candidates: the user's own sources, then what ``find`` (query, most) has for each of the plan's queries."""

        def make() -> DataFrame:
            queries = list(dict.fromkeys(q.strip() for q in self.plan().get("search_queries", ()) if q.strip()))
            wanted = (self.request.get("sources") or {}).get("preferred_domains") or []
            rows = providers.seeds(self.spark, list((self.request.get("sources") or {}).get("seed_urls") or ())).unionByName(providers.search(self.spark, queries, find, self.settings.search_limit))
            return rows.withColumn("preferred", matches_any(host_of(F.col("url")), wanted)) if wanted else rows

        return self.run.stage("candidates", make)

    def preview(self, candidates: DataFrame, fetch: Callable[[str], Mapping], cache: DataFrame | None = None) -> DataFrame:
        """Bounded previews of the candidates, each URL fetched once; ``cache`` has url, query and the previews of earlier runs, which aren't fetched again."""
        s = self.settings

        def make() -> DataFrame:
            wanted = sources.first_by(candidates.select("ord", "url", F.lit(None).cast("string").alias("query")), ["url"], ["ord"])
            todo = wanted if cache is None else providers.missing_previews(wanted, cache)
            got = providers.acquire(todo.select("ord", "url"), fetch, s.fetch_concurrency, s.fetch_retries, s.fetch_delay_seconds)
            seen = sources.previews(sources.normalise_acquired(got), s.preview_words)
            return seen if cache is None else seen.unionByName(cache.drop("query").join(wanted.select("url"), "url", "left_semi"), allowMissingColumns=True)

        return self.run.stage("previews", make)

    # Candidates

    def register(self, candidates: DataFrame) -> DataFrame:
        """The registry: one candidate for each canonical URL. Columns that candidates lack are empty."""
        empty = {"origin": F.lit("request"), "title": F.lit(""), "description": F.lit(""), "provider": F.lit(""), "seed": F.lit(False), "preferred": F.lit(False)}
        rows = candidates.withColumns({c: v for c, v in empty.items() if c not in candidates.columns})
        return self.run.stage("registry", lambda: sources.registry_upsert(rows.select("ord", "url", *empty, *(["metadata"] if "metadata" in rows.columns else []))))

    def evaluate(self, candidates: DataFrame, previews: DataFrame | None = None, proposals: DataFrame | None = None) -> DataFrame:
        """The policy's decision on each candidate that has a canonical URL, the first of equal ones.

        ``proposals``: url and the profile that a model proposes for it (source type,
        scores and so on). One for an unknown URL, two for one or none for another
        end the stage.
        """

        def make() -> DataFrame:
            rows = candidates.withColumn("canonical_url", any_canonical_url(F.col("url"))).where("canonical_url is not null")
            rows = sources.first_by(rows, ["canonical_url"], ["ord"])
            if proposals is not None:
                said = proposals.withColumn("canonical_url", F.coalesce(any_canonical_url(F.col("url")), "url")).drop("url")
                wrong = sources.integrity(said, rows).where("issue <> 'ok'")
                found = [f"{r['issue']}: {r['canonical_url']}" for r in wrong.orderBy("canonical_url").limit(5).collect()]
                if found:
                    self.fail(f"proposals and candidates don't agree ({'; '.join(found)})")
                rows = rows.drop(*(c for c in said.columns if c in rows.columns and c != "canonical_url")).join(said, "canonical_url")
            rows = rows if previews is None else sources.with_previews(rows, previews)
            policy = self.request.get("policy") or {}
            rows = sources.evaluate(rows, policy)
            importance = policy.get("importance", {}).get("technical_depth", "medium")
            q = selection_quality(F.col("final_score"), F.col("information_density_score"), F.col("extractability_score"), F.col("technical_depth_score"), importance)
            return sources.mark_preview_duplicates(rows.withColumn("quality", q).withColumn("domain", host_of(F.col("url"))))

        return self.run.stage("evaluated", make, metrics.stage_counters("decision", ("select", "reject"), "evaluation_"))

    def fail(self, why: str) -> None:
        """End the run: its status says why."""
        self.run.save_manifest(status="failed", error=why)
        raise RuntimeError(why)

    def explore(self, registry: DataFrame, evaluated: DataFrame, crawled: DataFrame) -> DataFrame:
        """New candidates from the sites of the chosen and the user's sources. ``crawled``: start_url, ord, url, title, depth, parent_url, success."""
        s = self.settings

        def make() -> DataFrame:
            chosen = evaluated.select("canonical_url", (F.col("decision") == "select").alias("selected"))
            rows = registry.join(chosen, "canonical_url", "left").select("ord", F.col("canonical_url").alias("url"), F.coalesce("selected", F.lit(False)).alias("selected"), "user_seed")
            starts = sources.exploration_starts(rows, s.max_start_domains).select(F.col("canonical_url").alias("_start"))
            pages = crawled.join(F.broadcast(starts), any_canonical_url(F.col("start_url")) == F.col("_start"), "left_semi")
            return sources.explored(pages, s.max_depth, s.max_pages_per_domain)

        return self.run.stage("explored", make)

    def register_explored(self, candidates: DataFrame, explored: DataFrame) -> DataFrame:
        """The registry with the pages that exploration found, after all others in order."""

        def make() -> DataFrame:
            empty = {"origin": F.lit("request"), "title": F.lit(""), "description": F.lit(""), "provider": F.lit(""), "seed": F.lit(False), "preferred": F.lit(False)}
            rows = candidates.withColumns({c: v for c, v in empty.items() if c not in candidates.columns}).select(F.col("ord").cast("long").alias("ord"), "url", *empty, *(["metadata"] if "metadata" in candidates.columns else []))
            last = candidates.agg(F.coalesce(F.max("ord"), F.lit(0)).cast("long").alias("_last"))  # one row
            found = explored.join(F.broadcast(last)).select((F.col("_last") + 1 + F.col("ord")).alias("ord"), "url", F.concat(F.lit("exploration:"), "start_url").alias("origin"), F.coalesce("title", F.lit("")).alias("title"), F.lit("").alias("description"), F.lit("exploration").alias("provider"), F.lit(False).alias("seed"), F.lit(False).alias("preferred"))
            return sources.registry_upsert(rows.unionByName(found, allowMissingColumns=True))

        return self.run.stage("registry_explored", make)

    def select(self, evaluated: DataFrame, registry: DataFrame | None = None) -> DataFrame:
        """The bounded, diverse choice; the user's own sources where nothing was evaluated."""

        def make() -> DataFrame:
            good = evaluated.where(sources.eligible()).withColumn("request_id", F.lit(0))
            out = sources.diverse_top(good, int(self.request.get("max_sources", self.settings.max_sources)))
            if registry is None:
                return out
            seeds = sources.seed_fallback(evaluated, registry.withColumn("url", F.col("canonical_url")))
            return out.unionByName(seeds.select("url", "ord", "rank", host_of(F.col("url")).alias("domain"), F.lit(0.0).alias("quality")), allowMissingColumns=True)

        return self.run.stage("selected", make)

    # Bronze

    def acquire(self, fetched: DataFrame, selected: DataFrame) -> DataFrame:
        """Bronze: a row for each selected source, from the fetched pages (url, redirected_url, success, error, raw_markdown, fit_markdown, html, metadata); one that wasn't fetched is a failure."""

        def make() -> DataFrame:
            rows = sources.first_by(fetched, ["url"], [F.desc("success")])
            mine = selected.select("url", F.col("rank").cast("long").alias("ord")).join(rows, "url", "left")
            mine = mine.withColumn("error", F.when(F.col("success").isNull(), "not fetched").otherwise(F.col("error"))).withColumn("success", F.coalesce("success", F.lit(False)))
            mine = mine.withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))
            return sources.normalise_acquired(mine).join(mine.select(F.col("url").alias("source_url"), "ord", "html"), "source_url")

        out = self.run.stage("bronze", make, {"requested": F.count(F.lit(1)), "successful": F.count_if(F.col("success")), "failed": F.count_if(~F.col("success"))})
        wanted = selected.select("url").distinct().count()
        had = self.run.counted("bronze") or {}
        if had.get("requested", wanted) != wanted:
            self.fail(f"{wanted} sources were selected, {had['requested']} acquired")
        if wanted and not had.get("successful", 1):
            self.fail("no selected source could be acquired")
        return out

    # Silver

    def clean(self, bronze: DataFrame) -> DataFrame:
        docs = sources.as_pipeline_documents(bronze).join(bronze.where("success").select(F.coalesce(text.empty_to_null(F.col("canonical_url")), "source_url").alias("source"), "ord", "html", "domain", "content_hash"), "source")
        docs = sources.first_by(docs, ["source"], ["ord"])
        return self.run.stage("silver", lambda: silver.clean(docs, self.settings.minimum_content_words), metrics.stage_counters("content_status", ("empty", "thin", "usable"), "content_"))

    def chunk(self, docs: DataFrame) -> DataFrame:
        s = self.settings
        return self.run.stage("chunks", lambda: silver.chunk(docs.where("content_status != 'empty'"), s.chunk_target_tokens, s.chunk_overlap_tokens, s.chunking_enabled, silver.RankCounter(s.token_ranks) if s.token_ranks else None))

    def extract(self, docs: DataFrame, chunks: DataFrame) -> DataFrame:
        schema = self.schema()
        pages = docs.where("content_status != 'empty'").select(F.col("source").alias("source_url"), F.col("cleaned_content").alias("content"), "html")
        routes = self.run.stage("routes", lambda: extraction.route(pages, schema, self.request.get("rules", ()), bool(self.request.get("auto_table", True)), bool(self.request.get("router", True))), metrics.stage_counters("method", ("table", "regex", "css", "xpath", "semantic"), "routing_"))

        def make() -> DataFrame:
            fixed = extraction.routed_records(routes, chunks).withColumn("error", F.lit(None).cast("string"))
            ledger = Ledger(self.settings.call_ledger) if self.settings.call_ledger else None
            provider = self.provider and partial(providers.with_retries, self.provider, retries=self.settings.extraction_retries)
            return fixed.unionByName(extraction.semantic_extract(chunks, routes, provider, ledger, json.dumps(schema, sort_keys=True)))

        return self.run.stage("extracted", make)

    # Evidence and gate

    def fields_of(self, extracted: DataFrame) -> DataFrame:
        """A row for each field of each record, its value as it reads and as JSON."""
        pairs = F.from_json("data", "map<string,variant>")
        rows = extracted.where("error is null").select("local_record_id", "source_url", "chunk_id", "extraction_method", "confidence", F.explode(pairs).alias("field", "v"))
        return rows.select(F.col("local_record_id").alias("record_id"), "source_url", "chunk_id", "extraction_method", "confidence", "field", F.to_json("v").alias("json")).withColumn("value", outputs.plain_value(F.col("json")))

    def bind(self, extracted: DataFrame, chunks: DataFrame) -> DataFrame:
        """All fields of the extracted records with their evidence and what becomes of them."""

        def make() -> DataFrame:
            fields = self.fields_of(extracted)
            none = fields.select("record_id", "field", "source_url", "chunk_id", F.lit(None).cast("string").alias("evidence_text")).where("false")
            return evidence.bind(fields, none, chunks.withColumn("ord", F.col("chunk_index")), self.schema())

        return self.run.stage("bound", make)

    def validate_evidence(self, bound: DataFrame) -> DataFrame:
        """Bound fields with their status; none of a record that a required field disqualifies."""
        schema = self.schema()

        def make() -> DataFrame:
            kept = bound.where("action = 'bound'")
            kind = F.lit(None).cast("string")
            ok = F.lit(False)
            for f in schema:
                mine = F.col("field") == f["field_name"]
                kind = F.when(mine, f["type"]).otherwise(kind)
                ok = F.when(mine, extraction.type_ok(F.try_parse_json("json"), f["type"])).otherwise(ok)
            found = F.array_join(F.transform("evidence", lambda e: e["evidence_text"]), "\n")
            status = evidence.field_status(kind, F.col("value"), F.coalesce(ok, F.lit(False)), found, F.lit(0))
            # A list or object is in its evidence if every scalar of it is.
            parts = F.forall(text.atoms(F.col("value")), lambda a: F.contains(text.plain_folded(found), text.plain_folded(a)))
            status = F.when(F.coalesce(ok, F.lit(False)) & F.col("json").rlike(r"^[\[{]") & parts, "supported").otherwise(status)
            out = kept.withColumn("type_ok", F.coalesce(ok, F.lit(False))).withColumn("status", status).withColumn("has_evidence", F.lit(True))
            lost = bound.where("action = 'quarantine'").select("record_id").distinct()
            return out.join(lost, "record_id", "left_anti")

        return self.run.stage("fields", make)

    def gate(self, fields: DataFrame, chunks: DataFrame, selected: DataFrame) -> DataFrame:
        def make() -> DataFrame:
            heads = fields.groupBy("record_id").agg(F.min("source_url").alias("source_url"), F.min("chunk_id").alias("chunk_id"))
            known = evidence.verified(fields.select("record_id", "field", "status", "type_ok", "has_evidence"), evidence.existing(heads, chunks), self.schema())
            scored = evidence.source_scores(known, selected.select("url", F.col("quality").alias("score"), "ord"))
            return evidence.gate(scored, self.settings.minimum_evidence_quality, self.settings.allow_partially_supported).withColumn("local_record_id", F.col("record_id"))

        counters = metrics.stage_counters("status", ("supported", "partially_supported", "unsupported", "contradicted"), "evidence_")
        return self.run.stage("gated", make, counters | {"gate_total": F.count(F.lit(1)), "gate_true": F.count_if(F.col("accepted")), "gate_false": F.count_if(~F.col("accepted"))})

    # Gold

    def resolve(self, fields: DataFrame, assessed: DataFrame, chunks: DataFrame) -> DataFrame:
        """Accepted records of equal identity as one; contributions come in the order of sources, chunks and records."""

        def make() -> DataFrame:
            good = fields.join(assessed.where("accepted").select("record_id", F.col("final_quality_score").alias("quality"), F.col("status").alias("record_status")), "record_id")
            order = {f["field_name"]: i for i, f in enumerate(self.schema())}
            place = F.coalesce(*(F.when(F.col("field") == n, F.lit(i)) for n, i in order.items()), F.lit(len(order)))
            data = F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("place"), "field", "json"))), lambda x: F.struct(x["field"], x["json"])))
            one = [F.min(c).alias(c) for c in ("source_url", "chunk_id", "extraction_method", "confidence", "quality")]
            rows = good.groupBy("record_id").agg(*one, F.min("record_status").alias("status"), data.alias("data"))
            places = chunks.select("source_url", "chunk_id", F.col("ord").alias("_source"), F.col("chunk_index").cast("long").alias("_chunk"))
            rows = rows.join(places, ["source_url", "chunk_id"])
            nth = F.coalesce(F.regexp_extract("record_id", r"([0-9]+)$", 1).try_cast("long"), F.lit(0))
            rows = numbered(Stage(self.spark, "contributions"), rows.withColumn("_nth", nth), [F.col(c) for c in ("_source", "_chunk", "_nth", "record_id", "source_url")], "ord").drop("_source", "_chunk", "_nth")
            rows = rows.withColumn("local_record_id", F.col("record_id")).withColumn("field_confidence", F.create_map().cast("map<string,double>"))
            return records.resolve(rows, self.schema(), self.request.get("identity_fields", ()))

        counters = metrics.stage_counters("resolution_method", (*records.IDENTITIES, "local_record"), "resolution_")
        return self.run.stage("resolved", make, counters | {"resolution_cross_source": F.count_if(F.size("source_urls") > 1), "resolution_conflicts": F.coalesce(F.sum(F.size("merge_conflicts")), F.lit(0))})

    def references(self, fields: DataFrame, resolved: DataFrame) -> DataFrame:
        """resolution_key, field, source_url, chunk_id and evidence_text of every piece of evidence behind a resolved record."""
        rows = fields.join(resolved.select("resolution_key", F.explode("contributing_record_ids").alias("record_id")), "record_id")
        return rows.select("resolution_key", "field", "source_url", F.explode("evidence").alias("e")).select("resolution_key", "field", "source_url", "e.chunk_id", "e.evidence_text").distinct()

    def enrich(self, docs: DataFrame, extracted: DataFrame) -> DataFrame:
        """Documents with class, metadata, quality report and normalised content."""

        def make() -> DataFrame:
            rows = enrich.classify(docs.where("content_status != 'empty'"), self.request.get("categories", ("general",)))
            rows = rows.withColumnRenamed("metadata", "page_metadata").withColumn("source_domain", F.col("domain")).withColumn("confidence_score", F.lit(None).cast("double"))
            found = extracted.where("error is null").select(F.col("local_record_id").alias("ord"), "source_url", "confidence")
            rows = enrich.enrich_metadata(rows, found, str(self.request.get("topic", self.request.get("name", ""))))
            names = text.entities(F.col("cleaned_content"))
            rows = rows.withColumn("entity_count", F.size(names)).withColumn("relation_count", F.col("entity_count") * (F.col("entity_count") - 1) / 2).withColumn("confidence_score", F.col("metadata.confidence_score"))
            return enrich.normalise(enrich.quality_reports(rows), self.request.get("replacements", {}))

        return self.run.stage("enriched", make)

    def validate(self, resolved: DataFrame, enriched: DataFrame) -> DataFrame:
        """Resolved records with their document and the schema's verdict on them."""

        def make() -> DataFrame:
            rows = enrich.with_base_documents(resolved, enriched)
            data = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("data"), lambda e: F.concat(F.to_json(e["key"].cast("variant")), F.lit(":"), e["value"])), ","), F.lit("}"))
            judged = rows.withColumn("fields", F.col("data")).withColumn("data", data).withColumn("content", F.col("cleaned_content"))
            s = self.settings
            return records.validate(judged, self.schema(), True, s.minimum_confidence, s.low_confidence_action)

        return self.run.stage("validated", make, metrics.stage_counters("validation_status", ("validated", "rejected", "review"), "validation_"))

    def deduplicate(self, validated: DataFrame, references: DataFrame, docs: DataFrame) -> DataFrame:
        """What stays of the valid records, with the provenance of all it stands for."""

        def make() -> DataFrame:
            good = validated.where("validation_status = 'validated'")
            as_json = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: F.to_json(x))
            hashes = docs.select(F.col("source").alias("url"), F.explode(F.array_compact(F.array("content_hash", "processed_content_hash"))).alias("hash"), F.col("title"))
            mine = good.select("resolution_key", F.explode("source_urls").alias("url")).join(hashes, "url").groupBy("resolution_key")
            maps = mine.agg(F.array_sort(F.collect_set("hash")).alias("content_hashes"), F.array_sort(F.collect_set(F.to_json(F.struct("url", "title")))).alias("titles"), F.array_sort(F.collect_set(F.to_json(F.struct("url", "hash")))).alias("hashes"))
            refs = references.groupBy("resolution_key").agg(F.array_sort(F.collect_set(F.to_json(F.struct("field", "source_url", "chunk_id", "evidence_text")))).alias("evidence"))
            rows = good.join(maps, "resolution_key", "left").join(refs, "resolution_key", "left")
            identity = F.when(F.col("resolution_method").isin(*records.IDENTITIES), F.concat_ws(":", "resolution_method", "resolution_key"))
            lists = {"contributing_chunk_ids": F.col("contributing_chunk_ids"), "contributing_record_ids": F.col("contributing_record_ids"), "extraction_methods": F.col("extraction_methods"), "evidence_support_statuses": F.col("evidence_support_statuses"), "merge_conflicts": as_json("merge_conflicts"), "source_titles": F.col("titles"), "source_content_hashes": F.col("hashes")}
            given = F.map_from_arrays(F.array(*(F.lit(n) for n in lists)), F.array(*(F.coalesce(v, F.array().cast("array<string>")) for v in lists.values())))
            none = F.array().cast("array<string>")
            rows = rows.select("ord", "source_urls", F.coalesce("content_hashes", none).alias("content_hashes"), "data", identity.alias("identity"), F.coalesce("evidence_quality_score", F.lit(0.0)).alias("quality"), F.coalesce("evidence", none).alias("evidence"), as_json("contributors").alias("contributors"), given.alias("provenance"))
            return records.deduplicate(rows)

        return self.run.stage("deduplicated", make)

    def gold(self, validated: DataFrame, deduplicated: DataFrame) -> DataFrame:
        """The records that stay, with united provenance and the lowest quality of what they stand for."""

        def make() -> DataFrame:
            united = deduplicated.select(F.col("ord").alias("_ord"), *(F.col(c).alias(f"_{c}") for c in ("source_urls", "contributors", "quality", "provenance", "stages")), F.size("absorbed").alias("duplicate_count"))
            rows = validated.join(united, F.col("ord") == F.col("_ord"))
            kinds = {c: validated.schema[c].dataType.simpleString() for c in ("contributors", "merge_conflicts")}
            parsed = lambda c, kind: F.transform(c, lambda x: F.from_json(x, kind[6:-1]))
            rows = rows.withColumn("source_urls", F.col("_source_urls")).withColumn("contributors", parsed(F.col("_contributors"), kinds["contributors"])).withColumn("evidence_quality_score", F.col("_quality"))
            rows = rows.withColumn("merge_conflicts", parsed(F.element_at("_provenance", "merge_conflicts"), kinds["merge_conflicts"])).withColumn("deduplication_stages", F.col("_stages"))
            for name in ("contributing_chunk_ids", "contributing_record_ids", "extraction_methods", "evidence_support_statuses", "source_titles", "source_content_hashes"):
                rows = rows.withColumn(name, F.element_at("_provenance", name))
            rows = rows.withColumn("data", F.col("fields")).drop("fields", "_ord", "_source_urls", "_contributors", "_quality", "_provenance", "_stages")
            return rows.withColumn("source_title", F.col("title")).withColumn("language", text.language_guess(F.col("cleaned_content")))

        return self.run.stage("gold", make)

    def rejections(self, candidates: DataFrame, evaluated: DataFrame, bronze: DataFrame, docs: DataFrame, bound: DataFrame, assessed: DataFrame, validated: DataFrame, deduplicated: DataFrame) -> DataFrame:
        """All that a stage turned away: stage, what (a URL or record) and reasons."""

        def make() -> DataFrame:
            row = lambda df, stage, what, reasons: df.select((F.lit(stage) if isinstance(stage, str) else stage).alias("stage"), F.col(what).cast("string").alias("what"), reasons.alias("reasons"))
            gone = records.dedup_rejections(deduplicated).join(validated.select("ord", "resolution_key"), "ord")
            parts = [
                row(sources.rejected_urls(candidates), "registry", "url", F.array(F.lit("no absolute HTTP URL"))),
                row(evaluated.where("decision = 'reject'"), "evaluation", "url", F.col("hard_reasons")), row(bronze.where("not success"), "acquisition", "source_url", F.array(F.coalesce("error", F.lit("")))),
                row(silver.empty_errors(docs), "chunking", "source_url", F.array("error")), row(bound.where("action = 'quarantine'").select("record_id", "field").distinct(), "evidence", "record_id", F.array(F.concat(F.lit("no evidence:"), F.col("field")))),
                row(assessed.where("not accepted"), "quality_gate", "record_id", F.col("reasons")), row(validated.where("validation_status != 'validated'"), "validation", "resolution_key", F.col("reasons")), row(gone, F.col("stage"), "resolution_key", F.array(F.lit("duplicate"))),
            ]
            return evidence.rejections(*parts)

        return self.run.stage("rejections", make)

    def stage_counts(self, validated: DataFrame, deduplicated: DataFrame) -> dict[str, int]:
        """Counters of the stages, as they were taken while each was written."""
        out: dict[str, int] = {}
        for stage in ("evaluated", "bronze", "silver", "routes", "gated", "validated", "resolved"):
            out |= self.run.counted(stage) or {}
        out["cache_hits"] = 0
        return out | records.dedup_metrics(validated.where("validation_status = 'validated'"), deduplicated).first().asDict()

    def graph_relations(self, gold: DataFrame, relations: DataFrame, enriched: DataFrame, chunks: DataFrame) -> DataFrame:
        """resolution_key and relation (source, target, type, source_url, chunk_id) of the relations of a record's own document that a chunk of it shows whole."""

        def make() -> DataFrame:
            of = enriched.select("ord", F.col("source").alias("source_url")).join(gold.select("source_url").distinct(), "source_url", "left_semi")
            rows = relations.join(of, "ord")
            places = chunks.select("source_url", "chunk_id", "chunk_index", "content")
            shown = rows.join(places, "source_url").where(F.contains("content", F.col("source_entity")) & F.contains("content", F.col("target_entity")))
            first = shown.groupBy("source_url", "ord", "i", "j", "source_entity", "target_entity", "relation_type").agg(F.min_by("chunk_id", "chunk_index").alias("chunk_id"))
            ident = F.concat_ws(":", F.col("ord").cast("string"), F.col("i").cast("string"), F.col("j").cast("string"))
            reference = lambda c: F.struct("source_url", "chunk_id", F.col(c).alias("evidence_text"))
            kept = outputs.backed_relations(first.select(ident.alias("relation_id"), F.col("source_entity").alias("source"), F.col("target_entity").alias("target"), F.col("relation_type").alias("type"), "source_url", "chunk_id", F.array(reference("source_entity"), reference("target_entity")).alias("references")), chunks)
            return gold.select("resolution_key", "source_url").join(kept, "source_url").select("resolution_key", F.struct("source", "target", "type", "source_url", "chunk_id").alias("relation"))

        return self.run.stage("graph_relations", make)

    def publish(self, gold: DataFrame, references: DataFrame, chunks: DataFrame, bronze: DataFrame, docs: DataFrame, folder: str, relations: Callable[[], DataFrame] | None = None) -> dict[str, int]:
        """Write the profiles asked for and return how many records each has."""
        schema, name, s = self.schema(), str(self.request.get("name", "dataset")), self.settings
        form = str(self.request.get("output_format", s.output_format))
        guess = records.inferred_identity(schema)
        identity = self.request.get("identity_fields") or ([guess] if guess else [])
        made = {
            "structured": lambda: outputs.structured_records(gold, schema, name, "1.0"), "rag": lambda: outputs.rag_records(gold, chunks, schema, name, "1.0"),
            "graphrag": lambda: outputs.graph_records(gold, outputs.claims(gold, references, chunks), identity, relations() if relations else None, name, "1.0"),
        }
        counts, where = {}, lambda what: f"{folder}/{what}.json" if form == "json" else f"{folder}/{what}"
        for profile in outputs.profiles(self.request.get("profiles"), True):
            out = self.run.stage(f"output_{profile}", made[profile])
            write_records(out, where(profile), form)
            counts[profile] = out.count()
        for wanted, what, df in ((s.save_raw_content, "raw", bronze), (s.save_clean_content, "clean", docs)):
            if wanted:
                write_records(df, where(what), form)
        return counts

    def execute(self, candidates: DataFrame, fetched: DataFrame, folder: str, previews: DataFrame | None = None, crawled: DataFrame | None = None, proposals: DataFrame | None = None) -> dict[str, int]:
        """All stages, from candidates and what was fetched of them to files.

        Stages are those of the request, the schema, the settings and the contents of
        candidates, previews, crawled pages and proposals; pages fetched anew for the
        same candidates need a run of another name. Without an eligible source, and
        without any content, the run ends as failed.
        """
        self.draft_schema()
        schema = self.schema() if self.settings.require_schema_approval else self.request.get("schema") or DEFAULT_SCHEMA
        self.run.of(self.request, schema, vars(self.settings), *(None if df is None else fingerprint(df) for df in (candidates, previews, crawled, proposals)))
        registry = self.register(candidates)
        evaluated = self.evaluate(candidates, previews, proposals)
        if crawled is not None:
            registry = self.register_explored(candidates, self.explore(registry, evaluated, crawled))
        selected = self.select(evaluated, registry)
        if selected.isEmpty():
            self.fail("no source is eligible")
        if previews is not None:
            self.run.stage("schema_previews", lambda: sources.schema_previews(selected, previews))
        decisions = evaluated.select("canonical_url", "decision", F.col("hard_reasons").alias("reasons"))
        none = evaluated.select("url", F.lit(True).alias("fetch_success")).where("false")
        self.run.stage("registry_after", lambda: sources.registry_previews(sources.registry_decisions(registry, decisions), none if previews is None else previews))
        bronze = self.acquire(fetched, selected)
        docs = self.clean(bronze)
        chunks = self.chunk(docs)
        if chunks.isEmpty():
            self.fail("no source has content")
        extracted = self.extract(docs, chunks)
        bound = self.bind(extracted, chunks)
        fields = self.validate_evidence(bound)
        assessed = self.gate(fields, chunks, selected)
        resolved = self.resolve(fields, assessed, chunks)
        enriched = self.enrich(docs, extracted)
        self.run.stage("entities", lambda: enrich.mentions(enriched, self.request.get("entity_types", {})))
        relations = self.run.stage("relations", lambda: enrich.relations(enriched, self.request.get("relation_rules", ())))
        validated = self.validate(resolved, enriched)
        references = self.run.stage("references", lambda: self.references(fields, resolved))
        deduplicated = self.deduplicate(validated, references, docs)
        gold = self.gold(validated, deduplicated)
        self.rejections(candidates, evaluated, bronze, docs, bound, assessed, validated, deduplicated)
        counts = self.publish(gold, references, chunks, bronze, docs, folder, lambda: self.graph_relations(gold, relations, enriched, chunks))
        self.run.save_manifest(status="completed", outputs=counts, metrics=self.stage_counts(validated, deduplicated))
        return counts
