"""Output profiles: structured, rag and graphrag records of the accepted ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions import text
from attesta.operators.evidence import traced
from attesta.operators.records import filled
from attesta.session import Stage, numbered

PROFILES = ("structured", "rag", "graphrag")


def profiles(asked: str | Sequence[str] | None, approved_schema: bool) -> list[str]:
    """The profiles asked for, once each and in order; graph_rag and graph-rag are graphrag."""
    names = ["structured"] if asked is None else [asked] if isinstance(asked, str) else list(asked)
    if not names:
        raise ValueError("at least one output profile is needed")
    out = list(dict.fromkeys({"graph_rag": "graphrag", "graph-rag": "graphrag"}.get(n := str(p).strip().casefold(), n) for p in names))
    if unknown := [n for n in out if n not in PROFILES]:
        raise ValueError(f"unknown output profile: {unknown[0]}")
    if not approved_schema and out != ["structured"]:
        raise ValueError("rag and graphrag need an approved schema")
    return out


def plain_value(value: Column) -> Column:
    """A JSON text as it reads: strings without quotes, anything else as canonical JSON."""
    v = F.try_parse_json(value)
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def is_title_name(name: Column) -> Column:
    low = F.lower(name)
    return low.isin("name", "title") | low.endswith("_name") | low.endswith("_title")


def rag_text(data: Column, schema: Sequence[Mapping]) -> Column:
    """The text or content field, else a line ``Label: value`` for each filled field."""
    value = lambda n: F.element_at(data, n)
    prose = [F.when(F.schema_of_variant(F.try_parse_json(value(n))) == "STRING", text.empty_to_null(text.strip(plain_value(value(n))))) for n in ("text", "content")]
    lines = [F.when(filled(value(f["field_name"])), F.concat(F.lit(text.title_label(f["field_name"]) + ": "), plain_value(value(f["field_name"])))) for f in schema]
    return F.coalesce(*prose, text.strip(F.concat_ws("\n", *lines)))


def record_title(data: Column, default: Column) -> Column:
    """The first text field that is named like a name or title."""
    texts = F.filter(F.map_entries(data), lambda e: is_title_name(e["key"]) & e["value"].startswith('"') & ~F.regexp_like(e["value"], F.lit(r'^"\s*"$')))
    return F.coalesce(text.strip(plain_value(F.get(texts, F.lit(0))["value"])), default, F.lit(""))


def rag_records(records: DataFrame, chunks: DataFrame, schema: Sequence[Mapping], schema_name: str, schema_version: str) -> DataFrame:
    """Retrieval-ready records. ``records``: as resolve gives them, with source_title and language."""
    first = F.element_at("contributors", 1)
    rows = records.withColumn("_u", first["source_url"]).withColumn("chunk_id", first["chunk_id"])
    heads = chunks.select(F.col("source_url").alias("_u"), "chunk_id", F.col("heading").alias("section_path"))
    out = rows.join(heads, ["_u", "chunk_id"], "left")
    return out.select(
        rag_text(F.col("data"), schema).alias("text"), record_title(F.col("data"), F.col("source_title")).alias("title"), F.col("_u").alias("source_url"), "source_urls", F.coalesce("section_path", F.lit("")).alias("section_path"), "chunk_id",
        "language", F.col("evidence_quality_score").alias("quality_score"), F.col("data").alias("record_data"), F.lit(schema_name).alias("schema_name"), F.lit(schema_version).alias("schema_version"),
    )


def claims(records: DataFrame, evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """claim_id, resolution_key, predicate, value and evidence of each filled field that has traceable evidence.

    ``evidence``: resolution_key, field, source_url, chunk_id, evidence_text.
    """
    rows = records.select("resolution_key", F.explode("data").alias("predicate", "value")).where(filled(F.col("value")))
    good = traced(evidence, chunks).where("traceable").groupBy("resolution_key", F.col("field").alias("predicate"))
    good = good.agg(F.array_sort(F.collect_set(F.struct("source_url", "chunk_id", "evidence_text"))).alias("evidence"))
    quoted = lambda c: F.to_json(c.cast("variant"))
    material = F.concat(F.lit("["), quoted(F.coalesce("resolution_key", F.lit(""))), F.lit(","), quoted(F.col("predicate")), F.lit(","), F.to_json(F.parse_json("value")), F.lit("]"))
    return rows.join(good, ["resolution_key", "predicate"]).select(F.sha2(F.encode(material, "UTF-8"), 256).alias("claim_id"), "resolution_key", "predicate", "value", "evidence")


def graph_entities(claim_rows: DataFrame, identity_fields: Sequence[str]) -> DataFrame:
    """Entities: the claims of identity fields."""
    wanted = F.col("predicate").isin(*identity_fields) if identity_fields else F.lit(False)
    return claim_rows.where(wanted).select("resolution_key", plain_value(F.col("value")).alias("name"), F.col("predicate").alias("field_name"), "evidence")


def graph_records(records: DataFrame, claim_rows: DataFrame, identity_fields: Sequence[str], relation_rows: DataFrame | None, schema_name: str, schema_version: str) -> DataFrame:
    """A record each: record_key, entities, claims, relations, provenance, quality and the schema's name and version.

    ``records``: as resolve gives them; ``relation_rows``: resolution_key and
    relation (a struct), those that backed_relations lets through.
    """
    claim = claim_rows.groupBy("resolution_key").agg(F.array_sort(F.collect_list(F.struct("predicate", "claim_id", "value", "evidence"))).alias("claims"))
    named = graph_entities(claim_rows, identity_fields).groupBy("resolution_key").agg(F.array_sort(F.collect_list(F.struct("field_name", "name", "evidence"))).alias("entities"))
    out = records.join(claim, "resolution_key", "left").join(named, "resolution_key", "left")
    if relation_rows is not None:
        out = out.join(relation_rows.groupBy("resolution_key").agg(F.array_sort(F.collect_list("relation")).alias("relations")), "resolution_key", "left")
    else:
        out = out.withColumn("relations", F.array().cast("array<string>"))
    return out.select(
        F.col("resolution_key").alias("record_key"), "entities", "claims", "relations", F.struct("source_url", "source_urls", "contributors", "resolution_method", "resolution_key").alias("provenance"),
        F.struct("evidence_quality_score", F.col("evidence_support_statuses").alias("support_statuses")).alias("quality"), F.lit(schema_name).alias("schema_name"), F.lit(schema_version).alias("schema_version"),
    )


def backed_relations(relations: DataFrame, chunks: DataFrame) -> DataFrame:
    """Relations all of whose references are traceable. ``relations``: relation_id, source, target, type, references (array)."""
    refs = relations.select("relation_id", F.explode("references").alias("r")).select("relation_id", "r.*")
    bad = traced(refs, chunks).where("not traceable").select("relation_id").distinct()
    return relations.join(bad, "relation_id", "left_anti")


def structured_records(records: DataFrame, schema: Sequence[Mapping], schema_name: str, schema_version: str) -> DataFrame:
    """Data with evidence quality, provenance and the schema as sub-structs."""
    return records.select(
        "data", F.struct("source_url", "source_urls", "contributing_chunk_ids", "contributing_record_ids", "contributors", "resolution_method", "resolution_key", "merge_conflicts").alias("provenance"),
        F.struct("evidence_quality_score", F.col("evidence_support_statuses").alias("support_statuses")).alias("quality"),
        F.struct(F.lit(schema_name).alias("name"), F.lit(schema_version).alias("schema_version"), F.array(*(F.lit(f["field_name"]) for f in schema)).alias("fields")).alias("schema_metadata"),
    )


def legacy_records(documents: DataFrame) -> DataFrame:
    """Records of the older layout: a random id, a running title, the content and a few tags. ``documents``: ord, domain, cleaned_content, category, confidence_score.

    Titles are numbered through the whole output.
    """
    rows = numbered(Stage(documents.sparkSession, "legacy"), documents, [F.col("ord")], "_n")
    short = F.substring(F.regexp_replace(F.uuid(), "-", ""), 1, 6)
    title = F.concat(F.lit("Extracted Knowledge "), (F.col("_n") + 1).cast("string"))
    return rows.select("ord", F.concat("domain", F.lit("-"), short).alias("id"), "domain", title.alias("title"), F.col("cleaned_content").alias("content"), F.array("category").alias("tags"), "confidence_score", F.lit("validated").alias("validation_status"))
