"""Classification, metadata, entities, relations, quality reports and normalisation of documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import scores, text


def classify(docs: DataFrame, categories: Sequence[str] = ("general",)) -> DataFrame:
    body = F.coalesce("cleaned_content", F.lit(""))
    return docs.withColumn("doc_type", text.document_type(body)).withColumn("category", text.category(body, categories))


def enrich_metadata(docs: DataFrame, extractions: DataFrame | None, topic: str, schema_version: str = "1.0") -> DataFrame:
    """Adds one struct of metadata. ``docs``: source, title, source_domain, cleaned_content, doc_type, category, confidence_score, hashes; ``extractions``: ord, source_url, confidence, the latest of a source counts."""
    out = docs
    if extractions is not None:
        w = Window.partitionBy("source_url").orderBy(F.desc("ord"))
        last = extractions.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(F.col("source_url").alias("_u"), F.col("confidence").alias("_c"))
        out = docs.join(last, docs["source"] == F.col("_u"), "left").drop("_u")
    else:
        out = out.withColumn("_c", F.lit(None).cast("double"))
    body = F.coalesce("cleaned_content", F.lit(""))
    meta = F.struct(
        F.coalesce("source", F.lit("")).alias("source_url"), F.coalesce("doc_type", F.lit("text")).alias("source_type"), F.coalesce("title", F.lit("")).alias("source_title"), F.coalesce("source_domain", F.lit("")).alias("source_domain"),
        F.lit(topic).alias("dataset_topic"), F.lit(schema_version).alias("schema_version"), F.coalesce("category", F.lit("general")).alias("category"), text.language_guess(body).alias("language"), text.space_count(body).alias("word_count"),
        F.coalesce("_c", "confidence_score", F.lit(0.0)).alias("confidence_score"), F.coalesce("content_hash", F.lit("")).alias("content_hash"), F.coalesce("processed_content_hash", F.lit("")).alias("processed_content_hash"),
    )
    return out.withColumn("metadata", meta).drop("_c")


def with_base_documents(merged: DataFrame, classified: DataFrame) -> DataFrame:
    """Merged records with their source's document, or an empty one made for them."""
    base = classified.groupBy(F.col("source").alias("_s")).agg(F.max_by(F.struct("title", "cleaned_content", "doc_type", "category"), "ord").alias("_b"))
    out = merged.join(base, merged["source_url"] == F.col("_s"), "left")
    return out.select(merged["*"], F.coalesce("_b.title", F.lit("")).alias("title"), F.coalesce("_b.cleaned_content", F.lit("")).alias("cleaned_content"), F.coalesce("_b.doc_type", F.lit("text")).alias("doc_type"), F.coalesce("_b.category", F.lit("general")).alias("category"))


def mentions(docs: DataFrame, keywords: Mapping[str, str] = {}) -> DataFrame:  # noqa: B006
    """ord, nth, name and type of each document's entities."""
    rows = docs.select("ord", F.posexplode(text.entities(F.col("cleaned_content"))).alias("nth", "name"))
    return rows.withColumn("type", text.entity_type(F.col("name"), keywords))


def relations(docs: DataFrame, rules: Sequence[Mapping[str, str]] = ()) -> DataFrame:
    """RELATED_TO from each entity of a document to each later one.

    Pairs come from within a document's own list, so nothing is joined. A rule's
    source_type and target_type are compared with entity names; the last rule
    that fits sets the type.
    """
    names = text.entities(F.col("cleaned_content"))
    first = docs.select("ord", names.alias("names")).select("ord", "names", F.posexplode("names").alias("i", "source_entity"))
    pairs = first.select("ord", "i", "source_entity", F.posexplode(F.slice("names", F.col("i") + 2, F.size("names"))).alias("j", "target_entity"))
    kind = F.lit("RELATED_TO")
    for rule in rules:
        fits = F.lit(False)
        for key, side in (("source_type", "source_entity"), ("target_type", "target_entity")):
            if rule.get(key):
                fits = fits | (F.col(side) == rule[key])
        kind = F.when(fits, rule.get("relation_type", "RELATED_TO")).otherwise(kind)
    return pairs.select("ord", "i", (F.col("i") + 1 + F.col("j")).alias("j"), "source_entity", "target_entity", kind.alias("relation_type"))


def quality_reports(docs: DataFrame, least_words: int = 10, least_quality: float = 0.4, least_confidence: float = 0.0) -> DataFrame:
    """Adds quality_report. ``docs``: cleaned_content, entity_count, relation_count, confidence_score."""
    body = F.coalesce("cleaned_content", F.lit(""))
    present = [body != "", F.col("entity_count") > 0, F.col("relation_count") > 0, F.lit(True)]
    return docs.withColumn("quality_report", scores.quality_report(body, present, text.space_count(body), F.coalesce("confidence_score", F.lit(0.0)), least_words, least_quality, least_confidence))


def normalise(docs: DataFrame, replacements: Mapping[str, str] = {}, column: str = "cleaned_content") -> DataFrame:  # noqa: B006
    """Adds normalised_content: NFC (only where a text may need it), white space collapsed, replacements made."""
    body = F.coalesce(F.col(column), F.lit(""))
    odd = text.needs_exact_cleaning(body)
    return docs.withColumn("normalised_content", F.when(odd, text.normalised(body, replacements, composed=False)).otherwise(text.normalised(body, replacements)))
