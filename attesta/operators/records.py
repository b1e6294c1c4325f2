"""Resolution of records across sources, merging of fields, deduplication and validation.

A record's data is a map of field to JSON text: it keeps the fields' order and
tells an absent field from a null one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import text
from attesta.operators import merging
from attesta.operators.duplicates import deduplicate
from attesta.operators.extraction import type_ok
from attesta.session import Stage

EMPTY_JSON = ("null", '""', "[]", "{}")
IDENTITIES = ("explicit_identity", "normalized_identity", "composite_identity")


def filled(value: Column) -> Column:
    """A JSON text that is there and is no null, empty text, list or object."""
    return value.isNotNull() & ~value.isin(*EMPTY_JSON)


def key_form(value: Column, compatible: bool = True) -> Column:
    """Form in which values are compared: texts folded (with NFKC if ``compatible``), anything else as canonical JSON.

    Resolution and deduplication compare with NFKC, merging without: there only
    case and white space are put aside.
    """
    variant = F.try_parse_json(value)
    plain = F.coalesce(F.try_variant_get(variant, "$", "string"), value)
    is_text = F.schema_of_variant(variant) == "STRING"
    ascii_only = plain.rlike(r"^[\x20-\x7e\t\n\r]*$")
    form = F.when(ascii_only, text.plain_folded(plain)).otherwise(text.folded(plain)) if compatible else text.plain_folded(plain)
    return F.when(is_text, F.to_json(form.cast("variant"))).otherwise(F.coalesce(F.to_json(variant), value))


def inferred_identity(schema: Sequence[Mapping]) -> str | None:
    """The first scalar field that is named like an id, else like a name or title."""
    scalar = [f["field_name"] for f in schema if f["type"] in ("string", "integer", "number")]
    for names, ends in ((("id", "code", "sku"), ("_id",)), (("name", "title"), ("_name", "_title"))):
        for name in scalar:
            if name.casefold() in names or name.casefold().endswith(ends):
                return name
    return None


def with_identity(records: DataFrame, schema: Sequence[Mapping], identity_fields: Sequence[str] = ()) -> DataFrame:
    """Adds resolution_method and resolution_key. ``records``: source_url, local_record_id, data."""
    value = lambda f: F.element_at("data", f)
    local = F.to_json(F.array("source_url", "local_record_id"))
    if identity_fields:
        whole = F.lit(True)
        for f in identity_fields:
            whole = whole & F.coalesce(filled(value(f)), F.lit(False))
        name = "composite_identity" if len(identity_fields) > 1 else "explicit_identity"
        key = F.concat(F.lit("["), F.concat_ws(",", *(key_form(value(f)) for f in identity_fields)), F.lit("]"))
        method = F.when(whole, name).otherwise("local_record")
        return records.withColumn("resolution_method", method).withColumn("resolution_key", F.when(whole, key).otherwise(local))
    guess = inferred_identity(schema)
    has = F.coalesce(filled(value(guess)), F.lit(False)) if guess else F.lit(False)
    key = key_form(value(guess)) if guess else local
    return records.withColumn("resolution_method", F.when(has, "normalized_identity").otherwise("local_record")).withColumn("resolution_key", F.when(has, key).otherwise(local))


def contributions(records: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows of the filled fields of each record: group columns, ord, nth (place in the record), field, value, key, confidence, source_url, chunk_id."""
    rows = records.select(*group, "ord", "source_url", "chunk_id", "confidence", "field_confidence", F.posexplode("data").alias("nth", "field", "value")).where(filled(F.col("value")))
    sure = F.coalesce(F.element_at("field_confidence", F.col("field")), F.col("confidence"))
    return rows.select(*group, "ord", "nth", "field", "value", key_form(F.col("value"), compatible=False).alias("key"), sure.cast("double").alias("confidence"), "source_url", "chunk_id")


_CONFLICT = merging.CONFLICT


def merge_fields(rows: DataFrame, group: Sequence[str], chunk: int = merging.CHUNK) -> DataFrame:
    """One value of each group and field, its confidence and the conflicts on the way.

    Contributions are taken in order: equal values keep the lower confidence, a
    different value replaces the one held only if its confidence is greater, and
    either way is noted. Lists are united, items compared as values are. Up to
    ``chunk`` contributions of a field are folded by an expression, more of them
    in chunks side by side (attesta.operators.merging).
    """
    keys = [*group, "field"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.bool_and(F.col("value").startswith("[")).alias("lists"), F.min("confidence").alias("least"), F.min(F.struct("ord", "nth")).alias("first"))
    no_conflicts = F.array().cast(f"array<{_CONFLICT}>")
    single = F.from_json("value", "array<variant>").alias("items")
    lists = merging.united_lists(rows.join(sizes.where("lists and n > 1").select(*keys), keys, "left_semi"), group, key_form_plain)
    lists = lists.join(sizes.where("lists and n > 1"), keys).select(*keys, F.col("united").alias("value"), F.col("least").alias("confidence"), no_conflicts.alias("conflicts"), "first")
    alone = rows.join(sizes.where("lists and n = 1").select(*keys), keys, "left_semi").select("*", single)
    alone = alone.select(*keys, F.concat(F.lit("["), F.array_join(F.transform("items", lambda v: F.to_json(v)), ","), F.lit("]")).alias("value"), "confidence", no_conflicts.alias("conflicts"), F.struct("ord", "nth").alias("first"))
    some = _folded_fields(rows.join(sizes.where(~F.col("lists") & (F.col("n") <= chunk)).select(*keys), keys, "left_semi"), keys)
    out = lists.unionByName(alone).unionByName(some)
    if not sizes.where(~F.col("lists") & (F.col("n") > chunk)).isEmpty():
        many = rows.join(sizes.where(~F.col("lists") & (F.col("n") > chunk)).select(*keys), keys, "left_semi")
        out = out.unionByName(merging.merged_in_chunks(Stage(rows.sparkSession, "merge"), many, group, chunk))
    return out


def _folded_fields(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The fold as an expression over each field's contributions, which are few."""
    items = F.array_sort(F.collect_list(F.struct("ord", "nth", "value", "key", "confidence", "source_url", "chunk_id")))
    got = rows.groupBy(*keys).agg(items.alias("items"))
    start = F.struct(F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("double").alias("confidence"), F.array().cast(f"array<{_CONFLICT}>").alias("conflicts"))

    def step(held: Column, new: Column) -> Column:
        same = held["key"] == new["key"]
        better = new["confidence"] > held["confidence"]
        note = F.struct(F.when(better, "incoming").otherwise("existing").alias("kept"), held["confidence"].alias("existing_confidence"), new["confidence"].alias("incoming_confidence"), new["source_url"].alias("incoming_source_url"), new["chunk_id"].alias("source_chunk_id"), held["value"].alias("existing_value"), new["value"].alias("incoming_value")).cast(_CONFLICT)
        first = held["key"].isNull()
        take = first | (~same & better)
        pick = lambda c: F.when(take, new[c]).otherwise(held[c])
        sure = F.when(first, new["confidence"]).when(same, F.least(held["confidence"], new["confidence"])).when(better, new["confidence"]).otherwise(held["confidence"])
        notes = F.when(first | same, held["conflicts"]).otherwise(F.concat(held["conflicts"], F.array(note)))
        return F.struct(pick("value").alias("value"), pick("key").alias("key"), sure.alias("confidence"), notes.alias("conflicts"))

    folded = got.withColumn("m", F.aggregate("items", start, step))
    return folded.select(*keys, "m.value", "m.confidence", "m.conflicts", F.struct(F.element_at("items", 1)["ord"], F.element_at("items", 1)["nth"]).alias("first"))


def resolve(records: DataFrame, schema: Sequence[Mapping], identity_fields: Sequence[str] = ()) -> DataFrame:
    """One row for each identity: its data, confidence, sources, contributors, and conflicts.

    ``records``: ord, source_url, local_record_id, chunk_id, extraction_method,
    confidence, data, field_confidence and, if assessed, quality and status.
    """
    keys = ["resolution_method", "resolution_key"]
    rows = with_identity(records, schema, identity_fields)
    fields = merge_fields(contributions(rows, keys), keys)
    conflicts = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("first", "field", "conflicts"))), lambda x: F.transform(x["conflicts"], lambda c: F.struct(x["field"].alias("field_name"), c.alias("conflict")))))
    data = F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("first", "field", "value"))), lambda x: F.struct(x["field"], x["value"])))
    sure = F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("first", "field", "confidence"))), lambda x: F.struct(x["field"], x["confidence"])))
    merged = fields.groupBy(*keys).agg(data.alias("data"), sure.alias("field_confidence"), conflicts.alias("merge_conflicts"))
    in_order = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct(*c).alias("v") if isinstance(c, tuple) else F.col(c).alias("v")))), lambda x: x["v"]))
    factual = F.size(F.map_filter("data", lambda _, v: filled(v))) > 0
    extra = [F.min("quality").alias("evidence_quality_score"), in_order("status").alias("evidence_support_statuses")] if "quality" in records.columns else []
    per = rows.groupBy(*keys).agg(
        F.min("ord").alias("ord"), F.coalesce(F.min(F.when(factual, F.col("confidence"))), F.lit(0.0)).alias("confidence"), in_order("source_url").alias("source_urls"), in_order("chunk_id").alias("contributing_chunk_ids"),
        in_order("local_record_id").alias("contributing_record_ids"), in_order("extraction_method").alias("extraction_methods"), in_order(("source_url", "local_record_id", "chunk_id", "extraction_method")).alias("contributors"), *extra,
    )
    return per.join(merged, keys, "left").withColumn("source_url", F.element_at("source_urls", 1))


# Deduplication


def fingerprint(data: Column) -> Column:
    """Canonical JSON of a record's normalised values, keys in order."""
    items = F.transform(F.array_sort(F.map_entries(data)), lambda e: F.concat(F.to_json(e["key"].cast("variant")), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}"))


def normalised_data(data: Column) -> Column:
    return F.transform_values(data, lambda _, v: F.coalesce(key_form_plain(v), v))


def key_form_plain(value: Column) -> Column:
    """key_form of ASCII values, usable inside lambdas."""
    variant = F.try_parse_json(value)
    return F.when(F.schema_of_variant(variant) == "STRING", F.to_json(text.plain_folded(F.try_variant_get(variant, "$", "string")).cast("variant"))).otherwise(F.to_json(variant))


def is_subset(a: Column, b: Column) -> Column:
    """Every filled field of ``a`` (normalised) is the same in ``b``, and there is one."""
    mine = F.map_filter(a, lambda _, v: filled(v))
    return (F.size(mine) > 0) & F.forall(F.map_entries(mine), lambda e: F.coalesce(F.element_at(b, e["key"]) == e["value"], F.lit(False)))


def dedup_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """input_records, output_records, duplicates_removed, one count a stage and identity_conflicts_retained."""
    stages = ("source_or_content", "exact_normalized_record", "schema_identity")
    n = lambda s: F.coalesce(F.sum(F.size(F.filter("absorbed", lambda x: x["stage"] == s))), F.lit(0)).cast("long").alias(s)
    out = after.agg(F.count(F.lit(1)).alias("output_records"), *(n(s) for s in stages), F.coalesce(F.sum("conflicts"), F.lit(0)).cast("long").alias("identity_conflicts_retained"))
    total = before.agg(F.count(F.lit(1)).alias("input_records"))
    return total.join(out).withColumn("duplicates_removed", F.col("input_records") - F.col("output_records"))


def dedup_rejections(after: DataFrame) -> DataFrame:
    return after.select(F.col("ord").alias("duplicate_of"), F.explode("absorbed").alias("a")).select("a.ord", "duplicate_of", F.lit("rejected").alias("status"), F.concat(F.lit("deduplication:"), F.col("a.stage")).alias("stage"))


def duplicate_rate(prints: DataFrame, column: str = "fingerprint") -> DataFrame:
    """Share of rows beyond the first of each fingerprint."""
    per = prints.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    rate = (F.sum("n") - F.count(F.lit(1))) / F.sum("n")
    return per.agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("distinct_records"), F.coalesce(rate.cast("double"), F.lit(0.0)).alias("remaining_duplicate_rate"))


# Validation


def schema_errors(data: Column, schema: Sequence[Mapping]) -> Column:
    """What a record's JSON text lacks or has in the wrong type, in schema order."""
    value, out = F.try_parse_json(data), []
    for f in schema:
        name, kind = f["field_name"], f["type"]
        have = F.try_variant_get(value, f"$.{name}", "variant")
        empty = have.isNull() | F.coalesce(F.is_variant_null(have), F.lit(False))
        if f.get("required") and not f.get("nullable"):
            out.append(F.when(empty, F.lit(f"missing:{name}")))
        out.append(F.when(~empty & ~type_ok(have, kind), F.lit(f"type:{name}")))
    return F.array_compact(F.array(*out))


def validate(records: DataFrame, schema: Sequence[Mapping], gate_applied: bool, least_confidence: float = 0.7, low_action: str = "reject") -> DataFrame:
    """Adds reasons and validation_status (validated, rejected or review). ``records``: content, data, confidence.

    Confidence decides only where the evidence gate didn't run.
    """
    low = F.lit(False) if gate_applied else F.coalesce(F.col("confidence"), F.lit(0.0)) < least_confidence
    reasons = F.concat(F.array_compact(F.array(F.when(text.strip(F.coalesce("content", F.lit(""))) == "", "empty_content"))), schema_errors(F.col("data"), schema), F.array_compact(F.array(F.when(low, "low_confidence"))))
    out = records.withColumn("reasons", reasons)
    bad = F.when(low & F.lit(low_action == "review"), "review").otherwise("rejected")
    method = "evidence_quality_gate_and_schema" if gate_applied else "schema_and_confidence"
    return out.withColumn("validation_status", F.when(F.size("reasons") == 0, "validated").otherwise(bad)).withColumn("validation_method", F.when(F.size("reasons") == 0, method))


def merged_by_source(records: DataFrame, identity_field: str | None) -> DataFrame:
    """Fields merged within each source, by the identity field where it has a value, else record by record."""
    key = F.concat(F.lit("record:"), F.col("local_record_id"))
    if identity_field:
        value = F.element_at("data", identity_field)
        key = F.when(filled(value), F.concat(F.lit("identity:"), key_form(value, compatible=False))).otherwise(key)
    group = ["merge_source", "merge_key"]
    return merge_fields(contributions(records.withColumn("merge_source", F.col("source_url")).withColumn("merge_key", key), group), group)


def latest(df: DataFrame, key: str) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("ord")))).where("_n = 1").drop("_n")
