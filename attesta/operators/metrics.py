"""Evaluation and stage metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions.scores import ratio


def precision_at(ranked: DataFrame, k: int, group: str = "policy_id") -> DataFrame:
    """Share of gold ``select`` among the k best of each group. ``ranked``: group, score, ord, expected."""
    w = Window.partitionBy(group).orderBy(F.desc("score"), "ord")
    top = ranked.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    return top.groupBy(group).agg(ratio(F.count_if(F.col("expected") == "select"), F.count(F.lit(1))).alias(f"precision_at_{k}"))


def policy_metrics(rows: DataFrame, group: str = "policy_id") -> DataFrame:
    """Alignment accuracy and hard-violation rate of each group. ``rows``: group, decision, expected, hard_rejected."""
    chosen = F.col("decision") == "select"
    return rows.groupBy(group).agg(ratio(F.count_if(F.col("decision") == F.col("expected")), F.count(F.lit(1))).alias("accuracy"), ratio(F.count_if(chosen & F.col("hard_rejected")), F.count_if(chosen)).alias("hard_violation_rate"))


def changed_outcomes(rows: DataFrame, candidate: str = "candidate_id", column: str = "expected") -> DataFrame:
    """One row: candidates whose outcome isn't the same under every policy."""
    per = rows.groupBy(candidate).agg((F.min(column) != F.max(column)).alias("changed"))
    return per.agg(F.count_if("changed").alias("changed_outcomes"), F.count(F.lit(1)).alias("candidates"))


def largest_share(rows: DataFrame, column: str) -> DataFrame:
    """One row: the greatest share of a value, and the number of values."""
    per = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(ratio(F.max("n"), F.sum("n")).alias("max_share"), F.count(F.lit(1)).alias("distinct_values"))


def selection_metrics(rows: DataFrame) -> DataFrame:
    """One row: how many were evaluated and selected, the selected ones' domains, and their count by type (``type=n``, in order). ``rows``: decision, domain, source_type."""
    chosen = F.col("decision") == "select"
    per = rows.where(chosen).groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))
    types = per.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_type", "n"))), lambda x: F.concat(x["source_type"], F.lit("="), x["n"].cast("string"))), ",").alias("count_by_type"))
    return rows.agg(F.count(F.lit(1)).alias("evaluated"), F.count_if(chosen).alias("selected"), F.countDistinct(F.when(chosen, F.col("domain"))).alias("selected_domains")).join(types)


def duplicate_share(rows: DataFrame, flag: str = "is_duplicate") -> DataFrame:
    return rows.agg(ratio(F.count_if(flag), F.count(F.lit(1))).alias("duplicate_rate"))


def extraction_metrics(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: record and field precision and recall, and the rates of valid, unsupported and repeated predictions.

    ``predicted``: page_id, ord, identity, fingerprint, schema_valid, fields
    (array of struct field, value, traceable); ``gold``: page_id, identity,
    fields (map of field to value). A gold record is matched once, by the first
    prediction of its identity; the fields of later ones still count.
    """
    g = gold.select(F.col("page_id").alias("_p"), F.col("identity").alias("_i"), F.col("fields").alias("gold_fields"))
    both = predicted.join(g, (predicted["page_id"] == F.col("_p")) & (predicted["identity"] == F.col("_i")), "left")
    w = Window.partitionBy("page_id", "identity").orderBy("ord")
    v = Window.partitionBy("page_id", "fingerprint").orderBy("ord")
    both = both.withColumn("first_of_identity", F.row_number().over(w) == 1).withColumn("repeat", F.row_number().over(v) > 1)
    right = F.filter("fields", lambda f: F.coalesce(F.element_at("gold_fields", f["field"]) == f["value"], F.lit(False)))
    rows = both.select(
        (F.col("gold_fields").isNotNull() & F.col("first_of_identity")).alias("matched"), "schema_valid", "repeat", F.size("fields").alias("n"), F.size(F.filter("fields", lambda f: ~f["traceable"])).alias("untraceable"), F.size(right).alias("right"),
        "page_id", "identity", F.transform(right, lambda f: f["field"]).alias("recalled"),
    )
    recalled = rows.select("page_id", "identity", F.explode("recalled").alias("field")).distinct().agg(F.count(F.lit(1)).alias("recalled_fields"))
    p = rows.agg(F.count(F.lit(1)).alias("predicted_records"), F.count_if("matched").alias("m"), F.count_if("schema_valid").alias("valid"), F.count_if("repeat").alias("r"), F.sum("n").alias("f"), F.sum("untraceable").alias("u"), F.sum("right").alias("c"))
    e = gold.agg(F.count(F.lit(1)).alias("expected_records"), F.sum(F.size("fields")).alias("ef"))
    one = p.join(e).join(recalled)  # three single rows
    return one.select(
        "expected_records", "predicted_records", ratio(F.col("m"), F.col("predicted_records")).alias("record_precision"), ratio(F.col("m"), F.col("expected_records")).alias("record_recall"), ratio(F.col("c"), F.col("f")).alias("field_precision"),
        ratio(F.col("recalled_fields"), F.col("ef")).alias("field_recall"), ratio(F.col("valid"), F.col("predicted_records")).alias("schema_valid_rate"), ratio(F.col("u"), F.col("f")).alias("unsupported_field_rate"), ratio(F.col("r"), F.col("predicted_records")).alias("duplicate_rate"),
    )


def stage_counts(rows: DataFrame, column: str, values: Sequence[str], prefix: str = "") -> DataFrame:
    """One row with a count for each of a fixed set of values, zeros included, and the total."""
    return rows.agg(*(c.alias(n) for n, c in stage_counters(column, values, prefix).items()))


def stage_counters(column: str, values: Sequence[str], prefix: str = "") -> dict[str, Column]:
    """The same as aggregates, to be taken while a stage is written."""
    return {f"{prefix}total": F.count(F.lit(1))} | {f"{prefix}{v}": F.count_if(F.col(column) == v) for v in values}
