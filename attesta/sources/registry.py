"""A registry that grows by batches, of which each touches only the buckets of its own keys.

The table holds facts: for a canonical URL and a kind (a spelling, an origin, a
title and so on) the value that came first, and when. Facts of two batches merge
by taking the earlier one, whatever the order of the batches, so the registry
after any batches is that of all their rows at once.

A bucket is a folder of its own version; a manifest says which version of each
bucket counts and is replaced in one step when a batch is whole. What a failed
batch has written is never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text, urls
from attesta.sources.files import read_text, replace_text

BUCKETS = 64
LISTS = ("original_urls", "origins", "providers")
FACTS = "canonical_url string, kind string, key string, value string, ord long"


def facts(found: DataFrame) -> DataFrame:
    """FACTS of found rows (as sources.registry_upsert takes them), the first of each kind and key."""
    flag = lambda c: F.when(F.coalesce(F.col(c), F.lit(False)), "true")
    each = [("row", F.lit(""), F.lit("")), ("original_urls", text.strip(F.col("url")), text.strip(F.col("url"))), ("origins", F.col("origin"), F.col("origin")), ("providers", F.lower("provider"), F.col("provider")), ("title", F.lit(""), text.empty_to_null(F.col("title"))), ("description", F.lit(""), text.empty_to_null(F.col("description"))), ("seed", F.lit(""), flag("seed")), ("preferred", F.lit(""), flag("preferred"))]
    listed = F.array(*(F.struct(F.lit(kind).alias("kind"), key.alias("key"), value.alias("value")) for kind, key, value in each))
    if "metadata" in found.columns:
        listed = F.concat(listed, F.transform(F.map_entries(F.coalesce("metadata", F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lit("metadata").alias("kind"), e["key"].alias("key"), e["value"].alias("value"))))
    rows = found.select(urls.any_canonical_url(F.col("url")).alias("canonical_url"), F.col("ord").cast("long").alias("ord"), F.explode(listed).alias("f")).where("canonical_url is not null")
    rows = rows.select("canonical_url", "f.kind", "f.key", "f.value", "ord").where("value is not null and (value != '' or kind in ('row', 'metadata'))")
    return first_facts(rows)


def first_facts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("canonical_url", "kind", "key").agg(F.min(F.struct("ord", "value")).alias("x")).select("canonical_url", "kind", "key", "x.value", "x.ord")


def registry_of(rows: DataFrame) -> DataFrame:
    """The registry that facts stand for: one candidate for each canonical URL, as sources.registry_upsert gives it."""
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    entries = lambda kind, *c: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct(*c))))
    out = rows.groupBy("canonical_url").agg(
        of("row", "ord").alias("ord"), *(F.coalesce(of(c, "value"), F.lit("")).alias(c) for c in ("title", "description")), *(F.coalesce(of(k, "value"), F.lit("")).alias(k) for k in ("seed", "preferred")),
        *(F.transform(entries(kind, "ord", "value"), lambda x: x["value"]).alias(kind) for kind in LISTS), F.map_from_entries(entries("metadata", "key", "value")).alias("metadata"),
    )
    return out.withColumns({"user_seed": F.col("seed") == "true", "preferred_domain_match": F.col("preferred") == "true", "domain": urls.host_of(F.col("canonical_url"))}).drop("seed", "preferred")


class Registry:
    """The facts' table in the folder ``uri``."""

    def __init__(self, spark: SparkSession, uri: str, buckets: int = BUCKETS):
        self.spark, self.uri = spark, uri.rstrip("/")
        self.buckets = self._manifest().get("buckets", buckets)

    def _manifest(self) -> dict:
        return json.loads(read_text(self.spark, f"{self.uri}/manifest.json") or "{}")

    def facts(self, buckets: list[int] | None = None) -> DataFrame:
        """The facts of all buckets, or of some."""
        have = self._manifest().get("versions", {})
        paths = [f"{self.uri}/{version}/bucket={b}" for b, version in have.items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(FACTS).parquet(*paths) if paths else self.spark.createDataFrame([], FACTS)

    def read(self) -> DataFrame:
        return registry_of(self.facts())

    def merge(self, found: DataFrame) -> list[int]:
        """Take in a batch of found rows; gives the buckets that were written anew."""
        version = uuid.uuid4().hex
        bucket = F.pmod(F.xxhash64("canonical_url"), F.lit(self.buckets)).cast("int")
        batch = facts(found).withColumn("bucket", bucket)
        batch.write.partitionBy("bucket").parquet(f"{self.uri}/batch-{version}")
        batch = self.spark.read.schema(f"{FACTS}, bucket int").parquet(f"{self.uri}/batch-{version}")
        touched = sorted(r["bucket"] for r in batch.select("bucket").distinct().collect())  # a row a bucket
        both = first_facts(self.facts(touched).unionByName(batch.drop("bucket"))).withColumn("bucket", bucket)
        both.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.uri}/{version}")
        manifest = self._manifest()
        versions = manifest.get("versions", {}) | {str(b): version for b in touched}
        replace_text(self.spark, f"{self.uri}/manifest.json", json.dumps({"buckets": self.buckets, "versions": versions}))
        return touched
