"""Files in and out: fixtures, JSON and JSON-lines sinks, stage tables and run manifests."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A file of one JSON value."""
    return spark.read.json(path, multiLine=True)


def safe_name(name: str) -> str:
    """A file name of letters, digits, dots, underscores and hyphens."""
    return re.sub(r"[^A-Za-z0-9._-]+", "_", name).strip("._") or "run"


def _file(spark: SparkSession, uri: str):
    """A path and its file system, whatever store it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, uri: str, pieces: Iterable[str]) -> None:
    """One UTF-8 file in any store that Spark writes to."""
    path, system = _file(spark, uri)
    out = system.create(path, True)
    try:
        for piece in pieces:
            out.write(bytearray(piece.encode()))
    finally:
        out.close()


def replace_text(spark: SparkSession, uri: str, text: str) -> None:
    """Write a file beside its place and put it there: a reader finds the old one or the new one, never a part."""
    draft, system = _file(spark, f"{uri}.{uuid.uuid4().hex}")
    write_text(spark, f"{uri}.{draft.getName().rpartition('.')[2]}", [text])
    path, _ = _file(spark, uri)
    try:
        files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        files.rename(draft, path, options)
    except Py4JJavaError:  # a store without such a rename, where a file is put there whole anyway
        write_text(spark, uri, [text])
        system.delete(draft, False)


def read_text(spark: SparkSession, uri: str) -> str | None:
    """The file's text; null if there is none."""
    path, system = _file(spark, uri)
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_records(records: DataFrame, path: str, form: str = "jsonl") -> None:
    """``jsonl``: a folder of JSON lines; ``json``: one file of a JSON array; ``parquet``. All are written in parallel."""
    if form == "jsonl":
        records.write.mode("overwrite").json(path)
    elif form == "parquet":
        records.write.mode("overwrite").parquet(path)
    elif form == "json":
        write_array(records, path)
    else:
        raise ValueError(f"unknown output format: {form}")


def _indented(rows: pd.Series) -> pd.Series:
    return rows.map(lambda j: "\n".join("  " + x for x in json.dumps(json.loads(j), ensure_ascii=False, indent=2).split("\n")))


def write_array(records: DataFrame, path: str) -> None:
    """One file that is an indented JSON array of the records, in their order.

    Tasks indent the records and write parts, in which each ends with the comma
    and line end that separate it from the next; the parts are then put one after
    another as streams of bytes, the last without its end: no record comes to the
    driver's Python.
    """
    spark = records.sparkSession
    parts, system = _file(spark, f"{path}.parts")
    lines = records.select(F.pandas_udf(_indented, "string")(F.to_json(F.struct("*"))).alias("value"))
    lines.write.mode("overwrite").option("lineSep", ",\n").text(parts.toString())
    found = sorted((f.getPath().toString(), f.getLen()) for f in system.listStatus(parts) if f.getPath().getName().startswith("part-") and f.getLen() > 0)
    target, _ = _file(spark, path)
    out = system.create(target, True)
    try:
        out.write(bytearray(b"[\n" if found else b"[]\n"))
        for i, (name, size) in enumerate(found):
            source = system.open(spark._jvm.org.apache.hadoop.fs.Path(name))
            try:
                spark._jvm.org.apache.commons.io.IOUtils.copyLarge(source, out, 0, size - 2 * (i + 1 == len(found)))
            finally:
                source.close()
        out.write(bytearray(b"\n]\n" if found else b""))
    finally:
        out.close()
    system.delete(parts, True)


class Run:
    """A run's folder: a manifest of its settings and status, and a Parquet table for each stage that ended.

    Stages are kept under a hash of ``made_of`` (request, schema, settings and, if
    given, the inputs' fingerprint): when any of these changes, stages are made
    anew. Before ``of`` there is no folder for a stage.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.made_of = spark, f"{folder.rstrip('/')}/{safe_name(name)}", ""

    def save_manifest(self, **values: Any) -> None:
        replace_text(self.spark, f"{self.folder}/manifest.json", json.dumps(self.manifest() | values, ensure_ascii=False, indent=2, default=str))

    def manifest(self) -> dict[str, Any]:
        return json.loads(read_text(self.spark, f"{self.folder}/manifest.json") or "{}")

    def of(self, *parts: Any) -> None:
        self.made_of = hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]

    def path(self, stage: str) -> str:
        if not self.made_of:
            raise RuntimeError("call of() first: stages of different requests would share a folder")
        return f"{self.folder}/{self.made_of}/{stage}"

    def has(self, stage: str) -> bool:
        path, system = _file(self.spark, f"{self.path(stage)}/_SUCCESS")
        return system.exists(path)

    def stage(self, stage: str, make, counters: Mapping[str, Column] | None = None) -> DataFrame:
        """The stage's table: read if an earlier run has written it, else made and written.

        ``counters``: aggregates that are taken while it is written and kept beside
        it; ``counted`` gives them.
        """
        if not self.has(stage):
            made, seen = make(), Observation(stage)
            if counters:
                made = made.observe(seen, *(c.alias(n) for n, c in counters.items()))
            made.write.mode("overwrite").parquet(self.path(stage))
            if counters:
                replace_text(self.spark, f"{self.path(stage)}.counters.json", json.dumps(seen.get))
        return self.spark.read.parquet(self.path(stage))

    def counted(self, stage: str) -> dict[str, int] | None:
        """What was counted while a stage was written; null if nothing was."""
        found = read_text(self.spark, f"{self.path(stage)}.counters.json")
        return json.loads(found) if found else None
