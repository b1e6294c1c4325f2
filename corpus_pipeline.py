"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; run() writes each stage's result to the shared folder and reads it again,
so a lost executor costs no earlier stage.

All stages decide row by row: null ids, repeated ids and repeated rows have no
meaning of their own but where a stage says so. Null texts count as empty ones.
Very long texts are read in parts. Further columns, whatever their names, stay
as they are up to the last stage. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attesta.llm.decontam import decontaminated
from attesta.llm.mixing import mixed_documents
from attesta.llm.neardup import deduplicated
from attesta.llm.quality import accepted
from attesta.llm.queries import tokenizer_path
from attesta.llm.token_shards import token_shards
from attesta.session import Stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, each by its own text; an empty text is judged like any other."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of the smallest id; rows without id come last, of rows equal in id and text one stays, and all empty texts are one class."""
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text holds no benchmark passage; empty texts hold none."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to twice; each row has its own count. A null source is one of its own, last in order."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, read back, in the order of ids: null ones first, equal ones by their texts. An empty text is its end id alone."""
    return token_shards(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("token_output", token_output)]

#: Learned scores, signatures and draws aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    stage = Stage(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        docs = stage.put(step(spark, docs, sf_dir), name)
        if last:
            stage.drop(last)
        last = name
    return docs
