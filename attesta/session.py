"""Session construction and the shared scratch area.

Nothing here is specific to one machine: the scratch folder is the one the
cluster names in ``spark.checkpoint.dir`` and a local folder is used only when
that setting is absent (tests, local mode).
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SCRATCH: dict[str, str] = {}
#: Bytes of an Arrow batch that Python functions over texts get.
BATCH_BYTES = 4 << 20
_PLACE_BITS = 33  # of monotonically_increasing_id
#: Rows that are written to an executor's disk at once.
KEPT_ROWS = 1000
#: Partitions that a table is written in: for each core of the cluster, and one for so many of a shuffle.
FILES_A_CORE, MERGED = 2, 16


def build_session(app: str = "attesta", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and Arrow transfer."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if "spark.master" not in conf and not os.environ.get("MASTER"):
        builder = builder.master(f"local[{cpus}]")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that the driver and all executors share."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or ""
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("on a cluster, set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        path = tempfile.mkdtemp(prefix="attesta-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _LOCAL_SCRATCH[app] = f"file://{path}"
    return _LOCAL_SCRATCH[app]


def small_batches(df: DataFrame) -> DataFrame:
    """The same DataFrame; from now on its session hands BATCH_BYTES at most (or one row) to Python at once.

    The setting is Spark's own and read when a query is planned; a smaller one stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    set_to = re.fullmatch(r"(\d+)\s*([kmg]?)b?", conf.get(name).strip().lower())
    if set_to is None or int(set_to[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[set_to[2]] > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def compact(df: DataFrame, share: float = 1.0) -> DataFrame:
    """The same rows in fewer partitions, without a shuffle: FILES_A_CORE for each core, or one for MERGED partitions of a shuffle, whichever is more.

    For the last step before a table is written: filters and joins leave many
    small partitions, and each would be a file. ``share``: of that number, for
    tables of a few narrow columns.
    """
    spark = df.sparkSession
    most = max(FILES_A_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // MERGED)
    return df.coalesce(max(1, int(most * share)))


def of_longs(spark: SparkSession, rows: Sequence[Sequence[int]], *names: str) -> DataFrame:
    """A small table of long columns that the driver has. It goes by Arrow into the plan: rows of Python objects would be an RDD that starts Python workers of its own on the executors, beside those of the Arrow functions."""
    return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=[*names]))


class Stage:
    """Tables and files of one operator call.

    ``put`` writes a DataFrame as Parquet into the shared folder and reads it
    again. That cuts the lineage at a durable copy: a lost executor costs a
    reread, never a recomputation of everything before it. ``keep`` is for
    smaller steps between such tables: executors keep the rows on their disks,
    and what a lost one had is computed again from its lineage. A plan holds the
    plans of all that is kept below it, once for each time that it is read, and
    the driver holds these plans: what is read several times, in steps that are
    read several times again, is better put. ``close`` gives up
    all that was kept and all tables but those named. What a result still reads
    goes when the application ends, or by clear_scratch.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.uri = f"{_scratch(spark)}/{what}-{uuid.uuid4().hex}"
        self.kept: list[DataFrame] = []
        self.tables: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def put(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """``by``: columns of few values that get a folder each, so that reading one of them reads no other."""
        self.tables.add(name)
        df.write.mode("overwrite").partitionBy(*by).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def keep(self, df: DataFrame) -> DataFrame:
        conf, name = self.spark.conf, "spark.sql.inMemoryColumnarStorage.batchSize"
        if int(conf.get(name)) > KEPT_ROWS:  # rows that are put together in memory on their way to the disk
            conf.set(name, str(KEPT_ROWS))
        self.kept.append(df.persist(StorageLevel.DISK_ONLY))
        return df

    def release(self, df: DataFrame) -> None:
        """Give up one that was kept, when what is left to do has read it."""
        df.unpersist()
        self.kept.remove(df)

    def close(self, *but: str) -> None:
        while self.kept:
            self.kept.pop().unpersist()
        self.drop(*sorted(self.tables - {*but}))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            _delete(self.spark, self.path(name))
            self.tables.discard(name)


def numbered(stage: Stage, df: DataFrame, order: Sequence[Column], column: str, name: str = "numbered") -> DataFrame:
    """The rows with their number from 0 in a total order, without gathering them in one task.

    They are sorted by range and written; a row's number is its place in its
    partition and the sizes of those before, which alone come to the driver.
    """
    at, part = "_at", F.shiftrightunsigned("_at", _PLACE_BITS)
    rows = stage.put(compact(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())), name)
    before, starts = 0, []
    for r in sorted(rows.groupBy(part.alias("_part")).count().collect()):
        starts.append((r["_part"], before))
        before += r["count"]
    starts = F.broadcast(of_longs(stage.spark, starts, "_part", "_start"))
    rows = rows.withColumn("_part", part).join(starts, "_part")
    return rows.withColumn(column, F.col("_start") + F.col(at).bitwiseAND((1 << _PLACE_BITS) - 1)).drop("_part", "_start", at)


def with_row_keys(stage: Stage, df: DataFrame) -> tuple[DataFrame, Column]:
    """The rows, and a column of them that tells every row from all others: a hash of its file, and its place there.

    Only a table of files, read as it is, has such places that stay the same;
    anything else is written as one first.
    """
    if df._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation" or not df.inputFiles():
        df = stage.put(df, "rows")
    if not df.inputFiles():
        return df, F.struct(F.lit(0).cast("long").alias("file"), F.lit(0).cast("long").alias("row"))
    where = df.metadataColumn("_metadata")
    return df, F.struct(F.xxhash64(where["file_path"]).alias("file"), where["row_index"].alias("row"))


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/attesta/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables and files that operators of this application have put into the shared folder. Results that read them are void then."""
    _delete(spark, _scratch(spark))


def _at_end() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        clear_scratch(spark)


atexit.register(_at_end)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the input folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
