"""Connectors: what fetches, searches or extracts comes in as a function and runs on the executors.

A provider's call fails for its own row alone: the failure becomes a row with
success = false and its error, and retries happen inside the call. A task that is
repeated, because its executor was lost, makes its calls again, but for those
that a ledger has (attesta.sources.ledger).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions.urls import host_of
from attesta.operators.sources import pending
from attesta.session import Stage, numbered

FETCHED = "ord long, url string, redirected_url string, success boolean, error string, raw_markdown string, fit_markdown string, html string, cache_status string, metadata map<string,string>"
#: Answers that another attempt doesn't change (fixed values).
FINAL_CODES = (400, 401, 403, 404, 422)
#: Words of errors that another attempt doesn't change (fixed values).
FINAL_WORDS = ("api key", "authentication", "unauthorized", "forbidden", "invalid model", "unsupported model", "invalid schema", "validation error", "configuration")


def is_retryable(error: BaseException) -> bool:
    """Whether a provider's error may pass: it has no final code or word and is no validation error."""
    codes = {getattr(error, name, None) for name in ("status_code", "status")}
    said = str(error).lower()
    return codes.isdisjoint(FINAL_CODES) and "ValidationError" not in {k.__name__ for k in type(error).__mro__} and not any(w in said for w in FINAL_WORDS)


def with_retries(call: Callable, *args, retries: int = 2, wait: Callable[[float], None] = time.sleep):
    """The call's result, tried again after 1, 2, 4, ... seconds while its errors may pass."""
    for attempt in range(retries + 1):
        try:
            return call(*args)
        except Exception as error:  # noqa: BLE001
            if attempt == retries or not is_retryable(error):
                raise
            wait(2.0**attempt)
    return None


def fetched_row(o: int, url: str, fetch: Callable[[str], Mapping], retries: int) -> tuple:
    """A row of FETCHED; a failure is one too."""
    try:
        got = with_retries(fetch, url, retries=retries)
        return o, url, got.get("redirected_url"), True, None, got.get("raw_markdown", ""), got.get("fit_markdown"), got.get("html"), got.get("cache_status"), {str(k): str(v) for k, v in (got.get("metadata") or {}).items()}
    except Exception as error:  # noqa: BLE001
        return o, url, None, False, f"{type(error).__name__}: {error}", "", None, None, None, {}


def with_slots(urls: DataFrame, lanes: int, delay: float, per_host: bool = True) -> DataFrame:
    """The rows (ord, url) with ``starts``, the seconds after the beginning when each may start, and its lane.

    The n-th URL of a host (or of all, if not ``per_host``) starts at n x ``delay``.
    Lanes take slots in turn, whatever their hosts: a host of a third of all URLs
    is in every lane. Numbers come from the global order, so no host is one task.
    """
    host = F.coalesce(host_of(F.col("url")), F.lit("")) if per_host else F.lit("")
    rows = numbered(Stage(urls.sparkSession, "slots"), urls.select("ord", "url", host.alias("_host")), [F.col("_host"), F.col("ord"), F.col("url")], "_n")
    first = rows.groupBy("_host").agg(F.min("_n").alias("_first"))
    rows = rows.join(first, "_host").withColumn("_slot", F.col("_n") - F.col("_first"))
    return rows.select("ord", "url", (F.col("_slot") * F.lit(float(delay))).alias("starts"), F.pmod(F.col("_slot") + F.xxhash64("_host"), F.lit(lanes)).cast("int").alias("lane"))


def acquire(urls: DataFrame, fetch: Callable[[str], Mapping], concurrency: int = 4, retries: int = 2, pause: float = 0.0, per_host: bool = True, clock: Callable[[], float] = time.time, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """One row for each URL (ord, url), fetched in ``concurrency`` lanes; ``ord`` is the order of the request.

    With a ``pause`` the starts of a host's URLs are that far apart over all lanes
    (with_slots), counted from when this is called; a lane goes through its slots
    in their order. Rows come out in the order of starts within a lane: order by
    ``ord`` for that of the request.
    """
    began = clock()
    fields = [c.split(" ")[0] for c in FETCHED.split(", ")]
    if not pause:
        dealt = urls.select("ord", "url", F.lit(0.0).alias("starts"), F.lit(0).alias("lane")).repartition(concurrency, "url")
    else:
        dealt = with_slots(urls, concurrency, pause, per_host).repartitionByRange(concurrency, "lane").sortWithinPartitions("starts", "ord")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for o, url, starts in zip(frame["ord"], frame["url"], frame["starts"], strict=True):
                while pause and (left := began + starts - clock()) > 0:
                    wait(left)
                rows.append(fetched_row(o, url, fetch, retries))
            yield pd.DataFrame(rows, columns=fields)

    return dealt.mapInPandas(run, FETCHED)


def in_request_order(urls: DataFrame, got: DataFrame) -> DataFrame:
    """A row for each URL asked for, numbered by ``ord``: what the provider left out is a failure, what it gave beyond is dropped."""
    return urls.select("ord", "url").join(got.drop("ord").dropDuplicates(["url"]), "url", "left").withColumns({
        "error": F.when(F.col("success").isNull(), "the provider gave no result").otherwise(F.col("error")), "success": F.coalesce("success", F.lit(False)), "raw_markdown": F.coalesce("raw_markdown", F.lit("")),
    })


def search(spark: SparkSession, queries: list[str], find: Callable[[str, int], list[Mapping]], limit: int) -> DataFrame:
    """Search results as candidates; those without URL are dropped."""
    rows, schema = [], "ord long, url string, origin string, title string, description string, provider string, seed boolean, preferred boolean"
    for query in queries:
        for hit in find(query, limit):
            if hit.get("url"):
                rows.append((len(rows), hit["url"], f"search:{query}", hit.get("title", ""), hit.get("description", ""), hit.get("provider", ""), False, False))
    return spark.createDataFrame(rows, schema)


def seeds(spark: SparkSession, urls: list[str]) -> DataFrame:
    rows = [(i - len(urls), u, "seed", "", "", "", True, False) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "ord long, url string, origin string, title string, description string, provider string, seed boolean, preferred boolean")


def missing_previews(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """The (url, query) pairs that no cached preview answers."""
    keyed = lambda d: d.withColumn("_k", F.sha2(F.concat_ws("\x1f", "url", F.coalesce("query", F.lit(""))), 256))
    return pending(keyed(wanted), keyed(cache), "_k").drop("_k")
