"""Exploring sites: an iterative frontier of links, the best of each host first.

A round takes from the frontier the best pages of each host (query terms in the
address and title, then the smaller depth, then the address), fetches them, and
puts their links into the frontier unless they were seen. What was taken and what
waits is written out each round. A host gives ``max_pages`` over all starts and
rounds, a page that two starts reach being two; what else waits of it is given up
then. A start whose pages are all taken ends by itself while others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import urls
from attesta.operators.sources import first_by
from attesta.session import Stage

#: Start, canonical address, title, depth, the page that links to it, and its score.
FRONTIER = ("start_url", "url", "title", "depth", "parent_url")


def term_score(url: Column, title: Column, terms: Sequence[str]) -> Column:
    """Number of query terms in a page's address or title, case aside."""
    said = F.lower(F.concat_ws(" ", url, title))
    return sum((F.contains(said, F.lit(t.lower())).cast("int") for t in terms), F.lit(0))


def crawl(starts: DataFrame, fetch: Callable[[DataFrame], DataFrame], terms: Sequence[str] = (), max_depth: int = 2, max_pages: int = 10, a_round: int = 5, same_domain: bool = True) -> DataFrame:
    """Pages found from ``starts`` (url): start_url, ord, url, title, depth, parent_url, success, taken in this order.

    ``fetch`` gets a table of start_url and url and gives, for what could be
    fetched, url, link and title, a row for each link (null link: a page without).
    Links without a canonical form, to files and, if asked, to other hosts are left
    out; a page is taken once for each start. ``success`` is whether it could be
    fetched; only those up to ``max_depth`` - 1 are fetched for their links, the
    start itself first, which is no result.
    """
    stage = Stage(starts.sparkSession, "crawl")
    canonical = urls.any_canonical_url(F.col("url"))
    seeds = starts.select(canonical.alias("url")).where("url is not null").distinct()
    frontier = seeds.select(F.col("url").alias("start_url"), "url", F.lit("").alias("title"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent_url"))
    seen = stage.put(frontier.select("start_url", "url"), "seen-0")
    waiting, taken, n = stage.put(frontier, "waiting-0"), [], 0
    used = None
    while not waiting.isEmpty():
        score = term_score(F.col("url"), F.col("title"), terms)
        rows = waiting.withColumns({"score": score, "host": urls.host_of(F.col("url"))})
        order = Window.partitionBy("host").orderBy(F.desc("score"), "depth", "url", "start_url")
        # The first round takes all starts, the others the best of each host, of which a task hands on so many at most.
        best = rows if n == 0 else rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= a_round)
        if used is not None:
            best = best.join(used, "host", "left").where(F.coalesce("used", F.lit(0)) + F.col("nth") <= max_pages).drop("used", "nth")
        now = stage.put(best, f"taken-{n}")
        if now.isEmpty():
            break
        links = stage.put(fetch(now.where(F.col("depth") < max_depth).select("start_url", "url")), f"links-{n}")
        got = links.select("url").distinct().withColumn("got", F.lit(True))
        taken.append(now.join(got, "url", "left").withColumns({"success": F.coalesce("got", F.col("depth") >= max_depth), "round": F.lit(n)}))
        fresh = now.select("start_url", "url", "depth").join(links.where("link is not null"), "url")
        fresh = fresh.select("start_url", urls.any_canonical_url(F.col("link")).alias("target"), "title", (F.col("depth") + 1).alias("depth"), F.col("url").alias("parent_url")).withColumnRenamed("target", "url")
        keep = F.col("url").isNotNull() & urls.is_page_url(F.col("url"))
        if same_domain:
            keep = keep & (urls.host_of(F.col("url")) == urls.host_of(F.col("start_url")))
        fresh = first_by(fresh.where(keep), ["start_url", "url"], ["depth", "parent_url"]).join(seen, ["start_url", "url"], "left_anti")
        fresh = stage.put(fresh.select(*FRONTIER), f"fresh-{n}")
        counts = now.where("depth > 0").groupBy("host").agg(F.count("*").cast("int").alias("used"))
        counts = counts if used is None else counts.unionByName(used).groupBy("host").agg(F.sum("used").cast("int").alias("used"))
        n += 1
        used = stage.put(counts, f"used-{n}")
        left = waiting.join(now.select("start_url", "url"), ["start_url", "url"], "left_anti").unionByName(fresh).withColumn("host", urls.host_of(F.col("url")))
        waiting = stage.put(left.join(used.where(F.col("used") >= max_pages).select("host"), "host", "left_anti").select(*FRONTIER), f"waiting-{n}")
        seen = stage.put(seen.unionByName(fresh.select("start_url", "url")), f"seen-{n}")
        stage.drop(f"seen-{n - 1}", f"waiting-{n - 1}", f"fresh-{n - 1}", f"used-{n - 1}")
    kind = "start_url string, ord long, url string, title string, depth int, parent_url string, success boolean"
    if not taken:
        return starts.sparkSession.createDataFrame([], kind)
    out = taken[0]
    for more in taken[1:]:
        out = out.unionByName(more)
    place = F.row_number().over(Window.partitionBy("start_url").orderBy("round", F.desc("score"), "depth", "url")).cast("long")
    return out.where("depth > 0").withColumn("ord", place).select(*(f.split(" ")[0] for f in kind.split(", ")))
