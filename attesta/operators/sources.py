"""Candidates and their previews: registry, policy evaluation, selection, exploration, acquisition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import scores, text, urls
from attesta.session import Stage, numbered

#: Quality that a new domain, or a new source type, may cost against the best one left.
DOMAIN_TOLERANCE, TYPE_TOLERANCE = 0.15, 0.08
CACHE_HITS = ("hit", "cache_hit", "read", "cached")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row of each key, the first in the order given."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


def ordered_lists(rows: DataFrame, key: str, columns: Mapping[str, Column], folded: Sequence[str] = ()) -> DataFrame:
    """For each key the values of each column, once each and in order, without nulls and empties; those of ``folded`` columns whatever their case.

    Repeats are combined before they are shuffled, so a key that a great part of
    the rows share costs no more than its different values. ``rows`` has ord.
    """
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("n"), c.alias("v"), (F.lower(c) if n in folded else c).alias("k")) for n, c in columns.items())))
    one = rows.select(key, "ord", each.alias("x")).where("x.v is not null and x.v != ''").groupBy(key, "x.n", "x.k").agg(F.min("ord").alias("ord"), F.min_by("x.v", "ord").alias("v"))
    per = one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "n", "v"))).alias("_all"))
    of = lambda n: F.transform(F.filter("_all", lambda x: x["n"] == n), lambda x: x["v"]).alias(n)
    return per.select(key, *(of(n) for n in columns))


def registry_upsert(found: DataFrame) -> DataFrame:
    """One candidate for each canonical URL.

    ``found``: ord, url, origin, title, description, provider, seed, preferred,
    metadata (map). Spellings, origins and providers (the latter whatever their
    case) are listed once, in order; the first title and description that are
    there stay; flags are or-ed; of a metadata key the first value stays. Rows
    whose URL has no canonical form are dropped; see rejected_urls.
    """
    rows = found.withColumn("canonical_url", urls.any_canonical_url(F.col("url"))).where("canonical_url is not null")
    first = lambda c: F.min_by(text.empty_to_null(F.col(c)), F.when(F.col(c) != "", F.col("ord")))
    merged = rows.groupBy("canonical_url").agg(
        F.min("ord").alias("ord"), F.coalesce(first("title"), F.lit("")).alias("title"), F.coalesce(first("description"), F.lit("")).alias("description"),
        F.bool_or(F.coalesce("seed", F.lit(False))).alias("user_seed"), F.bool_or(F.coalesce("preferred", F.lit(False))).alias("preferred_domain_match"),
    )
    lists = ordered_lists(rows, "canonical_url", {"original_urls": text.strip(F.col("url")), "origins": F.col("origin"), "providers": F.col("provider")}, folded=["providers"])
    merged = merged.join(lists, "canonical_url").withColumn("domain", urls.host_of(F.col("canonical_url")))
    if "metadata" not in found.columns:
        return merged
    pairs = first_by(rows.select("canonical_url", "ord", F.explode("metadata").alias("k", "v")), ["canonical_url", "k"], ["ord"])
    maps = pairs.groupBy("canonical_url").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("metadata"))
    return merged.join(maps, "canonical_url", "left")


def rejected_urls(found: DataFrame) -> DataFrame:
    return found.where(urls.any_canonical_url(F.col("url")).isNull())


def registry_decisions(registry: DataFrame, evaluations: DataFrame) -> DataFrame:
    """The registry with each candidate's evaluation state, and reasons listed once whatever their case.

    ``evaluations``: canonical_url, decision, reasons (array).
    """
    low = F.transform("reasons", F.lower)
    once = F.filter(F.transform("reasons", lambda r, i: F.when(F.array_position(low, F.lower(r)) == i + 1, r)), lambda r: r.isNotNull())
    seen = evaluations.select("canonical_url", "decision", once.alias("reasons"))
    out = registry.join(seen, "canonical_url", "left")
    state = F.when(F.col("decision") == "select", "selected").when(F.col("decision").isNotNull(), "rejected").otherwise("pending")
    reasons = F.when(F.col("decision") == "reject", F.col("reasons")).otherwise(F.array().cast("array<string>"))
    out = out.withColumn("evaluation_status", F.when(F.col("decision").isNull(), "pending").otherwise("completed"))
    return out.withColumn("selection_state", state).withColumn("selected", F.coalesce(F.col("decision") == "select", F.lit(False))).withColumn("rejection_reasons", reasons).drop("decision", "reasons")


def registry_previews(registry: DataFrame, seen: DataFrame) -> DataFrame:
    """The registry with each candidate's preview_status: success, failed or pending. ``seen``: url, fetch_success."""
    side = seen.groupBy(urls.any_canonical_url(F.col("url")).alias("canonical_url")).agg(F.bool_or(F.coalesce("fetch_success", F.lit(False))).alias("_ok"))
    out = registry.join(side, "canonical_url", "left")
    return out.withColumn("preview_status", F.when(F.col("_ok"), "success").when(~F.col("_ok"), "failed").otherwise("pending")).drop("_ok")


def pending(work: DataFrame, done: DataFrame, key: str = "canonical_url") -> DataFrame:
    """What isn't done yet."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def integrity(proposals: DataFrame, candidates: DataFrame, key: str = "canonical_url") -> DataFrame:
    """Each URL of either side and whether its proposals are ok, unknown, duplicate or missing."""
    p = proposals.groupBy(key).agg(F.count(F.lit(1)).alias("proposals"))
    c = candidates.groupBy(key).agg(F.count(F.lit(1)).alias("candidates"))
    both = p.join(c, key, "full_outer").na.fill(0, ["proposals", "candidates"])
    issue = F.when(F.col("candidates") == 0, "unknown").when(F.col("proposals") == 0, "missing").when(F.col("proposals") > 1, "duplicate").otherwise("ok")
    return both.withColumn("issue", issue)


def evaluate(sources: DataFrame, policy: Mapping) -> DataFrame:
    """Adds hard_reasons, policy_alignment_score, final_score, hard_policy_rejected and decision.

    ``sources``: url, source_type, content_depth, the four profile scores,
    recency_score, content_characteristics, topic_relevance_score, preview_success.
    """
    profile = {c: F.col(c) for c in ("authority_score", "technical_depth_score", "information_density_score", "extractability_score", "recency_score", "source_type", "content_characteristics")}
    out = sources.withColumn("hard_reasons", scores.hard_reasons(F.col("url"), F.col("source_type"), F.col("content_depth"), policy))
    out = out.withColumn("alignment", scores.policy_alignment(F.col("url"), profile, policy))
    out = out.withColumn("final_score", scores.final_score(F.col("topic_relevance_score"), F.col("alignment"))).withColumn("policy_alignment_score", F.round("alignment", 6)).drop("alignment")
    out = out.withColumn("hard_policy_rejected", F.size("hard_reasons") > 0)
    return out.withColumn("decision", scores.decision(F.col("hard_reasons"), F.col("preview_success"), F.col("topic_relevance_score"), F.col("final_score")))


def with_previews(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Candidates with what was seen of them: preview_success and preview_text, false and empty without a preview. ``seen`` as previews gives it; the URLs are compared canonically."""
    key = lambda c: F.coalesce(urls.any_canonical_url(F.col(c)), F.col(c))
    side = seen.groupBy(key("url").alias("_key")).agg(F.max(F.struct(F.coalesce("fetch_success", F.lit(False)).alias("ok"), F.coalesce("relevant_text", F.lit("")).alias("text"))).alias("_seen"))
    out = candidates.withColumn("_key", key("url")).join(side, "_key", "left")
    return out.withColumn("preview_success", F.coalesce("_seen.ok", F.lit(False))).withColumn("preview_text", F.coalesce("_seen.text", F.lit(""))).drop("_key", "_seen")


def seed_fallback(evaluated: DataFrame, candidates: DataFrame) -> DataFrame:
    """Where nothing was evaluated, the user's own sources in their order: url, ord, rank, reason and selection_origin. ``candidates``: ord, url, user_seed."""
    none = evaluated.agg((F.count(F.lit(1)) == 0).alias("_none"))  # one row
    seeds = candidates.where("user_seed").join(F.broadcast(none)).where("_none")
    return seeds.select("url", "ord", F.row_number().over(Window.orderBy("ord")).alias("rank"), F.lit("chosen by the user; nothing was evaluated").alias("reason"), F.lit("manual_override").alias("selection_origin"))


def schema_previews(selected: DataFrame, seen: DataFrame) -> DataFrame:
    """What was seen of the selected sources, by rank, each canonical URL once; has_preview is false where a schema can't be drawn from a source. ``selected``: url, rank."""
    key = lambda c: F.coalesce(urls.any_canonical_url(F.col(c)), F.col(c))
    first = first_by(selected.select(key("url").alias("_key"), "url", "rank"), ["_key"], ["rank"])
    side = seen.withColumn("_key", key("url")).drop("url", "error")
    out = first.join(first_by(side, ["_key"], [F.desc("fetch_success")]), "_key", "left")
    return out.withColumn("has_preview", F.coalesce("fetch_success", F.lit(False))).drop("_key", "fetch_success")


def mark_preview_duplicates(rows: DataFrame, quality: str = "quality", preview: str = "preview_text") -> DataFrame:
    """duplicate_of: the URL of the best row (then the earliest) of equal preview text, for all others of it.

    The best of a text is found by an aggregate and joined, so a text that many
    sources share is combined before it is shuffled.
    """
    body = text.strip(F.regexp_replace(F.col(preview), r"\s+", " "))
    rows = rows.withColumn("_body", F.when(body != "", F.sha2(body, 256)))
    best = rows.where("_body is not null").groupBy("_body").agg(F.max_by("url", F.struct(F.col(quality), -F.col("ord"))).alias("_best"))
    out = rows.join(best, "_body", "left")
    return out.withColumn("duplicate_of", F.when(F.col("_best") != F.col("url"), F.col("_best"))).drop("_body", "_best")


def diverse_top(rows: DataFrame, most: int, request: str = "request_id") -> DataFrame:
    """Greedy choice of ``most`` sources a request, preferring new domains, then new types, within a tolerance of the best quality left.

    ``rows``: request, ord, url, domain, source_type, quality; those that are
    eligible. The choice looks at what is chosen before, so each request is one
    group; it first keeps, for each type, the best ``most`` domains, and of each
    of these the best ``most`` rows: no other can be chosen, since what is chosen
    is the best row of some type but for rows and domains chosen before.
    """
    w = Window.partitionBy(request, "domain", "source_type").orderBy(F.desc("quality"), "ord")
    few = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most)
    of = Window.partitionBy(request, "source_type").orderBy(F.desc("quality"), "ord")
    heads = few.where("_r = 1").withColumn("_d", F.row_number().over(of)).where(F.col("_d") <= most).select(request, "source_type", "domain")
    few = few.drop("_r").join(heads, [request, "source_type", "domain"], "left_semi")

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        left = frame.sort_values(["quality", "ord"], ascending=[False, True])
        domains, kinds, out = set(), set(), []
        while len(left) and len(out) < most:
            best, pool = left["quality"].max(), left
            for seen, column, tolerance in ((domains, "domain", DOMAIN_TOLERANCE), (kinds, "source_type", TYPE_TOLERANCE)):
                new = pool[~pool[column].isin(seen) & (pool["quality"] >= best - tolerance)] if seen else pool[:0]
                pool = new if len(new) else pool
            one = pool.iloc[0]
            out.append((*(one[c] for c in (request, "ord", "url", "domain", "source_type", "quality")), len(out) + 1, bool(out) and one["domain"] not in domains, bool(out) and one["source_type"] not in kinds))
            domains.add(one["domain"])
            kinds.add(one["source_type"])
            left = left.drop(one.name)
        return pd.DataFrame(out, columns=[request, "ord", "url", "domain", "source_type", "quality", "rank", "adds_domain", "adds_type"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"{request} {kind[request]}, ord {kind['ord']}, url string, domain string, source_type string, quality double, rank int, adds_domain boolean, adds_type boolean"
    return few.select(request, "ord", "url", "domain", "source_type", "quality").groupBy(request).applyInPandas(choose, schema)


def eligible() -> Column:
    return (F.col("decision") == "select") & ~F.col("hard_policy_rejected") & F.col("preview_success") & F.col("duplicate_of").isNull()


def compatibility(rows: DataFrame, most: int) -> DataFrame:
    """Adds kept (the ``most`` selected rows of greatest score, the earlier of equals) and priority: the kept by score, then all others in input order. ``rows``: ord is unique."""
    best = rows.where("decision = 'select'").orderBy(F.desc("final_score"), "ord").limit(most).select("ord", "final_score")
    best = best.select(F.col("ord").alias("_ord"), F.row_number().over(Window.orderBy(F.desc("final_score"), "ord")).alias("_rank"))  # ``most`` rows
    out = rows.join(F.broadcast(best), F.col("ord") == F.col("_ord"), "left").withColumn("kept", F.col("_rank").isNotNull())
    out = numbered(Stage(rows.sparkSession, "compatibility"), out, [~F.col("kept"), F.col("ord")], "_n")
    return out.withColumn("priority", F.coalesce("_rank", F.col("_n") + 1).cast("int")).drop("_rank", "_ord", "_n")


def exploration_starts(candidates: DataFrame, most: int) -> DataFrame:
    """The first canonical URL of each host, selected candidates before seeds, ``most`` hosts. ``candidates``: ord, url, selected, user_seed."""
    rows = candidates.where("selected or user_seed").withColumn("canonical_url", urls.any_canonical_url(F.col("url"))).where("canonical_url is not null")
    rows = rows.withColumn("domain", urls.host_of(F.col("canonical_url"))).withColumn("turn", F.when(F.col("selected"), 0).otherwise(1))
    return first_by(rows, ["domain"], ["turn", "ord"]).orderBy("turn", "ord").limit(most).drop("turn")


def counts_map(df: DataFrame, column: str) -> DataFrame:
    """One row: a map of value to count, keys in order."""
    per = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias(f"count_by_{column}"))


def explored(pages: DataFrame, max_depth: int, max_pages: int, same_domain: bool = True) -> DataFrame:
    """Crawl results worth keeping: start_url, ord, url, title, depth, parent_url, success of any crawler.

    Kept are successes at depth 1 to ``max_depth`` whose URL has a canonical
    form, isn't the start's, isn't a file and is on the start's host (if asked);
    of a canonical URL the first counts, of a start the first ``max_pages``.
    """
    rows = pages.withColumn("canonical_url", urls.any_canonical_url(F.col("url"))).withColumn("start_canonical", urls.any_canonical_url(F.col("start_url")))
    keep = F.col("success") & F.col("depth").between(1, max_depth) & F.col("canonical_url").isNotNull() & (F.col("canonical_url") != F.col("start_canonical")) & urls.is_page_url(F.col("canonical_url"))
    if same_domain:
        keep = keep & (urls.host_of(F.col("canonical_url")) == urls.host_of(F.col("start_canonical")))
    rows = first_by(rows.where(keep), ["start_canonical", "canonical_url"], ["ord"])
    return per_group(rows, ["start_canonical"], ["ord"], max_pages)


def per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """The first ``most`` rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def distinct_queries(df: DataFrame, most: int, column: str = "query") -> DataFrame:
    """The first ``most`` values, blanks and case aside, in order."""
    rows = df.withColumn("_k", F.lower(text.strip(F.col(column)))).where("_k != ''")
    return first_by(rows, ["_k"], ["ord"]).drop("_k").orderBy("ord").limit(most)


def links(html: Column) -> Column:
    """Targets of a page's links in order, trimmed."""
    return F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit('href="([^"]*)"'), F.lit(1)), text.strip)


def normalise_acquired(df: DataFrame) -> DataFrame:
    """Documents of a provider in one form: source_url, canonical_url, title, domain, content_hash and the rest.

    ``df``: url, redirected_url, success, error, raw_markdown, fit_markdown, and
    metadata (map<string,string>). A failed row has the hash of no bytes.
    """
    meta = lambda k: text.empty_to_null(F.element_at("metadata", k))
    wanted = F.coalesce(urls.http_url(meta("canonical")), urls.http_url(meta("canonical_url")), urls.http_url(meta("og:url")), urls.http_url(F.col("redirected_url")), F.col("url"))
    body = F.when(F.col("success"), F.coalesce("raw_markdown", F.lit(""))).otherwise("")
    return df.select(
        F.col("url").alias("source_url"), wanted.alias("canonical_url"), F.coalesce(meta("title"), meta("og:title"), F.lit("")).alias("title"), urls.host_of(wanted).alias("domain"), "success", "error",
        body.alias("raw_markdown"), "fit_markdown", F.sha2(F.encode(body, "UTF-8"), 256).alias("content_hash"), "metadata",
    )


def as_pipeline_documents(df: DataFrame) -> DataFrame:
    """source, title, content and metadata of the acquired documents that succeeded; the fitted text goes before the raw one."""
    return df.where("success").select(F.coalesce(text.empty_to_null(F.col("canonical_url")), "source_url").alias("source"), "title", F.coalesce(text.empty_to_null(F.col("fit_markdown")), "raw_markdown").alias("content"), "metadata")


def acquisition_metrics(df: DataFrame) -> DataFrame:
    """requested, successful, failed and cache_hits; ``df``: success, cache_status."""
    hit = F.lower(F.col("cache_status")).isin(*CACHE_HITS)
    return df.agg(F.count(F.lit(1)).alias("requested"), F.count_if("success").alias("successful"), F.count_if(~F.col("success")).alias("failed"), F.count_if(hit).alias("cache_hits"))


def previews(df: DataFrame, most_words: int = 400) -> DataFrame:
    """Bounded evidence of each document for source decisions; ``df`` as normalise_acquired gives it."""
    raw = F.coalesce("raw_markdown", F.lit(""))
    preferred = F.coalesce(text.empty_to_null(F.col("fit_markdown")), raw)
    found = text.headings(F.when(raw != "", raw).otherwise(preferred))
    meta = lambda *keys: F.coalesce(*(text.empty_to_null(text.strip(F.element_at("metadata", k))) for k in keys))
    both = F.when(preferred != raw, F.concat(raw, F.lit("\n"), preferred)).otherwise(raw)
    return df.select(
        F.coalesce(text.empty_to_null(F.col("canonical_url")), "source_url").alias("url"), "title", "domain", found.alias("headings"), text.first_words(preferred, most_words).alias("relevant_text"),
        text.space_count(raw).alias("approximate_word_count"), F.least(text.space_count(preferred), F.lit(most_words)).alias("preview_word_count"), meta("language", "lang", "og:locale").alias("language"),
        meta("publication_date", "published_time", "article:published_time", "datePublished").alias("publication_date"), meta("updated_date", "modified_time", "article:modified_time", "dateModified").alias("updated_date"),
        text.structure_hints(both, found).alias("structure_hints"), F.col("success").alias("fetch_success"), "error",
    )
