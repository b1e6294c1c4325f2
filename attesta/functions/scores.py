"""Scoring expressions. Weights and thresholds are fixed values of the method."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from attesta.functions.text import labels
from attesta.functions.urls import host_of, matches_any

#: What an importance weighs in the policy alignment.
IMPORTANCE = {"low": 0.5, "medium": 1.0, "high": 2.0}
#: What the importance of technical depth multiplies its share of the selection quality by.
TECHNICAL = {"low": 0.5, "medium": 1.0, "high": 1.5}
DEPTHS = {"unknown": 0, "shallow": 1, "medium": 2, "deep": 3}
RELEVANCE_SHARE, ALIGNMENT_SHARE = 0.55, 0.45
LEAST_RELEVANCE, LEAST_FINAL = 0.5, 0.55
#: Weights of the evidence statuses.
SUPPORT = {"supported": 1.0, "partially_supported": 0.5, "unsupported": 0.0, "contradicted": 0.0}
DUPLICATE = {"unique": 1.0, "duplicate": 0.0, "not_evaluated": 0.5}


def ratio(a: Column, b: Column) -> Column:
    """a / b to six places; 0 if b is 0."""
    return F.coalesce(F.round(F.try_divide(a.cast("double"), b.cast("double")), 6), F.lit(0.0))


def clamp(c: Column, default: float | None = None) -> Column:
    out = F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    return out if default is None else F.when(c.isNull(), F.lit(default)).otherwise(out)


def bounded(c: Column) -> Column:
    """A score from any value, held to 0 to 1; 0.5 where it is no number."""
    return clamp(c.try_cast("double"), 0.5)


def looked_up(c: Column, table: Mapping[str, float], default: float | None = None) -> Column:
    out = F.lit(default).cast("double")
    for key, value in table.items():
        out = F.when(c == key, F.lit(float(value))).otherwise(out)
    return out


def hard_reasons(url: Column, source_type: Column, depth: Column, policy: Mapping) -> Column:
    """Array of the explicit rules that a source breaks; rules that the policy leaves empty don't apply."""
    host, kind, out = host_of(url), F.lower(source_type), []
    tidy = lambda xs: sorted({x.strip().lower().replace(" ", "_").replace("-", "_") for x in xs or () if x.strip()})
    if policy.get("allowed_domains"):
        out.append(F.when(~matches_any(host, policy["allowed_domains"]), "domain_not_allowed"))
    if policy.get("blocked_domains"):
        out.append(F.when(matches_any(host, policy["blocked_domains"]), "domain_blocked"))
    if tidy(policy.get("allowed_source_types")):
        out.append(F.when(~kind.isin(*tidy(policy["allowed_source_types"])), "type_not_allowed"))
    if tidy(policy.get("blocked_source_types")):
        out.append(F.when(kind.isin(*tidy(policy["blocked_source_types"])), "type_blocked"))
    if policy.get("minimum_content_depth"):
        out.append(F.when(looked_up(depth, DEPTHS, 0) < DEPTHS[policy["minimum_content_depth"]], "too_shallow"))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


def policy_alignment(url: Column, profile: Mapping[str, Column], policy: Mapping) -> Column:
    """Weighted mean of the profile's scores, recency only where it is known, with bonuses and penalties; 0 to 1."""
    importance = {k: IMPORTANCE[v] for k, v in {"authority": "medium", "technical_depth": "medium", "information_density": "medium", "extractability": "medium", "recency": "medium", **(policy.get("importance") or {})}.items()}
    total = sum((profile[f"{k}_score"] * importance[k] for k in ("authority", "technical_depth", "information_density", "extractability")), F.lit(0.0))
    weight = F.lit(sum(importance[k] for k in ("authority", "technical_depth", "information_density", "extractability")))
    recent = profile["recency_score"]
    total = total + F.coalesce(recent * importance["recency"], F.lit(0.0))
    weight = weight + F.when(recent.isNotNull(), importance["recency"]).otherwise(0.0)
    tidy = lambda xs: sorted({x.strip().lower().replace(" ", "_").replace("-", "_") for x in xs or () if x.strip()})
    extra = F.lit(0.0)
    if tidy(policy.get("preferred_source_types")):
        extra = extra + F.when(F.lower(profile["source_type"]).isin(*tidy(policy["preferred_source_types"])), 0.10).otherwise(0.0)
    if policy.get("preferred_domains"):
        extra = extra + F.when(matches_any(host_of(url), policy["preferred_domains"]), 0.05).otherwise(0.0)
    have = labels(profile["content_characteristics"])
    for name, most in (("desired_content", 0.15), ("avoided_content", -0.20)):
        if wanted := tidy(policy.get(name)):
            extra = extra + F.size(F.array_intersect(have, F.array(*(F.lit(w) for w in wanted)))) * (most / len(wanted))
    return clamp(total / weight + extra)


def final_score(relevance: Column, alignment: Column) -> Column:
    return F.round(clamp(relevance) * RELEVANCE_SHARE + alignment * ALIGNMENT_SHARE, 6)


def decision(hard: Column, preview_ok: Column, relevance: Column, final: Column) -> Column:
    """select or reject."""
    return F.when((F.size(hard) == 0) & F.coalesce(preview_ok, F.lit(False)) & (clamp(relevance) >= LEAST_RELEVANCE) & (final >= LEAST_FINAL), "select").otherwise("reject")


def selection_quality(final: Column, density: Column, extractability: Column, technical: Column, importance: str = "medium") -> Column:
    w = 0.10 * TECHNICAL[importance]
    return F.round(clamp((final * 0.70 + density * 0.10 + extractability * 0.10 + technical * w) / (0.90 + w)), 6)


def record_quality(components: Sequence[Column]) -> Column:
    """Mean of the components, to six places."""
    return F.round(sum(components[1:], components[0]) / len(components), 6)


def quality_report(content: Column, present: Sequence[Column], words: Column, confidence: Column, least_words: int = 10, least_quality: float = 0.4, least_confidence: float = 0.0) -> Column:
    """Struct of completeness, content and overall scores and whether they pass. Filters nothing by itself.

    The overall score is the mean of whole hundredths, halves rounded up.
    """
    complete = F.round(sum((F.when(p, 1.0).otherwise(0.0) for p in present), F.lit(0.0)) / len(present), 2)
    amount = F.least(F.round(words.cast("double") / (least_words * 10), 2), F.lit(1.0))
    overall = F.floor((F.round(complete * 100) + F.round(amount * 100) + 1) / 2) / 100.0
    sure = confidence >= least_confidence
    return F.struct(complete.alias("completeness_score"), amount.alias("content_score"), overall.alias("overall_quality_score"), confidence.alias("confidence"), sure.alias("confidence_passed"), ((overall >= least_quality) & sure).alias("passed"))
