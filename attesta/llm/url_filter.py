"""URL filter: suffix rules first, a ratio of two character models for the rest.

Two variable-order Markov models over characters, one of accepted and one of
rejected URLs, are counted over all URLs that a rule decides. A context is used
as far back as it was seen MIN_CONTEXT times; its estimate is interpolated with
the next shorter one (Witten-Bell). A URL's score is the difference of its two
log-likelihoods divided by its length; a logistic curve, fitted on the URLs that
a hash holds out of counting, turns the score into a verdict.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm._hash import slices
from attesta.session import Stage

#: The longest context in characters. With 50 symbols there are under 50**4 * 2 counts, whatever the corpus: the broadcast model's bound.
ORDER = 3
#: Times a context must occur to be used.
MIN_CONTEXT = 4
#: Every FOLDS-th URL by hash calibrates and isn't counted.
FOLDS = 5
#: Bins of the calibration histogram, from -SPAN to SPAN nats a character.
BINS, SPAN = 2001, 10.0

_SYMBOLS = b"abcdefghijklmnopqrstuvwxyz0123456789./-_?=&%:#+~"
END, REST = 0, 1
SIZE = len(_SYMBOLS) + 2
_CODE = np.full(256, REST, np.int64)
_CODE[np.frombuffer(_SYMBOLS, np.uint8)] = np.arange(2, SIZE)
_CODE[ord("A") : ord("Z") + 1] = _CODE[ord("a") : ord("z") + 1]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits the host or a parent domain and starts the path; else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), len(r[1].partition("/")[0]))):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(raw: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row of each position (a URL's characters and its end), and its code with 0 to ``order`` characters of context.

    A code is the number, in base SIZE with a leading 1, of the context and the symbol.
    """
    n = np.diff(offsets)
    ends = np.cumsum(n + 1) - 1
    symbols = np.full(int(n.sum()) + len(n), END, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = _CODE[raw]
    rows = np.repeat(np.arange(len(n)), n + 1)
    place = np.arange(len(symbols)) - np.repeat(ends - n, n + 1)
    codes, code = [SIZE + symbols], symbols.copy()
    for k in range(1, order + 1):
        back = np.zeros(len(symbols), np.int64)
        back[k:] = symbols[:-k]
        code = code + np.where(place >= k, back, END) * SIZE**k
        codes.append(SIZE ** (k + 1) + code)
    return rows, codes


def _count(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Counts of one task: (model, code, n)."""
    held: dict[bool, list] = {False: [], True: []}

    def pack(model: bool) -> None:
        codes, n = (np.concatenate(x) for x in zip(*held[model], strict=True))
        codes, back = np.unique(codes, return_inverse=True)
        held[model] = [(codes, np.bincount(back, n).astype(np.int64))]

    for batch in batches:
        good = batch.column(1).to_numpy(zero_copy_only=False)
        for at, raw, offsets in slices(batch.column(0)):
            rows, codes = _grams(raw, offsets, order)
            for model in (False, True):
                mine = (good[at : at + len(offsets) - 1] == model)[rows]
                for code in codes:
                    held[model].append(np.unique(code[mine], return_counts=True))
                if len(held[model]) > 64:
                    pack(model)
    for model in (False, True):
        if held[model]:
            pack(model)
            codes, n = held[model][0]
            for i in range(0, len(codes), 100_000):
                part = codes[i : i + 100_000]
                yield pa.RecordBatch.from_pydict({"model": pa.array([model] * len(part)), "code": pa.array(part), "n": pa.array(n[i : i + 100_000])})


class CharModel:
    """Log-probabilities from sorted codes and counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, min_context: int = MIN_CONTEXT):
        order = np.argsort(codes)
        self.codes, self.counts = codes[order], counts[order].astype(np.float64)
        contexts, at = np.unique(self.codes // SIZE, return_inverse=True)
        total, types = np.bincount(at, self.counts, len(contexts)), np.bincount(at, minlength=len(contexts)).astype(np.float64)
        keep = (total >= min_context) | (contexts == 1)
        self.contexts, self.total, self.types = contexts[keep], total[keep], types[keep]

    def log_prob(self, codes: list[np.ndarray]) -> np.ndarray:
        """Log-probability of each position, given its codes with 0, 1, ... characters of context."""
        p = np.full(len(codes[0]), 1.0 / SIZE)
        for code in codes:
            if not len(self.contexts):
                break
            c = np.minimum(np.searchsorted(self.contexts, code // SIZE), len(self.contexts) - 1)
            known = self.contexts[c] == code // SIZE
            g = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            n = np.where(self.codes[g] == code, self.counts[g], 0.0)
            p = np.where(known, (n + self.types[c] * p) / (self.total[c] + self.types[c]), p)
        return np.log(p)


def _score(batches: Iterator[pa.RecordBatch], order: int, models) -> Iterator[pa.RecordBatch]:
    bad, good = models.value
    for batch in batches:
        at_col = batch.schema.names.index("url")
        out = np.zeros(len(batch))
        for at, raw, offsets in slices(batch.column(at_col)):
            rows, codes = _grams(raw, offsets, order)
            n = len(offsets) - 1
            out[at : at + n] = np.bincount(rows, good.log_prob(codes) - bad.log_prob(codes), n) / (np.diff(offsets) + 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "score"])


def _logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(accepted | score), either class weighing the same; a slight pull to (1, 0) keeps them finite."""
    a, b = 1.0, 0.0
    w1, w0 = good / max(good.sum(), 1), bad / max(bad.sum(), 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = (w1 + w0) * p - w1
        h = (w1 + w0) * p * (1 - p)
        grad = np.array([(g * x).sum() + 1e-3 * (a - 1), g.sum() + 1e-3 * b])
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - float(np.clip(step[0], -5, 5)), b - float(np.clip(step[1], -5, 5))
    return a, b


def url_filter(urls: DataFrame, rules: Sequence[tuple[str, str]], order: int = ORDER, min_context: int = MIN_CONTEXT, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score and p_allow of every row.

    ``rules`` are (``allow`` or ``block``, host and path) pairs; the longest
    that fits decides. Where none fits, the verdict is allow if the calibrated
    probability of an accepted URL is ``threshold`` or more. Null and empty URLs
    and those without ``://`` have empty host and path, fit no rule and are
    scored as the text they have; with no rule-decided URL to learn from, every
    score is 0 and p_allow 0.5. Repeated rows each count and are each judged;
    other columns are ignored.
    """
    spark = urls.sparkSession
    stage = Stage(spark, "urls")
    host, path = host_and_path(F.col("url"))
    rows = urls.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("hit", matched_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select("page_id", "url", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("verdict"))
    known = rows.where("verdict is not null").withColumn("held", F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0).withColumn("good", F.col("verdict") == "allow")
    counts = known.where("not held").select(F.coalesce("url", F.lit("")).alias("url"), "good").mapInArrow(partial(_count, order=order), "model boolean, code long, n long")
    got = stage.put(counts.groupBy("model", "code").agg(F.sum("n").alias("n")), "counts").toPandas()
    models = tuple(CharModel(g["code"].to_numpy(np.int64), g["n"].to_numpy(np.int64), min_context) for g in (got[~got["model"].astype(bool)], got[got["model"].astype(bool)]))
    stage.drop("")
    held = spark.sparkContext.broadcast(models)
    score = partial(_score, order=order, models=held)
    bin_of = F.least(F.greatest(F.floor((F.col("score") + SPAN) * ((BINS - 1) / (2 * SPAN)) + 0.5), F.lit(0)), F.lit(BINS - 1))
    scored = known.where("held").select("url", "good").mapInArrow(score, "url string, good boolean, score double")
    seen = scored.groupBy("good", bin_of.cast("int").alias("bin")).count().collect()
    table = np.zeros((2, BINS))
    for r in seen:
        table[int(r["good"]), r["bin"]] = r["count"]
    a, b = _logistic(np.linspace(-SPAN, SPAN, BINS), table[1], table[0])
    out = rows.mapInArrow(score, "page_id " + rows.schema["page_id"].dataType.simpleString() + ", url string, host string, path string, rule string, verdict string, score double")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("score") * a + b)))
    verdict = F.coalesce(F.col("verdict"), F.when(F.col("p_allow") >= threshold, "allow").otherwise("block"))
    return out.withColumn("p_allow", p).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", "p_allow")
