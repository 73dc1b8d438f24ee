"""Quality classifier with hierarchical empirical Bayes.

A logistic classifier (trained on a bounded sample of labelled rows) gives each
document its evidence. Grouped aggregation over all documents gives good and
total counts per path and host; hosts shrink toward the global rate and paths
toward their host, with strengths estimated from the counts themselves. A
document's posterior adds its evidence to its site's shrunken log-odds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, hash_sample, materialize, ship_package

TRAIN_ROWS = 12_000  # bound on the labelled sample
N_TERMS, MIN_DOCS, MIN_Z = 200, 8, 6.0  # learned terms: bound, least documents, least z
PREFIX = 5  # bytes; a longer word also counts as its prefix, marked by a blank
DENSE = ["log_words", "word_len", "distinct", "same_as_last", "symbols", "shout", "bars", "dup_lines", "digits"]
#: every ASCII character but letters and digits becomes a blank
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(data: bytes) -> set[bytes]:
    """Distinct words of a text, and the prefixes of its longer words."""
    words = set(data.lower().translate(_PLAIN).split())
    return words | {w[:PREFIX] + b" " for w in words if len(w) > PREFIX}


def dense(data: bytes) -> list[float]:
    words = data.split()
    n = len(words) or 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        math.log1p(len(words)), min(20.0, len(data) / n), min(1.0, len(set(words)) / n ** 0.75),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        min(2.0, sum(map(data.count, (b"#", b"*", b"$", b"%", b"&"))) / n), min(2.0, data.count(b"!!") / n),
        min(2.0, data.count(b"|") / n), 1 - len(set(lines)) / (len(lines) or 1),
        min(2.0, sum(map(data.count, (b"%d" % i for i in range(10)))) / n)]


@dataclass
class Model:
    terms: dict[bytes, int]
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    metrics: dict = field(default_factory=dict)

    def logits(self, texts) -> np.ndarray:
        out, k = np.empty(len(texts)), len(DENSE)
        for i, t in enumerate(texts):
            data = bytes(t) if t is not None else b""
            x = (np.array(dense(data)) - self.mean) / self.scale
            hits = [self.terms[w] for w in terms(data) & self.terms.keys()]
            out[i] = self.weights[-1] + x @ self.weights[:k] + sum(self.weights[k + h] for h in hits)
        return out


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the intercept."""
    w, pen = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pen[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pen + 1e-9), x.T @ (y - p) - pen * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", good: str | None = None,
          max_rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents (those with the smallest
    md5 of their key; of a repeated key the one with the smallest text hash). ``good``: SQL over the labels' columns; by default of
    quality and not toxic. Rows whose label is null are not used. A tenth of
    the sample is held out for ``metrics``. Without two classes the model is
    neutral (every logit 0)."""
    spark = docs.sparkSession
    ship_package(spark)
    arrow_batches(spark)
    picked = labels.select(F.col(key).alias("__k"), F.expr(good or "quality = 1 AND toxic = 0").cast("int").alias("__y")) \
        .filter("__k IS NOT NULL AND __y IS NOT NULL").groupBy("__k").agg(F.min("__y").alias("__y"))
    picked = hash_sample(picked, F.col("__k"), max_rows)
    # bounded by max_rows, hence broadcast; one row per key, pre-aggregated, so that a repeated key does not break the bound
    first = F.min(F.struct(F.xxhash64("body").alias("h"), "body"))
    sample = materialize(docs.select(F.col(key).alias("__k"), F.col(text).cast("binary").alias("body"))
                         .join(F.broadcast(picked), "__k")
                         .groupBy("__k", "__y").agg(first.alias("__f"))
                         .select("__k", "__y", F.col("__f.body").alias("body"))
                         .withColumn("held", F.md5(F.concat(F.lit("h"), F.col("__k").cast("string"))) < "1a"),
                         "labelled")

    def count(batches):
        for b in batches:
            n = {0: Counter(), 1: Counter()}
            for body, y in zip(b["body"], b["y"]):
                if body is not None:
                    n[y].update(terms(bytes(body)))
            yield pd.DataFrame([(t, n[0][t], n[1][t]) for t in n[0].keys() | n[1].keys()], columns=["t", "bad", "good"])

    fit_rows = sample.filter("NOT held").select("body", F.col("__y").alias("y"))
    size = {r.y: r["count"] for r in fit_rows.groupBy("y").count().collect()}
    neutral = Model({}, np.zeros(len(DENSE) + 1), np.zeros(len(DENSE)), np.ones(len(DENSE)))
    if len(size) < 2:
        return neutral
    counts = fit_rows.mapInPandas(count, "t binary, bad long, good long").groupBy("t").agg(
        F.sum("bad").alias("b"), F.sum("good").alias("g"))
    n0, n1 = size[0], size[1]
    pool = (F.col("b") + F.col("g")) / (n0 + n1)
    z = (F.col("b") / n0 - F.col("g") / n1) / F.sqrt(pool * (1 - pool) * (1 / n0 + 1 / n1))
    best = counts.filter((F.col("b") + F.col("g") >= MIN_DOCS) & (pool < 1)).withColumn("z", z).filter(F.abs("z") >= MIN_Z) \
        .orderBy(F.desc(F.abs("z")), "t").limit(N_TERMS).collect()
    vocabulary = {bytes(r.t): i for i, r in enumerate(best)}

    def extract(batches):
        for b in batches:
            rows = []
            for body, y, held in zip(b["body"], b["y"], b["held"]):
                data = bytes(body) if body is not None else b""
                rows.append((dense(data), sorted(vocabulary[w] for w in terms(data) & vocabulary.keys()), y, held))
            yield pd.DataFrame(rows, columns=["x", "hits", "y", "held"])

    got = sample.select("body", F.col("__y").alias("y"), "held").mapInPandas(
        extract, "x array<double>, hits array<int>, y int, held boolean").collect()  # at most max_rows small rows
    got.sort(key=lambda r: (list(r.x), r.y))
    x = np.array([r.x for r in got])
    y, held = np.array([r.y for r in got], float), np.array([r.held for r in got])
    mean, scale = x[~held].mean(0), x[~held].std(0) + 1e-6
    full = np.zeros((len(got), len(DENSE) + len(vocabulary) + 1))
    full[:, :len(DENSE)] = (x - mean) / scale
    for i, r in enumerate(got):
        full[i, [len(DENSE) + h for h in r.hits]] = 1
    full[:, -1] = 1
    w = _fit(full[~held], y[~held])
    model = Model(vocabulary, w, mean, scale)
    if held.any():
        p = full[held] @ w > 0
        model.metrics = {"held_out": int(held.sum()), "accuracy": float((p == y[held]).mean()),
                         "good_kept": float(p[y[held] == 1].mean()) if (y[held] == 1).any() else None,
                         "bad_rejected": float((~p[y[held] == 0]).mean()) if (y[held] == 0).any() else None}
    return model


def evidence(model: Model, text: Column) -> Column:
    """Classifier log-odds of a text column (null: as empty)."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(model.logits(b))

    return run(text.cast("binary"))


def _rho(excess: float, groups: float, rows: float) -> float:
    """Intra-group correlation from scaled squared deviations (method of moments)."""
    return min(1 - 1e-6, max(1e-6, (excess - groups) / (rows - groups) if rows > groups else 1e-6))


def site_posteriors(scored: DataFrame, host: str = "host", path: str = "path", good: str = "good") -> DataFrame:
    """Shrunken rates per (host, path) of a scored table whose ``good`` is 0 to 1:
    ``n``, ``k``, ``host_rate``, ``path_rate``, ``path_strength``, ``global_rate``.

    Beta priors: hosts around the global rate, paths around their host's rate,
    with strength 1/rho - 1 where rho is the intra-group correlation estimated
    by moments. Rows are pre-aggregated per path, so a hot host costs no more
    than a row; a few sums reach the driver.
    """
    paths = materialize(scored.groupBy(host, path).agg(F.count("*").cast("double").alias("n"), F.sum(good).alias("k")), "paths")
    hosts = paths.groupBy(host).agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
    n, k = paths.agg(F.sum("n"), F.sum("k")).first()
    m = min(1 - 1e-6, max(1e-6, (k or 0) / n)) if n else 0.5
    a, h = hosts.agg(F.sum(F.col("hn") * (F.col("hk") / F.col("hn") - m) ** 2), F.count("*")).first()
    strength = 1 / _rho((a or 0) / (m * (1 - m)), h, n or 0) - 1
    hosts = hosts.withColumn("host_rate", (F.col("hk") + strength * m) / (F.col("hn") + strength))
    both = paths.join(hosts.select(F.col(host).alias("__h"), "host_rate"), F.col(host).eqNullSafe(F.col("__h"))).drop("__h")
    both = materialize(both, "sites")
    a2, p = both.agg(F.sum(F.col("n") * (F.col("k") / F.col("n") - F.col("host_rate")) ** 2
                           / F.greatest(F.lit(1e-9), F.col("host_rate") * (1 - F.col("host_rate")))), F.count("*")).first()
    strength2 = 1 / _rho(a2 or 0, p, n or 0) - 1
    return both.select(host, path, "n", "k", "host_rate",
                       ((F.col("k") + strength2 * F.col("host_rate")) / (F.col("n") + strength2)).alias("path_rate"),
                       F.lit(float(strength2)).alias("path_strength"), F.lit(float(m)).alias("global_rate"))


def classify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", host: Column | None = None,
             path: Column | None = None, keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """``keep`` columns (default: all) of every row plus a struct ``__quality`` of
    ``evidence`` (classifier log-odds), ``host_rate``, ``path_rate`` (without the
    row's own share), ``posterior`` and ``kept`` (posterior at least ``threshold``).

    Host and path default to ``source`` and ``lang``; for URLs pass
    ``url_host`` and ``url_path``. Null or missing host and path form groups of
    their own. Null, empty and blank texts are scored as empty texts. Repeated
    rows are rows. An empty table gives an empty result.
    """
    keep = keep if keep is not None else docs.columns
    ship_package(docs.sparkSession)
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("__row"), (host if host is not None else F.col("source")).alias("host"),
                       (path if path is not None else F.col("lang")).alias("path"),
                       evidence(model, F.col(text)).alias("evidence"))
    rows = materialize(rows.withColumn("good", 1 / (1 + F.exp(-F.col("evidence")))), "scored")
    sites = materialize(site_posteriors(rows), "site_posteriors").withColumnsRenamed({"host": "__h", "path": "__p"})
    j = rows.join(sites, F.col("host").eqNullSafe(F.col("__h")) & F.col("path").eqNullSafe(F.col("__p")))
    own = (F.col("k") - F.col("good") + F.col("path_strength") * F.col("host_rate")) / (
        F.col("n") - 1 + F.col("path_strength"))
    rate = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), own))
    odds = F.col("evidence") + F.log(rate / (1 - rate)) - F.log(F.col("global_rate") / (1 - F.col("global_rate")))
    j = j.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return j.select("__row.*", F.struct("evidence", "host_rate", rate.alias("path_rate"), "posterior",
                                        (F.col("posterior") >= threshold).alias("kept")).alias("__quality"))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def url_path(url: Column) -> Column:
    """First path level of a URL."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]*)", 1)
