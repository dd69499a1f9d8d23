"""Document quality by hierarchical empirical Bayes.

A document's own evidence is the log-likelihood ratio of a logistic classifier over byte and
structure statistics of its whole text. Hosts and paths (any two columns) add what their
other documents say: a host's share of good documents is shrunk toward the global share, a
path's toward its host's, each by a pseudo-count that the spread between hosts (or paths)
estimates by the method of moments, so sparse sites follow their prior and large ones
themselves. The posterior log-odds are the path's prior log-odds plus the evidence.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenorline.llm.shared import broadcast_if_small, gathered, written

#: Labelled documents that the classifier is fitted on, chosen by a hash of the id.
SAMPLE, RIDGE, STEPS = 4_000, 1.0, 25
THRESHOLD = 0.5
#: Bounds of a pseudo-count, and of one document's evidence.
STRENGTH, EVIDENCE = (1.0, 10_000.0), 12.0
#: Sites are broadcast up to this many.
MOST_BROADCAST = 500_000

_KIND = np.full(256, 7, np.int64)  # bytes beyond ASCII
for _k, _codes in enumerate((range(97, 123), range(65, 91), range(48, 58), (32,), (10,), (46, 44, 59, 58))):
    _KIND[list(_codes)] = _k
_KIND[[c for c in range(128) if _KIND[c] == 7]] = 6
FEATURES = 256 + 64 + 6


def features(text: str | None) -> np.ndarray:
    """Square roots of the shares of bytes and of pairs of byte kinds, and six measures of
    structure: lengths of text, words and lines, distinct words and lines, first word's share."""
    out = np.zeros(FEATURES, np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    codes = np.frombuffer(raw, np.uint8)
    kinds = _KIND[codes]
    out[:256] = np.sqrt(np.bincount(codes, minlength=256) / len(codes))
    out[256:320] = np.sqrt(np.bincount(kinds[:-1] * 8 + kinds[1:], minlength=64) / len(codes))
    words, lines = raw.split(), raw.splitlines()
    seen = Counter(words)
    out[320:] = (math.log1p(len(raw)), len(raw) / (len(words) + 1) / 8, math.log1p(len(raw) / max(len(lines), 1)),
                 len(seen) / max(len(words), 1), len(set(lines)) / max(len(lines), 1),
                 max(seen.values(), default=0) / max(len(words), 1))
    return out


@dataclass(frozen=True)
class Classifier:
    """Linear evidence over standardised features; ``prior`` is the share of good samples."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float
    prior: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-likelihood ratios good over poor, one per row."""
        return np.clip((x - self.mean) / self.scale @ self.weights + self.offset, -EVIDENCE, EVIDENCE)


def fit(x: np.ndarray, good: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> Classifier:
    """Ridge logistic regression by Newton steps; without both classes evidence is 0 throughout."""
    prior = (good.sum() + 1) / (len(good) + 2)
    if not 0 < good.sum() < len(good):
        return Classifier(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, float(prior))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.concatenate(((x - mean) / scale, np.ones((len(x), 1))), axis=1).astype(np.float64)
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - good) + penalty * w
        move = np.linalg.solve((z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(penalty), gradient)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return Classifier(mean, scale, w[:-1], float(w[-1] - math.log(prior / (1 - prior))), float(prior))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([features(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())],
            names=["good", "features"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", most: int = SAMPLE) -> Classifier:
    """A classifier from at most ``most`` labelled documents (label 1: good, 0: poor, else unused)."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_good")).filter("_id is not null and _good in (0, 1)")
    drawn = gathered(known.groupBy("_id").agg(F.min("_good").cast("int").alias("_good"))
                    .orderBy(F.xxhash64("_id"), "_id").limit(most), "labelled", most)
    rows = (docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .join(F.broadcast(drawn), "_id").dropDuplicates(["_id"]).select("_good", "text")
            .mapInArrow(_labelled, "good int, features binary").collect())
    x = np.array([np.frombuffer(r["features"], np.float32) for r in rows]).reshape(len(rows), FEATURES)
    order = np.lexsort(x.T[:8]) if len(rows) else []
    return fit(x[order], np.array([r["good"] for r in rows], np.float64)[order] if len(rows) else np.zeros(0))


def _judged(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(0)]).reshape(batch.num_rows, FEATURES)
            yield pa.RecordBatch.from_arrays([pa.array(model.evidence(x), pa.float64()), batch.column(1)],
                                             names=["evidence", "row"])

    return run


def _strength(sites: DataFrame, of: Column) -> Column:
    """Pseudo-count by the method of moments: m (1 - m) / variance between sites - 1, where the
    variance is what the sites' shares spread about ``of`` beyond chance."""
    share, chance = F.col("good") / F.col("n"), of * (1 - of) / F.col("n")
    between = F.sum(F.col("n") * ((share - of) * (share - of) - chance)) / F.sum("n")
    spread = F.sum(F.col("n") * of * (1 - of)) / F.sum("n")
    low, high = STRENGTH
    return F.when(between > 0, F.greatest(F.lit(low), F.least(F.lit(high), spread / between - 1))).otherwise(high)


@dataclass(frozen=True)
class Shrinkage:
    """The share of good documents overall, and pseudo-counts of a host and of a path."""

    overall: float
    host: float
    path: float

    def prior(self, own: Column | float = 0.0, one: int = 0) -> Column:
        """The shrunken share of good documents of a path, from the counts of ``site_counts``; with
        ``own`` and ``one`` without the document whose probability that is."""
        host = (F.col("good_host") - own + self.host * self.overall) / (F.col("n_host") - one + self.host)
        return (F.col("good_path") - own + self.path * host) / (F.col("n_path") - one + self.path)


def site_counts(judged: DataFrame) -> tuple[DataFrame, Shrinkage]:
    """(host, path, n_host, good_host, n_path, good_path) from rows of (host, path, p), a written
    table, and how far they shrink. Null is a site of its own."""
    rows = judged.count()
    paths = gathered(judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("good")), "paths", rows)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    overall = hosts.agg((F.sum("good") / F.sum("n")).alias("share")).first()["share"]
    overall = min(max(overall if overall is not None else 0.5, 1e-4), 1 - 1e-4)
    hosts = gathered(hosts, "hosts", rows)
    k_host = hosts.agg(_strength(hosts, F.lit(overall)).alias("k")).first()["k"] or STRENGTH[1]
    named = hosts.select(F.col("host").alias("_host"), F.col("n").alias("n_host"), F.col("good").alias("good_host"),
                         ((F.col("good") + k_host * overall) / (F.col("n") + k_host)).alias("share"))
    both = gathered(paths.join(named, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "shrunk", rows)
    k_path = both.agg(_strength(both, F.col("share")).alias("k")).first()["k"] or STRENGTH[1]
    return both.select("host", "path", "n_host", "good_host", F.col("n").alias("n_path"), F.col("good").alias("good_path")
                       ), Shrinkage(overall, k_host, k_path)


def site_posteriors(judged: DataFrame) -> DataFrame:
    """(host, path, n_host, n_path, prior): the shrunken share of good documents of each path."""
    sites, shrinkage = site_counts(judged)
    return sites.select("host", "path", "n_host", "n_path", shrinkage.prior().alias("prior"))


def judge(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, host, path, n_host, n_path, evidence, prior, score, kept), one row per row.

    ``score`` is the posterior probability that the document is good: its evidence on the prior that
    the other documents of its path and host give. ``kept`` tells whether it
    reaches ``threshold``. Null and empty texts have evidence like any other. Null hosts and
    paths are sites of their own. Repeated rows count each. Other columns are not read. An
    empty table gives an empty result.
    """
    row = F.struct(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{host_col}`").cast("string").alias("host"),
                   F.col(f"`{path_col}`").cast("string").alias("path"))
    given = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), row.alias("row"))
    start = math.log(model.prior / (1 - model.prior))
    judged = written(
        given.mapInArrow(_judged(model), "evidence double, row struct<doc_id:bigint,host:string,path:string>")
        .select("row.*", "evidence").withColumn("p", 1 / (1 + F.exp(-(F.col("evidence") + start)))), "evidence")
    sites, shrinkage = site_counts(judged)
    sites = broadcast_if_small(written(sites.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "n_host", "good_host", "n_path", "good_path"), "sites"), MOST_BROADCAST)
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.ln(F.col("prior") / (1 - F.col("prior"))))))
    return (judged.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
            .withColumn("prior", F.greatest(F.lit(1e-9), shrinkage.prior(F.col("p"), 1)))
            .select("doc_id", "host", "path", "n_host", "n_path", "evidence", "prior", score.alias("score"))
            .withColumn("kept", F.col("score") >= threshold))
