"""URLs allowed or blocked by rules and, where no rule fits, by logistic regression on hashed
character n-grams of host and path, trained from a small table of labelled URLs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

#: Hash buckets, lengths of n-grams, labelled URLs at most (by a hash of the URL).
BUCKETS, LENGTHS, SAMPLE = 1 << 15, (2, 3, 4, 5), 4_000
STEPS, RATE, RIDGE = 200, 0.1, 1e-4
# The rules of the contract.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What lies between the first "://" and "/", "?", "#" or the end, A-Z in lower case, and what
    follows up to "?", "#" or the end; both empty for null and for URLs without "://"."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null: none) and its verdict. A rule fits its host and all
    subdomains where the path starts with the rule's; of equal lengths the first given wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(reversed(rules), key=lambda r: len(r[0])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def buckets(host: str, path: str, size: int = BUCKETS) -> np.ndarray:
    """Distinct hash buckets of the n-grams of host and of path, ends marked."""
    found = set()
    for part, text in ((0, f"^{host}$"), (1, f"^{path}$")):
        raw = text.encode("utf-8", "surrogatepass")
        for n in LENGTHS:
            found.update(xxhash.xxh3_64_intdigest(raw[k:k + n], part) % size for k in range(len(raw) - n + 1))
    return np.fromiter(sorted(found), np.int64, len(found))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    offset: float

    def block(self, host: str, path: str) -> float:
        """The probability that the URL is to be blocked."""
        at = buckets(host, path, len(self.weights))
        return float(1 / (1 + np.exp(-np.clip(self.weights[at].sum() / np.sqrt(max(len(at), 1)) + self.offset, -30, 30))))


def fit(rows: Sequence[tuple[str, str, bool]], size: int = BUCKETS, steps: int = STEPS) -> Model:
    """Logistic regression on (host, path, blocked); without rows nothing is blocked."""
    weights, offset = np.zeros(size), 0.0
    if not rows:
        return Model(weights, -30.0)
    y = np.array([r[2] for r in rows], float)
    at = [buckets(h, p, size) for h, p, _ in rows]
    lengths = np.array([len(a) for a in at])
    flat, row = np.concatenate(at), np.repeat(np.arange(len(rows)), lengths)
    value = 1 / np.sqrt(np.maximum(lengths, 1))[row]
    each = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))  # both verdicts weigh the same
    moment, square, m0, s0 = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[flat] * value, len(rows)) + offset, -30, 30)))
        error = (p - y) * each
        gradient = np.bincount(flat, error[row] * value, size) + RIDGE * weights
        moment, square = 0.9 * moment + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        m0, s0 = 0.9 * m0 + 0.1 * error.sum(), 0.999 * s0 + 0.001 * error.sum() ** 2
        fix, fix2 = 1 - 0.9**step, 1 - 0.999**step
        weights = weights - RATE * (moment / fix) / (np.sqrt(square / fix2) + 1e-8)
        offset -= RATE * (m0 / fix) / (np.sqrt(s0 / fix2) + 1e-8)
    return Model(weights, float(offset))


def train(labelled: DataFrame, url_col: str = "url", verdict_col: str = "verdict", most: int = SAMPLE) -> Model:
    """A model from a table of (url, verdict); of more than ``most`` distinct URLs, those with
    the smallest hashes. A URL with several verdicts counts once for each."""
    host, path = host_and_path(F.col(url_col))
    rows = (labelled.filter(F.col(url_col).isNotNull() & F.col(verdict_col).isin("allow", "block"))
            .select(host.alias("host"), path.alias("path"), (F.col(verdict_col) == "block").alias("blocked")).distinct()
            .orderBy(F.xxhash64("host", "path"), "host", "path", "blocked").limit(most).collect())
    return fit([(r["host"], r["path"], r["blocked"]) for r in rows])


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.block(h.as_py(), p.as_py()) for h, p in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=["host", "path", "row", "block_score"])

    return run


def judge(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score), one row per row of ``pages``.

    ``verdict`` is the rule's; without one, "block" if the model's probability exceeds
    ``threshold``. Null URLs and those without "://" have an empty host and path and are judged
    by the model. Repeated rows are judged each. Other columns are not read. An empty table
    gives an empty result.
    """
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    scored = (pages.select(host.alias("host"), path.alias("path"),
                           F.struct(F.col(f"`{id_col}`").cast("long").alias("page_id")).alias("row"))
              .mapInArrow(_scored(model), "host string, path string, row struct<page_id:bigint>, block_score double"))
    return scored.select(
        "row.page_id", "host", "path", rule.alias("rule"),
        F.coalesce(says, F.when(F.col("block_score") > threshold, "block").otherwise("allow")).alias("verdict"), "block_score")
