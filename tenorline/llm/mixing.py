"""Mixing sources to target weights by Poisson replication.

Each source gets a repetition rate, and each document a count drawn from the Poisson
distribution with that mean: a hash of seed and document is the uniform number that
inverts the distribution, so a rerun or a lost task draws the same. Documents are exploded
by their count and shuffled globally by another hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.llm.shared import broadcast_if_small, gathered

TEMPERATURE, SEED = 0.5, 7
#: Sources are broadcast up to this many (about 400 bytes each).
MOST_BROADCAST = 100_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the md5 of ``parts``, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / float(2**52)


def least_count(rate: Column) -> Column:
    """Counts below this have a probability under 1e-16 in all: 12 deviations and more below the mean."""
    return F.greatest(F.lit(0), F.floor(rate - 12 * F.sqrt(rate) - 24)).cast("int")


def poisson_steps(rate: Column) -> Column:
    """Cumulative Poisson probabilities from ``least_count`` on until the rest is below 1e-16;
    their number grows with the root of the rate."""
    first, last = least_count(rate), F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    log_first = F.aggregate(F.sequence(F.lit(0), first), F.lit(0.0), lambda s, k: s + F.when(k > 1, F.ln((k - 1).cast("double"))).otherwise(0.0))
    start = F.struct(log_first.alias("log_k"), F.lit(0.0).alias("sum"),
                     F.expr("cast(array() as array<double>)").alias("steps"))

    def step(s: Column, k: Column) -> Column:
        log_k = s["log_k"] + F.when(k > 0, F.ln(k.cast("double"))).otherwise(0.0)
        total = s["sum"] + F.exp(k * F.ln(rate) - rate - log_k)
        return F.struct(log_k.alias("log_k"), total.alias("sum"), F.concat(s["steps"], F.array(total)).alias("steps"))

    return F.aggregate(F.sequence(first, last), start, step, lambda s: s["steps"])


def repetition_rates(docs: DataFrame, source_col: str = "source", targets: Mapping[str, float] | None = None,
                     temperature: float = TEMPERATURE, epochs: float = 1.0) -> DataFrame:
    """(source, n, rate): the mean number of copies of a document of each source.

    ``targets`` gives weights by source (a source not named gets none); without it a source
    of n documents weighs n ** temperature. All rates together yield ``epochs`` times the
    number of documents. Null is a source of its own.
    """
    counts = gathered(docs.groupBy(F.col(f"`{source_col}`").cast("string").alias("source"))
                     .agg(F.count(F.lit(1)).alias("n")), "sources", docs.count())
    if targets is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, w in targets.items():
            weight = F.when(F.col("source") == name, float(w)).otherwise(weight)
    weighted = counts.withColumn("weight", weight)
    total = weighted.agg(F.sum("n").alias("n"), F.sum("weight").alias("w")).first()
    if not total["w"]:
        return weighted.select("source", "n", F.lit(0.0).alias("rate"))
    return weighted.select("source", "n", (F.col("weight") / total["w"] * float(epochs * total["n"]) / F.col("n"))
                           .alias("rate"))


def poisson_mix(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The columns of ``docs`` plus ``copy`` (1, 2, ...) and ``shuffle_key``, in shuffled order: rows
    go to partitions by a hash of the key, which is itself one, and lie in its order there.

    A document whose count is 0 goes. Rows that repeat a doc_id draw the same count; a row
    without one draws by its text (null text: as empty). A source that ``rates`` lacks has
    rate 0. Columns of ``docs`` named like the two new ones are replaced. Empty tables give
    empty results.
    """
    kept = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"),
                      F.concat(F.lit("text "), F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), name.alias("name"),
                       F.col(f"`{source_col}`").cast("string").alias("source"))
    steps = broadcast_if_small(gathered(
        rates.filter("rate > 0").select(F.col("source").alias("of"), least_count(F.col("rate")).alias("least"),
                                        poisson_steps(F.col("rate")).alias("steps")), "poisson", rates.count()), MOST_BROADCAST)
    counted = (rows.join(steps, F.col("source").eqNullSafe(F.col("of")))
               .withColumn("u", uniform(F.lit(str(seed)), F.col("name")))
               .withColumn("count", F.col("least") + F.size(F.filter("steps", lambda p: p <= F.col("u")))))
    return (counted.filter("count > 0").select("row", "name", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
            .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("shuffle"), "name", "copy")))
            .select("row.*", F.col("copy").cast("long").alias("copy"), "shuffle_key")
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key"))


ORACLE = f"""
with sources as (
    select source, count(*) as n, sqrt(count(*)) as weight from documents group by source
), rates as (
    select source, n, weight / (select sum(weight) from sources) * (select sum(n) from sources) / n as rate from sources
), logs as (
    select k, sum(case when k > 0 then ln(k) else 0.0e0 end) over (order by k) as log_k
    from (select unnest(range(0, 400)) as k) r
), steps as (
    select source, k, sum(exp(k * ln(rate) - rate - log_k)) over (partition by source order by k) as p
    from rates, logs where k <= ceil(rate + 12 * sqrt(rate) + 24)
), drawn as (
    select *, cast(('0x' || substr(md5('{SEED}:' || doc_id), 1, 13)) as bigint) / 4503599627370496.0e0 as u
    from documents
), counted as (
    select d.doc_id, count(s.p) as copies
    from drawn d join steps s on s.source = d.source and s.p <= d.u group by d.doc_id
)
select d.doc_id, d.text, d.lang, d.source, d.n_chars, x.copy,
       md5('{SEED}:shuffle:' || d.doc_id || ':' || x.copy) as shuffle_key
from documents d join counted c on c.doc_id = d.doc_id
join (select unnest(range(1, 400)) as copy) x on x.copy <= c.copies
"""
