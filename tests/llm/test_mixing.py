import math
from collections import Counter

from helpers import documents
from oracle import compare, connect
from pyspark.sql import functions as F

from tenorline.llm.mixing import ORACLE, poisson_mix, repetition_rates
from tenorline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_against_sql(spark):
    name = "op10_poisson_mix"
    assert compare(spark, connect(SF), SF, name, QUERIES, {name: ORACLE}).startswith("ok")


def test_counts_are_poisson_and_sources_meet_their_weights(spark):
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "warm").otherwise(F.lit(None)).alias("source"))
    targets = {"hot": 3.0, "warm": 1.0, "absent": 9.0}
    rates = repetition_rates(docs, targets=targets)
    assert {r["source"]: round(r["rate"], 9) for r in rates.collect()} == {"hot": 2.25, "warm": 0.75, None: 0.0}
    mixed = poisson_mix(docs, rates)
    by_doc = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    for remainder, rate in ((0, 2.25), (1, 0.75)):
        times = Counter(by_doc.get(k, 0) for k in range(remainder, 60_000, 3))
        for k in range(6):
            p = math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(times[k] / 20_000 - p) < 5 * (p / 20_000) ** 0.5
    assert not any(k % 3 == 2 for k in by_doc)


def test_order_copies_and_repeats(spark):
    docs = documents(spark, [(k, f"t{k}") for k in range(300)] + [(7, "t7"), (None, "n"), (None, None)]
                     ).withColumnRenamed("row", "source").withColumn("copy", F.lit("mine"))
    mixed = poisson_mix(docs, repetition_rates(docs, epochs=3.0))
    assert mixed.columns == [c for c in docs.columns if c != "copy"] + ["copy", "shuffle_key"]
    rows = mixed.collect()
    assert [r["shuffle_key"] for r in rows] == sorted(r["shuffle_key"] for r in rows)
    copies = Counter((r["doc_id"], r["copy"]) for r in rows if r["doc_id"] is not None)
    assert all(n == (2 if i == 7 else 1) for (i, _), n in copies.items())
    assert all(r["text"] == f"t{r['doc_id']}" for r in rows if r["doc_id"] is not None)
    assert rows == poisson_mix(docs, repetition_rates(docs, epochs=3.0)).collect()
    order = [r["doc_id"] for r in rows if r["doc_id"] is not None]
    assert order != sorted(order)
    empty = docs.filter("false")
    assert poisson_mix(empty, repetition_rates(empty)).count() == 0
    assert poisson_mix(docs, repetition_rates(docs, targets={})).count() == 0
