import hashlib
import random

from helpers import documents, jaccard, shingles
from pyspark.sql import functions as F

from tenorline.llm.fingerprints import K, fingerprints, merged, with_next, with_sketch
from tenorline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def edits(rows):
    """doc_id -> (text, edited text, next text), next by ascending doc_id."""
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        out[i] = (t, t[:len(t) - half] + following[:half], following)
    return out


def check(got, rows):
    want, seen = edits(rows), {}
    assert len(got) == len(rows)
    for r in got:
        text, edited, following = want[r["doc_id"]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert len(r["fingerprint"]) == 16 * min(K, len(shingles(text.lower())))
        for name, other in (("near_edited", edited), ("near_next", following)):
            true = jaccard(shingles(text.lower()), shingles(other.lower()))
            exact = len(shingles(text.lower()) | shingles(other.lower())) <= K
            assert abs(r[name] - true) < (1e-9 if exact else 0.22), (r["doc_id"], name)
    return seen


def test_query_against_plain_python(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(QUERIES["op2_fingerprints"](spark, SF).collect(), rows)


def test_edges(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(20_000))
    rows = [(3, ""), (10, "é"), (11, "ab cd"), (12, long), (40, long), (41, "\U0001f600 x y"), (50, " \n ")]
    check(fingerprints(documents(spark, rows)).collect(), rows)
    one = fingerprints(documents(spark, [(7, None)])).collect()
    assert [(r["n_chars"], r["fingerprint"], r["near_edited"], r["near_next"]) for r in one] == [(0, "", 1.0, 1.0)]
    assert fingerprints(documents(spark, [])).count() == 0


def test_null_and_repeated_ids(spark):
    got = fingerprints(documents(spark, [(None, "a b"), (None, "c d"), (1, "e f"), (1, "e f"), (2, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in got) == [(-1, 3), (-1, 3), (1, 3), (1, 3), (2, 0)]


def test_next_across_many_ranges(spark):
    ids = random.Random(4).sample(range(10**12), 900)
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = with_next(docs, lambda d: d, rows_per_range=20).collect()
    order = sorted(ids)
    follows = dict(zip(order, order[1:] + order[:1]))
    assert {r["doc_id"]: r["next"]["text"] for r in got} == {i: f"t{follows[i]}" for i in ids}


def test_sketches_merge_to_the_sketch_of_the_whole(spark):
    rng = random.Random(6)
    w = [f"w{rng.randrange(10**6)}" for _ in range(1200)]
    parts = [" ".join(w[k:k + 304]) for k in range(0, 1200, 300)]  # overlap by four words
    docs = with_sketch(spark.createDataFrame([("p", p) for p in parts], "part string, text string"))
    whole = with_sketch(spark.createDataFrame([(" ".join(w),)], "text string")).first()["sketch"]
    assert merged(docs, ["part"]).first()["sketch"] == whole


def test_counts_and_containment(spark):
    rng = random.Random(8)
    w = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    docs = with_sketch(spark.createDataFrame([(" ".join(w), " ".join(w[:1000]))], "text string, part string"))
    docs = with_sketch(docs, "part", "part_sketch")
    from tenorline.llm.fingerprints import containment, distinct_count
    r = docs.select(distinct_count(F.col("sketch")).alias("n"),
                    containment(F.col("part_sketch"), F.col("sketch")).alias("in"),
                    containment(F.col("sketch"), F.col("part_sketch")).alias("out")).first()
    assert abs(r["n"] - 3996) < 0.35 * 3996 and r["in"] > 0.6 and abs(r["out"] - 0.25) < 0.15
