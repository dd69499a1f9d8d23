import itertools
import random

import public_tokenizers
import pytest
from helpers import documents
from pyspark.sql import functions as F

from tenorline.llm.packing import best_boundaries, pack, token_counts
from tenorline.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.01"


def padding(lengths, counts, edges):
    return sum(n * (min(e for e in edges if e >= k) - k) for k, n in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_against_all_choices(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), 9))
    counts = [rng.randint(1, 40) for _ in lengths]
    for buckets in (1, 2, 3, 4, 12):
        edges = best_boundaries(lengths, counts, buckets)
        assert edges == sorted(set(edges)) and edges[-1] == lengths[-1] and len(edges) <= buckets
        best = min(padding(lengths, counts, (*c, lengths[-1]))
                   for c in itertools.combinations(lengths[:-1], min(buckets, len(lengths)) - 1))
        assert padding(lengths, counts, edges) == best
    assert best_boundaries([], [], 4) == []


def check(rows, budget):
    batches = {}
    for r in rows:
        if not r["n_tokens"]:
            assert r["bucket"] is r["batch"] is r["slot"] is r["bucket_tokens"] is None
            continue
        assert r["n_tokens"] <= r["bucket_tokens"]
        batches.setdefault((r["bucket"], r["bucket_tokens"]), {}).setdefault(r["batch"], []).append(r["slot"])
    tops = sorted(batches)
    assert [b for b, _ in tops] == list(range(len(tops))) and [t for _, t in tops] == sorted({t for _, t in tops})
    for (_, top), found in batches.items():
        fit = max(1, budget // top)
        assert sorted(found) == list(range(len(found)))
        for batch, slots in found.items():
            assert sorted(slots) == list(range(len(slots)))
            assert len(slots) == fit or batch == len(found) - 1 and len(slots) <= fit


def test_query(spark):
    rows = QUERIES["op4_length_buckets"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    check(rows, 65_536)
    import tiktoken
    from base64 import b64decode
    ranks = {b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(encoding.encode_ordinary(t or "")) for i, t in texts.items()}


def test_few_bins_many_shards_and_odd_rows(spark):
    rng = random.Random(1)
    lengths = [rng.choice([0, 1, 7, 7, 7, 30, 31, 500, 9_999]) for _ in range(400)]
    sized = spark.createDataFrame([(k % 50, n, k, "x") for k, n in enumerate(lengths)],
                                  "doc_id long, n_tokens long, batch int, bucket string")
    packed = pack(sized, buckets=3, batch_tokens=100, shard=9)
    assert packed.columns == ["doc_id", "n_tokens", "bucket", "bucket_tokens", "batch", "slot"]
    rows = packed.collect()
    assert len(rows) == 400 and max(r["bucket_tokens"] or 0 for r in rows) == 9_999
    check(rows, 100)


def test_null_empty_and_long_texts(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "word " * 50_000), (4, "a"), (4, "a"), (None, "b c")])
    counts = token_counts(docs, vocabulary())
    check(pack(counts).collect(), 65_536)
    assert {r["doc_id"]: r["n_tokens"] for r in counts.collect()} == {1: 0, 2: 0, 3: 50_001, 4: 1, None: 2}
    assert pack(token_counts(documents(spark, []), vocabulary())).count() == 0
    assert pack(counts.filter("n_tokens = 0")).filter(F.col("bucket").isNotNull()).count() == 0


def least_padding(lengths, counts, buckets):
    """By the plain recurrence over all splits."""
    below = [0]
    for n in counts:
        below.append(below[-1] + n)
    cost = [k * n for k, n in zip(lengths, below[1:])]
    for _ in range(buckets - 1):
        cost = [min([cost[j]] + [cost[k] + e * (below[j + 1] - below[k + 1]) for k in range(j)]) for j, e in enumerate(lengths)]
    return cost[-1] - sum(k * n for k, n in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(4))
def test_boundaries_of_many_lengths(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 3_000), 200)) + [rng.randrange(10**6, 10**7)]
    counts = [rng.choice([1, 1, 2, 50, 10**6]) for _ in lengths]
    for buckets in (2, 5, 16):
        edges = best_boundaries(lengths, counts, buckets)
        assert edges[-1] == lengths[-1] and len(edges) <= buckets
        assert padding(lengths, counts, edges) == least_padding(lengths, counts, buckets)


def test_one_very_long_row_leaves_the_other_boundaries_exact(spark):
    rng = random.Random(4)
    lengths = [rng.randrange(1, 490) for _ in range(3_000)] + [2_000_000]
    rows = pack(spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long")).collect()
    check(rows, 65_536)
    distinct = sorted(set(lengths))
    counts = [lengths.count(k) for k in distinct]
    assert sum(r["bucket_tokens"] - r["n_tokens"] for r in rows) == least_padding(distinct, counts, 16)
