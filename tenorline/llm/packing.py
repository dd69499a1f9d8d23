"""Packing by optimal length buckets.

Every document is padded to the upper boundary of its length bucket. Dynamic programming
over the count of every length chooses the boundaries with the least padding, and
batches of a fixed token budget form inside each bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import base64
import uuid

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tenorline.llm.shared import in_tasks, written

BUCKETS, BATCH_TOKENS = 16, 65_536
#: Documents of one numbering shard.
SHARD = 50_000
# Fixed value: how the public byte-level vocabulary splits text before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def _encoding(key: str, vocabulary) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.value.splitlines())}
    return tiktoken.Encoding(key, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def _count(key: str, vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(_encoding(key, vocabulary).encode_ordinary(x)) if (x := text.as_py()) else 0
                      for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())],
                                             names=["doc_id", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of whole texts under a tiktoken vocabulary file (about 1 MB, read here
    and sent to the executors). Null and empty texts have 0 tokens."""
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string"))
            .mapInArrow(_count(uuid.uuid4().hex, sent), "doc_id long, n_tokens long"))


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Ascending upper boundaries, at most ``buckets`` of them and all out of ``lengths``
    (ascending, each with a count of at least 1), for which the sum over documents of
    boundary - length is least. Exact, in time proportional to buckets times lengths."""
    n = len(lengths)
    if n <= buckets:
        return list(lengths)
    below = [0, *accumulate(counts)]
    cost = [edge * docs for edge, docs in zip(lengths, below[1:])]  # padded tokens of the first lengths in one bucket
    choice = np.zeros((buckets, n), np.int32)
    for b in range(1, buckets):
        # With the last split after k lengths the cost at an edge is a line in the edge. Slopes fall
        # with k and edges rise, so the lines that are least somewhere are passed in order.
        now, at, slopes, starts, splits = cost[:1], 0, [], [], []
        for j in range(1, n):
            slope, start = -below[j], cost[j - 1]
            while len(slopes) - at > 1 and ((start - starts[-2]) * (slopes[-2] - slopes[-1])
                                            <= (starts[-1] - starts[-2]) * (slopes[-2] - slope)):
                slopes.pop(), starts.pop(), splits.pop()
            slopes.append(slope), starts.append(start), splits.append(j)
            edge = lengths[j]
            while at + 1 < len(slopes) and starts[at + 1] + slopes[at + 1] * edge < starts[at] + slopes[at] * edge:
                at += 1
            split = starts[at] + slopes[at] * edge + edge * below[j + 1]
            now.append(min(split, cost[j]))
            if split < cost[j]:
                choice[b, j] = splits[at]
        cost = now
    out, j = [], n
    for b in range(buckets - 1, -1, -1):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(choice[b, j - 1])
    return out[::-1]


def pack(sized: DataFrame, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS,
         shard: int = SHARD) -> DataFrame:
    """``sized`` (with n_tokens) plus bucket, bucket_tokens, batch and slot.

    ``bucket_tokens`` is the length all of a bucket is padded to; a batch of a bucket holds
    as many documents as fit into ``batch_tokens`` at that length, at least one, and only
    the last batch of a bucket may hold fewer. The boundaries are exactly optimal over the
    distinct lengths, which the driver holds, one number and count each. Documents without tokens (null or
    empty texts) are in no batch: the four columns are null. Repeated rows are packed each.
    An empty table gives an empty result.

    Numbers inside a bucket need no gathering: rows are numbered within shards of about
    ``shard`` rows and shifted by the sizes of the shards before.
    """
    kept = [c for c in sized.columns if c not in ("bucket", "bucket_tokens", "batch", "slot")]
    sized = written(sized.select(*[F.col(f"`{c}`") for c in kept], F.col("n_tokens").alias("_length"),
                                 F.monotonically_increasing_id().alias("_row")), "lengths")
    rows = sized.count()
    sizes = sized.filter("_length > 0").groupBy("_length").count().toArrow().sort_by("_length")
    edges = best_boundaries(sizes["_length"].to_pylist(), sizes["count"].to_pylist(), buckets) or [0]

    tops = F.lit(edges)
    placed = (sized.withColumn("bucket", F.when(F.col("_length") > 0, F.size(F.filter(tops, lambda t: t < F.col("_length")))))
              .withColumn("bucket_tokens", F.get(tops, "bucket").cast("long"))
              .withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(-(-max(rows, 1) // shard)))))
    offsets = (placed.groupBy("bucket", "_shard").count()
               .select(F.col("bucket").alias("_bucket"), F.col("_shard").alias("_of"),
                       (F.sum("count").over(Window.partitionBy("bucket").orderBy("_shard")) - F.col("count")).alias("_before")))
    numbered = (placed.withColumn("_place", F.row_number().over(Window.partitionBy("bucket", "_shard").orderBy("_row")))
                .join(offsets, F.col("bucket").eqNullSafe(F.col("_bucket")) & (F.col("_shard") == F.col("_of")))
                .withColumn("_at", F.col("_before") + F.col("_place") - 1)
                .withColumn("_fit", F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bucket_tokens")))))
    return in_tasks(numbered, rows).select(
        *[F.col(f"`{c}`") for c in kept], F.col("bucket").cast("int").alias("bucket"), "bucket_tokens",
        F.when(F.col("bucket").isNotNull(), F.floor(F.col("_at") / F.col("_fit"))).alias("batch"),
        F.when(F.col("bucket").isNotNull(), F.col("_at") % F.col("_fit")).alias("slot"))
