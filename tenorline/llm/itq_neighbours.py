"""Near-duplicate embeddings by iterative quantisation.

ITQ learns rotations of the leading principal components for which the signs of the rotated
vectors are balanced binary codes close to the vectors. The code is cut into equal
substrings, each the key of a Hamming table; vectors that share a substring in some table
meet there, and their cosine is computed from the original vectors in double precision.

A substring of b bits is shared by a pair with some probability q, so ``tables`` substrings
miss it with probability (1 - q)^tables. b grows with the logarithm of the number of vectors,
so that a bucket keeps about ``BUCKET`` of them. q is not taken from a formula, as it depends
on how the vectors lie about their centre: pairs of exactly the least cosine are made from
sampled vectors, their codes are compared, and tables are added until such pairs are missed
with the given probability. Where one code is too short, further rotations extend it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tenorline.llm.components import connected_components
from tenorline.llm.shared import gathered, written
from tenorline.llm.sorted_groups import sorted_groups

COSINE = 0.98
#: Vectors that rotations are learned from, chosen by a hash of the vector.
SAMPLE, ROUNDS = 8_000, 40
#: Least vectors per bucket that a longer substring would split, and the chance to miss a link.
BUCKET, MISS = 1024, 1e-4
#: Tables at most; what that many still miss is named in the README.
MOST_TABLES = 400
#: Vectors of one block where a bucket is compared.
BLOCK = 512


@dataclass(frozen=True)
class Codes:
    """Centre, and one matrix per rotation; a vector's bits are the signs of their products."""

    centre: np.ndarray
    matrices: tuple[np.ndarray, ...]
    bits: int
    tables: int

    def substrings(self, x: np.ndarray) -> np.ndarray:
        """One row per vector, one substring (as a number) per table."""
        signs = np.concatenate([(x - self.centre) @ m > 0 for m in self.matrices], axis=1)
        used = signs[:, :self.bits * self.tables].reshape(len(x), self.tables, self.bits)
        return used @ (1 << np.arange(self.bits, dtype=np.int64))


def plan(vectors: int, cosine: float = COSINE, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """(bits of a substring, tables) for so many vectors that lie evenly about the origin, where a bit
    differs with probability arccos(cosine) / pi."""
    bits = max(6, math.ceil(math.log2(max(vectors, 1) / bucket)) if vectors > bucket else 6)
    shared = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - shared))


def missed(codes: Codes, sample: np.ndarray, cosine: float, seed: int = 4) -> np.ndarray:
    """For each sampled unit vector and a random partner of exactly that cosine the share of tables
    in which both meet, as the chance to miss them in all tables."""
    other = np.random.default_rng(seed).standard_normal(sample.shape)
    other -= (other * sample).sum(axis=1)[:, None] * sample
    other /= np.maximum(np.linalg.norm(other, axis=1), 1e-300)[:, None]
    partner = cosine * sample + math.sqrt(1 - cosine * cosine) * other
    shared = (codes.substrings(sample) == codes.substrings(partner)).mean(axis=1)
    # A pair that met in few tables by chance is no better known than one over all of them.
    return (1 - np.maximum(shared, 0.5 / codes.tables)) ** codes.tables


def learn_for(sample: np.ndarray, vectors: int, cosine: float = COSINE, bucket: int = BUCKET, miss: float = MISS) -> Codes:
    """``learn`` with the tables that ``plan`` gives, and as many more as pairs of the least cosine
    made from ``sample`` need to be missed with probability ``miss`` on average."""
    bits, tables = plan(vectors, cosine, bucket, miss)
    while True:
        codes = learn(sample, bits, tables)
        if len(sample) < 2 or sample.shape[1] < 2 or missed(codes, sample, cosine).mean() <= miss or tables >= MOST_TABLES:
            return codes
        tables = min(MOST_TABLES, math.ceil(1.4 * tables))


def learn(sample: np.ndarray, bits: int, tables: int, rounds: int = ROUNDS, seed: int = 3) -> Codes:
    """Rotations for ``bits * tables`` bits, learned from the sample's unit vectors.

    Principal components beyond the sample's rank are kept as they are; with fewer than two
    vectors the rotations stay random.
    """
    rng, dims = np.random.default_rng(seed), sample.shape[1]
    centre = sample.mean(axis=0) if len(sample) else np.zeros(dims)
    x = sample - centre
    components = np.linalg.eigh(x.T @ x)[1][:, ::-1] if len(sample) > 1 else np.eye(dims)
    v = x @ components
    matrices = []
    for _ in range(-(-bits * tables // dims)):
        rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        for _ in range(rounds if len(sample) > 1 else 0):
            signs = np.where(v @ rotation > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(v.T @ signs)
            rotation = left @ right
        matrices.append(components @ rotation)
    return Codes(centre, tuple(matrices), bits, tables)


def _unit(raw: list[bytes], dtype: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _normal(dtype: str):
    """Vectors as the bytes of their components; null for those that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(2):
                v = value.as_py()
                x = np.array(v, dtype) if v and None not in v else np.zeros(0, dtype)
                # Adding zero makes -0.0 and 0.0 the same bytes.
                out.append((x + 0).astype(dtype).tobytes() if x.any() and np.isfinite(x).all() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["vec_id", "label", "vector"])

    return run


def _coded(codes: dict[int, Codes], dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).to_pylist()
            dims = np.array([len(r) for r in raw]) // np.dtype(dtype).itemsize
            found: list = [None] * len(raw)
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                if int(d) in codes:
                    for row, keys in zip(rows, codes[int(d)].substrings(_unit([raw[r] for r in rows], dtype)).tolist()):
                        found[row] = keys
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), batch.column(1)],
                                             names=["keys", "row"])

    return run


def _meet(cosine: float, dtype: str):
    """Per block: links of each vector, weighted by copies, and a spanning forest of the links.

    A pair that shares the substrings of several tables counts in the first of them only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["label", "dims", "at", "value", "i", "j"]):
            group = group.combine_chunks()
            node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
            block, x = group.column("block").to_numpy(), _unit(group.column("vector").to_pylist(), dtype)
            keys = np.array(group.column("keys").to_pylist())
            i, j, at = (group.column(c)[0].as_py() for c in ("i", "j", "at"))
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            near = x[left] @ x[right].T >= cosine
            if i == j:
                near = np.triu(near, 1)
            for t in range(at):
                near &= keys[left, t][:, None] != keys[right, t][None, :]
            a, b = np.nonzero(near)
            if not len(a):
                continue
            a, b = left[a], right[b]
            links = np.bincount(a, copies[b], len(x)) + np.bincount(b, copies[a], len(x))
            tied = np.arange(len(x))
            while True:
                low = np.minimum(tied[a], tied[b])
                now = tied.copy()
                np.minimum.at(now, a, low)
                np.minimum.at(now, b, low)
                now = now[now]
                if (now == tied).all():
                    break
                tied = now
            rows = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[rows]), pa.array(node[tied[rows]]), pa.array(links[rows].astype(np.int64))],
                names=["node", "tied", "links"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str | None = "label", sample: int = SAMPLE, bucket: int = BUCKET,
                 miss: float = MISS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors of one label (all, if ``label_col`` is None) and one number of dimensions are
    linked if their cosine is at least ``cosine``. Equal vectors of a label are one node with
    a number of copies; every vector is indexed. ``sample`` bounds the vectors that rotations
    are learned from, per number of dimensions.

    A vector that is null, empty, zero, holds null or non-finite components, or has a null
    label or id, is linked with nothing. Rows that repeat a vec_id count as vectors of their
    own. Other columns are not read. An empty table gives an empty result.
    """
    label = F.lit("") if label_col is None else F.col(f"`{label_col}`").cast("string")
    kind = vectors.schema[vector_col].dataType.simpleString()
    dtype = "<f4" if kind == "array<float>" else "<f8"
    rows = written(
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"),
                       F.col(f"`{vector_col}`").cast("array<float>" if dtype == "<f4" else "array<double>").alias("vector"))
        .mapInArrow(_normal(dtype), "vec_id long, label string, vector binary"), "vectors")
    nodes = gathered(rows.filter("vector is not null and label is not null and vec_id is not null")
                    .groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("dims", (F.octet_length("vector") / np.dtype(dtype).itemsize).cast("int"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes", rows.count())
    size = nodes.count()

    codes = {}
    for r in nodes.groupBy("dims").count().collect():
        drawn = (nodes.filter(F.col("dims") == r["dims"]).select("vector", F.xxhash64("vector").alias("h"))
                 .filter(F.pmod("h", F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / r["count"])))
                 .orderBy("h", "vector").limit(sample).collect())
        x = _unit([bytes(d["vector"]) for d in drawn], dtype) if drawn else np.zeros((0, r["dims"]))
        codes[r["dims"]] = learn_for(x, r["count"], cosine, bucket, miss)

    given = nodes.select("vector", F.struct("label", "dims", "node", "copies", "vector").alias("row"))
    coded = written(given.mapInArrow(
        _coded(codes, dtype), f"keys array<long>, row {given.schema['row'].dataType.simpleString()}")
        .select("row.*", "keys"), "codes")
    table = ["label", "dims", "at", "value"]
    buckets = (coded.select("label", "dims", F.posexplode("keys").alias("at", "value")).groupBy(table).count()
               .filter("count > 1").select(*table, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    met = gathered(
        coded.select("*", F.posexplode("keys").alias("at", "value")).join(buckets, table)
        .withColumn("block", F.pmod(F.xxhash64("vector"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        .select(*table, "i", "j", "block", "node", "copies", "vector", "keys")
        .repartition(*table, "i", "j").sortWithinPartitions(*table, "i", "j")
        .mapInArrow(_meet(cosine, dtype), "node long, tied long, links long"), "links", size)
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(met, "node", "tied", size).join(nodes.select("node", "first"), "node")
    smallest = components.groupBy("component").agg(F.min("first").alias("component_id"))
    found = (nodes.select("label", "vector", "first", "node", "copies").join(links, "node", "left")
             .join(components.select("node", "component").join(smallest, "component"), "node", "left")
             .select("label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component_id", "first").alias("component_id")))
    known = F.col("vec_id").isNotNull()
    return (rows.join(found, ["label", "vector"], "left")
            .select("vec_id", F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                    F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


#: Every pair of a label compared, and reachability by links, for the test tables.
ORACLE = """
with recursive vectors as (
    select vec_id, label, cast(embedding as double[]) as v from embeddings where label is not null
), links as (
    select a.vec_id as x, b.vec_id as y from vectors a join vectors b on a.label = b.label and a.vec_id <> b.vec_id
    where list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98e0
), reach as (
    select vec_id, vec_id as other from embeddings
    union
    select r.vec_id, l.y from reach r join links l on l.x = r.other
), counts as (
    select x, count(*) as n from links group by x
)
select r.vec_id, coalesce(any_value(c.n), 0) as n_links, min(r.other) as component_id,
       r.vec_id = min(r.other) as kept
from reach r left join counts c on c.x = r.vec_id group by r.vec_id
"""
