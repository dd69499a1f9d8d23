"""Merkle manifest of a table of documents: one digest that vouches for every row.

Rows are leaves, ordered within their group; every ``FANOUT`` consecutive nodes have one
parent, up to one root per group, and the groups' roots in turn have one root. All digests
are SHA-256; a parent hashes the hexadecimal digits of its children, one after the other.

A tree is stored as aligned subtrees of ``HEIGHT`` levels above their leaves, each one row
and one array in van Emde Boas order: a subtree is cut at half its height, its top part
comes first and its bottom parts follow one after the other, each laid out by the same
rule. ``addresses`` gives the place of every node by arithmetic alone, so construction and
the retrieval of siblings use the same table of places for every subtree. The roots of
the subtrees are the leaves of the next layer, until one subtree is left per tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenorline.llm.shared import written
from tenorline.llm.sorted_groups import sorted_groups

FANOUT = 16
#: Levels of one stored subtree above its leaves: 16^3 = 4,096 leaves, 4,369 nodes.
HEIGHT = 3
BLOCK = FANOUT**HEIGHT
#: Rows of one range when leaves are put in order.
ROWS_PER_RANGE = 200_000
_BYTES = 32


@cache
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """For each level of a full subtree, the root's first, the places of its nodes in van Emde
    Boas order: the upper half of the levels, then the subtrees below it one after the other."""
    if height == 0:
        return (np.zeros(1, np.int64),)
    top_height = (height - 1) // 2
    top, bottom = addresses(top_height), addresses(height - 1 - top_height)
    top_size = sum(len(level) for level in top)
    size = sum(len(level) for level in bottom)
    starts = top_size + size * np.arange(FANOUT * len(top[-1]))
    return top + tuple((starts[:, None] + level[None, :]).ravel() for level in bottom)


def levels_above(leaves: int) -> int:
    """Levels of parents over ``leaves`` nodes until one is left."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // FANOUT)
        levels += 1
    return levels


def leaf_digest(columns: list[Column]) -> Column:
    """The digest of a row: every column as `-` if null, else as UTF-8 byte count, `:` and value."""
    fields = []
    for c in columns:
        text = c.cast("string")
        fields.append(F.when(text.isNull(), "-").otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*fields), 256)


def _build(group: pa.Table) -> dict:
    """One subtree out of its leaves in order. All subtrees but a tree's only one are reduced by
    HEIGHT levels, as more nodes than theirs remain on each level."""
    size = group.num_rows
    height = HEIGHT if group.column("n")[0].as_py() > BLOCK else levels_above(size)
    place = addresses(height)
    nodes = np.zeros((sum(len(level) for level in place), _BYTES), np.uint8)
    digests = group.column("digest").to_pylist()
    for level in range(height, -1, -1):
        nodes[place[level][:len(digests)]] = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, _BYTES)
        if level:
            digests = [sha256(b"".join(digests[k:k + FANOUT]).hex().encode()).digest()
                       for k in range(0, len(digests), FANOUT)]
    return {"tree": group.column("tree")[0].as_py(), "block": group.column("block")[0].as_py(),
            "n": group.column("n")[0].as_py(), "size": size, "height": height, "root": digests[0],
            "nodes": nodes.tobytes(), "carried": group.column("carried").to_pylist()}


_BLOCKS = ("tree long, block long, n long, size int, height int, root binary, nodes binary, "
           "carried array<struct<id: long, claimed: binary>>")
_ARROW_BLOCKS = pa.schema([
    ("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("size", pa.int32()), ("height", pa.int32()),
    ("root", pa.binary()), ("nodes", pa.binary()),
    ("carried", pa.list_(pa.struct([("id", pa.int64()), ("claimed", pa.binary())])))])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in sorted_groups(batches, ["tree", "block"]):
        yield pa.RecordBatch.from_pylist([_build(group)], _ARROW_BLOCKS)


def ranked(rows: DataFrame, keys: list[str], tree: list[str], label: str) -> DataFrame:
    """``rows`` plus tree (number of the first row of its tree in the order of ``keys``), rank (from
    0 within the tree) and n (rows of the tree); a tree is one value of ``tree``, which ``keys`` begin with.

    Rows are put in ranges of ``keys``, so a tree of any size is spread. Their number within
    a range is added to the rows of the ranges before, one number per range.
    """
    ranges = max(16, -(-rows.count() // ROWS_PER_RANGE))
    place = F.monotonically_increasing_id()
    ordered = written(rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
                      .withColumn("_place", place), label)
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = sorted(ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = {}, 0
    for r in sizes:
        before[r["part"]] = total
        total += r["n"]
    offsets = rows.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "_part long, _offset long")
    numbered = ordered.join(F.broadcast(offsets), part == F.col("_part")).withColumn("_row", F.col("_offset") + within)
    if not tree:
        return numbered.withColumns({"tree": F.lit(0).cast("long"), "rank": F.col("_row"), "n": F.lit(total).cast("long")}
                                    ).drop("_place", "_part", "_offset", "_row")
    same = F.lit(True)
    for c in tree:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_t_{c}"))
    trees = numbered.groupBy(*tree).agg(F.min("_row").alias("tree"), F.count(F.lit(1)).alias("n"))
    trees = trees.select(*[F.col(c).alias(f"_t_{c}") for c in tree], "tree", "n")
    return (numbered.join(trees, same).withColumn("rank", F.col("_row") - F.col("tree"))
            .drop("_place", "_part", "_offset", "_row", *[f"_t_{c}" for c in tree]))


def layers(leaves: DataFrame, label: str) -> list[DataFrame]:
    """The stored layers over ``leaves`` (tree, rank, n, digest binary, carried), bottom first.

    ``carried`` stays beside the leaves of the lowest layer. The number of layers grows
    with the logarithm of the largest tree to the base 4,096.
    """
    built, now = [], leaves
    while not built or not now.isEmpty():
        blocks = (now.withColumn("block", F.expr(f"rank div {BLOCK}"))
                  .repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
                  .select("tree", "block", "n", "digest", "carried")
                  .mapInArrow(_subtrees, _BLOCKS))
        built.append(written(blocks, f"{label}-{len(built)}"))
        nothing = F.lit(None).cast("struct<id: bigint, claimed: binary>")
        now = built[-1].filter(f"n > {BLOCK}").select(
            "tree", F.col("block").alias("rank"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"),
            F.col("root").alias("digest"), nothing.alias("carried"))
    return built


def tops(built: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree: its one subtree that no layer above holds as a leaf."""
    each = [b.filter(f"n <= {BLOCK}").select("tree", "root") for b in built]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def siblings(nodes: np.ndarray, height: int, size: int, leaf: int) -> Iterator[tuple[bytes, bytes]]:
    """On each level from ``leaf`` up, the siblings left and right of its path within one subtree."""
    place, at, count = addresses(height), leaf, size
    for level in range(height, 0, -1):
        first = at - at % FANOUT
        run = place[level][first:min(first + FANOUT, count)]
        yield nodes[run[:at - first]].tobytes(), nodes[run[at - first + 1:]].tobytes()
        at, count = at // FANOUT, -(-count // FANOUT)


def folded(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that follows from a digest and the siblings of its path."""
    for left, right in path:
        digest = sha256((left + digest + right).hex().encode()).digest()
    return digest


_PATH = "array<struct<left: binary, right: binary>>"
_ARROW_PATH = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
_PATHS = f"tree long, block long, path {_PATH}"


def _paths_below(of_roots: bool):
    """For each leaf of a subtree, its path to the root of all: (tree, block of the layer below,
    path), or where the leaves are the groups' roots, (tree of the group, 0, path)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                nodes = np.frombuffer(block["nodes"], np.uint8).reshape(-1, _BYTES)
                above = [(p["left"], p["right"]) for p in block["path"]]
                leaves = range(block["size"])
                paths = [[{"left": a, "right": b}
                          for a, b in [*siblings(nodes, block["height"], block["size"], leaf), *above]] for leaf in leaves]
                trees = [c["id"] for c in block["carried"]] if of_roots else [block["tree"]] * len(leaves)
                blocks = [0] * len(leaves) if of_roots else [block["block"] * BLOCK + leaf for leaf in leaves]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(trees, pa.int64()), pa.array(blocks, pa.int64()), pa.array(paths, _ARROW_PATH)],
                    names=["tree", "block", "path"])

    return run


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per leaf: the digest of its proof and the root that its claimed digest folds to."""
    for batch in batches:
        for block in batch.to_pylist():
            nodes = np.frombuffer(block["nodes"], np.uint8).reshape(-1, _BYTES)
            above, size = [(p["left"], p["right"]) for p in block["path"]], block["size"]
            rest = b"".join(a + b for a, b in above).hex().encode()
            leaves = nodes[addresses(block["height"])[block["height"]][:size]]
            digests, proofs, roots = [], [], []
            for leaf, carried in enumerate(block["carried"]):
                own = list(siblings(nodes, block["height"], size, leaf))
                digests.append(leaves[leaf].tobytes().hex())
                proofs.append(sha256(b"".join(a + b for a, b in own).hex().encode() + rest).hexdigest())
                roots.append(folded(carried["claimed"], own + above).hex())
            yield pa.RecordBatch.from_arrays(
                [pa.array([c["id"] for c in block["carried"]], pa.int64()), pa.array(digests),
                 pa.array([block["subroot"].hex()] * size), pa.array(proofs), pa.array(roots)],
                names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])


@dataclass(frozen=True)
class Manifest:
    """``blocks``: layers of the groups' trees, bottom first; ``roots``: (tree, group, root) with
    one row per group; ``above``: layers of the tree over the groups' roots."""

    blocks: list[DataFrame]
    roots: DataFrame
    above: list[DataFrame]

    @property
    def root(self) -> str | None:
        """The digest over all rows in hexadecimal digits; None for an empty table."""
        top = tops(self.above).first()
        return top["root"].hex() if top else None


def manifest(docs: DataFrame, columns: list[str], group: str, order: str, claimed: Column | None = None) -> Manifest:
    """Builds the manifest of ``docs`` over the given columns.

    ``order`` is an integer column. ``claimed`` is another leaf digest per row (hexadecimal),
    which ``proofs`` folds in place of the row's own; by default both are the same.

    Groups are ordered by their UTF-8 bytes, null first, as are null values of ``order``; rows
    that tie are ordered by their digests, so the manifest does not depend on the table's order.
    Null columns count as `-`, apart from empty ones. Columns that are not named are not
    read. An empty table has no root.
    """
    own = leaf_digest([F.col(f"`{c}`") for c in columns])
    digests = written(docs.select(
        F.col(f"`{group}`").cast("string").alias("_source"), F.col(f"`{order}`").cast("long").alias("id"),
        F.unhex(own).alias("digest"), F.unhex(own if claimed is None else claimed).alias("claimed")), "leaves")
    leaves = ranked(digests, ["_source", "id", "digest", "claimed"], ["_source"], "ordered")
    carried = leaves.withColumn("carried", F.struct("id", "claimed"))
    blocks = layers(carried.select("tree", "rank", "n", "digest", "carried"), "blocks")
    names = leaves.groupBy("tree").agg(F.min("_source").alias("group"))
    roots = written(tops(blocks).join(names, "tree"), "roots")
    over = ranked(roots.select(F.col("tree").alias("of"), "root"), ["of"], [], "roots-ordered")
    above = layers(over.select("tree", "rank", "n", F.col("root").alias("digest"),
                               F.struct(F.col("of").alias("id"), F.col("root").alias("claimed")).alias("carried")), "above")
    return Manifest(blocks, roots, above)


def _with_paths(built: list[DataFrame], top_paths: DataFrame | None) -> DataFrame:
    """The subtrees of the lowest layer with their paths to the root of all: from the layer above
    all others down, each subtree's path is that of its leaf in the layer above. ``top_paths``
    has (tree, path) for the trees' own roots; without it these are the root of all."""
    whole = [b.filter(f"n <= {BLOCK}").select("tree", "block") for b in built]
    whole = [w.withColumn("path", F.array().cast(_PATH)) if top_paths is None else w.join(top_paths, "tree") for w in whole]
    now = whole[-1]
    for k in range(len(built) - 2, -1, -1):
        upper = built[k + 1].join(now, ["tree", "block"])
        now = whole[k].unionByName(upper.mapInArrow(_paths_below(False), _PATHS))
    return built[0].join(now, ["tree", "block"])


def proofs(m: Manifest) -> DataFrame:
    """(id, leaf, subroot, proof_sha256, folded_root), one row per leaf of the manifest.

    ``proof_sha256`` is the digest of all siblings on the way from the leaf to the root, level by
    level and left to right; ``folded_root`` the root that the claimed digest leads to.
    """
    of_roots = written(_with_paths(m.above, None).mapInArrow(_paths_below(True), _PATHS).drop("block"), "root-paths")
    paths = _with_paths(m.blocks, of_roots).join(m.roots.select("tree", F.col("root").alias("subroot")), "tree")
    return paths.mapInArrow(_proofs, "id long, leaf string, subroot string, proof_sha256 string, folded_root string")


def verified(m: Manifest) -> DataFrame:
    """``proofs`` with the root of all, and whether the claimed digest leads to it."""
    root = F.lit(m.root).cast("string")
    return proofs(m).select(F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256",
                            "folded_root", (F.col("folded_root") == root).alias("verified"))


#: The whole manifest level by level; leaves, their parents and all siblings are joined by position.
#: The checksum of an id is worked out bit by bit, as the engine has no function for it.
ORACLE = """
with recursive input as (
    select doc_id, source, row_number() over (order by source nulls first, doc_id nulls first) as row_id, lang, n_chars, text
    from documents
), field as (
    select row_id, doc_id, source,
        case when doc_id is null then '-' else concat(strlen(doc_id::varchar), ':', doc_id) end
        || case when source is null then '-' else concat(strlen(source), ':', source) end
        || case when lang is null then '-' else concat(strlen(lang), ':', lang) end
        || case when n_chars is null then '-' else concat(strlen(n_chars::varchar), ':', n_chars) end as head,
        case when text is null then '-' else concat(strlen(text), ':', text) end as body,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered
    from input
), bits(row_id, digits, pos, crc) as (
    select row_id, doc_id::varchar, 0, 4294967295::bigint from field where doc_id is not null
    union all
    select row_id, digits, pos + 1,
        list_reduce(list_concat([xor(crc, ord(substr(digits, pos + 1, 1))::bigint)], range(8)),
                    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)
    from bits where pos < length(digits)
), changed as (
    select row_id, xor(crc, 4294967295::bigint) % 5 = 0 as tampered from bits where pos = length(digits)
), leaves as (
    select f.row_id, doc_id, source, sha256(head || body) as leaf,
        case when c.tampered and lowered is not null then sha256(head || concat(strlen(lowered), ':', lowered))
             else sha256(head || body) end as claimed,
        row_number() over (partition by source order by f.row_id) - 1 as place,
        count(*) over (partition by source) as n
    from field f left join changed c on c.row_id = f.row_id
), low(source, height, place, n, digest) as (
    select source, 0, place, n, leaf from leaves
    union all
    select source, any_value(height) + 1, place // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' order by place))
    from low where n > 1 group by source, place // 16
), subroots as (
    select source, digest, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n
    from low where n = 1
), high(height, place, n, digest) as (
    select 0, place, n, digest from subroots
    union all
    select any_value(height) + 1, place // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' order by place))
    from high where n > 1 group by place // 16
), low_siblings as (
    select a.source, a.height, a.place,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place < a.place), '') as l,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place > a.place), '') as r
    from low a join low b on b.source is not distinct from a.source and b.height = a.height and b.place // 16 = a.place // 16
    where a.n > 1 group by a.source, a.height, a.place
), high_siblings as (
    select a.height, a.place,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place < a.place), '') as l,
        coalesce(string_agg(b.digest, '' order by b.place) filter (where b.place > a.place), '') as r
    from high a join high b on b.height = a.height and b.place // 16 = a.place // 16
    where a.n > 1 group by a.height, a.place
), climb(row_id, source, height, place, digest, proof) as (
    select row_id, source, 0, place, claimed, '' from leaves
    union all
    select c.row_id, c.source, c.height + 1, c.place // 16, sha256(s.l || c.digest || s.r), c.proof || s.l || s.r
    from climb c join low_siblings s on s.source is not distinct from c.source and s.height = c.height and s.place = c.place
), at_subroot as (
    select row_id, source, arg_max(digest, height) as digest, arg_max(proof, height) as proof from climb group by row_id, source
), rise(row_id, height, place, digest, proof) as (
    select a.row_id, 0, s.place, a.digest, a.proof from at_subroot a join subroots s on s.source is not distinct from a.source
    union all
    select c.row_id, c.height + 1, c.place // 16, sha256(s.l || c.digest || s.r), c.proof || s.l || s.r
    from rise c join high_siblings s on s.height = c.height and s.place = c.place
), at_root as (
    select row_id, arg_max(digest, height) as digest, arg_max(proof, height) as proof from rise group by row_id
)
select l.doc_id, l.leaf, s.digest as subroot, h.digest as root, sha256(a.proof) as proof_sha256,
       a.digest as folded_root, a.digest = h.digest as verified
from leaves l join at_root a on a.row_id = l.row_id join subroots s on s.source is not distinct from l.source
join high h on h.n = 1
"""
