"""Near-duplicate documents by a signature-coordinate inverted join.

A document's signature holds the minimum of its shingle hashes under each of
``COORDINATES`` hash functions. Documents are posted under every (coordinate, value)
pair; two documents collide once for each pair they share. Pairs with at least
``matches`` collisions are retained and then confirmed on their full shingle sets.

* Prefix: with all documents' pairs in one global order, rarest list first, documents that
  share M of COORDINATES pairs share one of their first COORDINATES - M + 1.
  Only this prefix is merged.
* Skip: lists of one document are never merged, a document with fewer than M longer
  lists is skipped altogether, and the long lists behind the prefix are not merged but
  looked up in the signatures of the candidates that the prefix gave.
* Copies: equal shingle sets are one node from the start, and in each merged list all
  documents are first compared with its most central one. Only documents which that leaves
  in different components are compared among themselves, in blocks of bounded size.

M follows from the similarity: a pair right at it has fewer than M of 128 collisions with
probability ``MISSED`` at most (88 at 0.85, 79 at 0.80), and the more alike it is the less;
that is the chance to lose a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tenorline.llm.components import connected_components
from tenorline.llm.shared import broadcast_if_small, gathered, in_tasks, written
from tenorline.llm.shingles import shingle_set
from tenorline.llm.sorted_groups import sorted_groups

WIDTH, PERCENT = 5, 85
COORDINATES = 128
#: Chance at most to miss a pair whose similarity is exactly the threshold.
MISSED = 1.1e-6
#: Members of one block when documents of a list are compared among themselves.
BLOCK = 256
#: Keys that the members of one pivot are spread over.
SALTS = 32
#: Ids of documents with candidates are broadcast up to this many (8 bytes each).
MOST_BROADCAST = 4_000_000

_seeds = np.random.default_rng(20)
_FACTORS = (_seeds.integers(0, 2**32, COORDINATES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_OFFSETS = _seeds.integers(0, 2**32, COORDINATES, dtype=np.uint64).astype(np.uint32)


def matches_for(percent: int) -> int:
    """The most collisions that a pair of ``percent`` similarity has with all but ``MISSED`` probability."""
    p, below, matches = percent / 100, 0.0, 0
    while matches < COORDINATES:
        below += comb(COORDINATES, matches) * p**matches * (1 - p)**(COORDINATES - matches)
        if below > MISSED:
            break
        matches += 1
    return max(1, matches)


def signature(hashes: np.ndarray, step: int = 2048) -> np.ndarray:
    """Minimum of the hashes under each coordinate's function, as signed 32-bit values."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 2**32 - 1, np.uint32)
    for at in range(0, len(high), step):
        part = high[None, at:at + step] * _FACTORS[:, None]
        part += _OFFSETS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least.view(np.int32)


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, signatures = [], [], []
            for text in batch.column(1):
                hashes = shingle_set(text.as_py(), width)
                counts.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                signatures.append(signature(hashes) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.list_(pa.int32()))],
                names=["doc_id", "n_shingles", "digest", "signature"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, values = [], []
            for text in batch.column(1):
                raw = shingle_set(text.as_py(), width).tobytes()
                digests.append(xxhash.xxh3_128_digest(raw))
                values.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(values, pa.binary())],
                names=["rep", "digest", "hashes"])

    return run


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                linked.append(_alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]
                                             ).filter(pa.array(linked, pa.bool_()))

    return run


def _likely(group: pa.Table, percent: int, matches: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of one block (or two): a row, and the rows retained with it that are in other components,
    those with the most collisions first. Pairs with the pivot have been decided before."""
    of = {c: group.column(c).to_numpy() for c in ("rep", "tag", "n", "component", "block")}
    sig = group.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    pivot = (of["rep"] == group.column("p_rep")[0].as_py()) & (of["tag"] == group.column("p_tag")[0].as_py())
    right = np.flatnonzero((of["block"] == j) & ~pivot)
    for x in np.flatnonzero((of["block"] == i) & ~pivot):
        y = right[right > x] if i == j else right
        n, m = of["n"][x], of["n"][y]
        y = y[(of["component"][y] != of["component"][x])
              & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))]
        same = (sig[y] == sig[x]).sum(axis=1)
        y = y[same >= matches][np.argsort(-same[same >= matches], kind="stable")]
        if len(y):
            yield int(x), y


_GROUP = ["p_rep", "p_tag", "i", "j"]
_MEMBER = ["p_rep", "p_tag", "rep", "tag", "n", "component"]


def _with_partner(percent: int, matches: int):
    """The members that a block retains a pair of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _GROUP):
            found = np.zeros(len(group), np.bool_)
            for x, y in _likely(group, percent, matches):
                found[x] = found[y] = True
            yield from group.select(_MEMBER).filter(pa.array(found)).to_batches()

    return run


def _tied(percent: int, matches: int):
    """Links that join components: retained pairs confirmed on their full sets, but for pairs
    whose components the block has joined already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _GROUP):
            rep, component = group.column("rep").to_pylist(), group.column("component").to_pylist()
            sets = [np.frombuffer(h.as_buffer(), np.uint64) for h in group.column("hashes")]
            root = {c: c for c in component}

            def find(c):
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            links = []
            for x, partners in _likely(group, percent, matches):
                for y in partners:
                    a, b = find(component[x]), find(component[y])
                    if a != b and _alike(sets[x], sets[y], percent):
                        root[max(a, b)] = min(a, b)
                        links.append((rep[x], rep[y]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return run


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members of each pivot dealt to blocks, and blocks to pairs of blocks: n members make
    about (n / BLOCK)^2 / 2 groups of at most two blocks. Members meet their pivot's number of
    blocks under one of ``SALTS`` keys, so those of a large group do so in several tasks."""
    blocks = (members.groupBy("p_rep", "p_tag").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("tag", "rep"), F.lit(SALTS)).cast("int"))
    return (salted.join(blocks, ["p_rep", "p_tag", "salt"]).drop("salt")
            .withColumn("block", F.pmod(F.xxhash64("rep", "tag"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .drop("blocks", "other").repartition(*_GROUP).sortWithinPartitions(*_GROUP))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (rep_a, tag_a, rep_b, tag_b) whose full sets are alike, as (a, b)."""
    a = sets.select(F.col("rep").alias("rep_a"), F.col("tag").alias("tag_a"), F.col("hashes").alias("set_a"))
    b = sets.select(F.col("rep").alias("rep_b"), F.col("tag").alias("tag_b"), F.col("hashes").alias("set_b"))
    return (pairs.join(a, ["rep_a", "tag_a"]).join(b, ["rep_b", "tag_b"])
            .select("rep_a", "rep_b", "set_a", "set_b")
            .mapInArrow(_confirm(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, matches: int | None = None, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their shingle
    sets; a component is named by its smallest doc_id and ``kept`` marks that document.
    ``matches`` is ``matches_for(percent)`` unless given.

    Null and empty texts, and texts of white space only, have no shingles: each is a
    component of its own. Equal texts are always linked. Rows that repeat a doc_id are one
    document, so the links of all its texts meet in one component. Rows without a doc_id are
    linked with nothing: component_id is null, kept is true. Other columns of ``docs`` are
    not read, so their names cannot clash. An empty table gives an empty result.
    """
    matches = matches or matches_for(percent)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    features = written(docs.mapInArrow(
        _features(width), "doc_id long, n_shingles long, digest binary, signature array<int>"), "features")
    rows = features.count()
    nodes = gathered(
        features.filter("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
             F.first("signature").alias("signature"))
        .withColumn("tag", F.xxhash64("digest")), "nodes", rows)

    # Postings under every (coordinate, value), and the lists with at least two documents.
    post = nodes.select("rep", "tag", F.posexplode("signature").alias("coordinate", "value")).select(
        "rep", "tag", F.shiftleft(F.col("value").cast("long"), 8).bitwiseOR(F.col("coordinate")).alias("key"))
    lists = post.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    active = gathered(
        post.join(lists, "key").groupBy("rep", "tag")
        .agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("lists"), F.sum("size").alias("central"))
        .filter(F.size("lists") >= matches)
        .withColumn("prefix", F.slice("lists", F.lit(1), F.size("lists") - matches + 1)["key"])
        .select("rep", "tag", "central", "prefix")
        .join(nodes.select("rep", "tag", "n", "signature"), ["rep", "tag"]), "active", rows)

    # Within each prefix list everything meets its most central document.
    merged = active.select("rep", "tag", "central", F.explode("prefix").alias("key"))
    pivots = (merged.groupBy("key").agg(
        F.max(F.struct("central", (-F.col("rep")).alias("low"), "rep", "tag")).alias("p"),
        F.count(F.lit(1)).alias("size")).filter("size > 1")
        .select("key", F.col("p.rep").alias("p_rep"), F.col("p.tag").alias("p_tag")))
    met = gathered(merged.join(pivots, "key").select("p_rep", "p_tag", "rep", "tag").distinct(), "met", rows)

    ids = broadcast_if_small(active.select("rep").distinct(), MOST_BROADCAST)
    sets = gathered(
        docs.join(ids, docs["doc_id"] == ids["rep"], "left_semi")
        .mapInArrow(_sets(width), "rep long, digest binary, hashes binary")
        .withColumn("tag", F.xxhash64("digest"))
        .join(active.select("rep", "tag"), ["rep", "tag"], "left_semi")
        .select("rep", "tag", "hashes").dropDuplicates(["rep", "tag"]), "sets", rows)

    looked_up = active.select("rep", "tag", "n", "signature")
    first = (met.filter("not (p_rep = rep and p_tag = tag)")
             .join(looked_up, ["rep", "tag"])
             .join(looked_up.select(F.col("rep").alias("p_rep"), F.col("tag").alias("p_tag"),
                                    F.col("n").alias("p_n"), F.col("signature").alias("p_signature")),
                   ["p_rep", "p_tag"])
             .filter(100 * F.least("n", "p_n") >= percent * F.greatest("n", "p_n"))
             .filter(F.size(F.filter(F.zip_with("signature", "p_signature", lambda x, y: x == y),
                                     lambda same: same)) >= matches)
             .select(F.col("rep").alias("rep_a"), F.col("tag").alias("tag_a"),
                     F.col("p_rep").alias("rep_b"), F.col("p_tag").alias("tag_b")))
    repeated = (features.filter("digest is not null").groupBy("doc_id").agg(F.count_distinct("digest").alias("texts"))
                .filter("texts > 1 and doc_id is not null").select("doc_id")
                .join(features.select("doc_id", "digest"), "doc_id")
                .join(nodes.select("digest", "rep"), "digest")
                .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    with_pivots = connected_components(_links(first, sets, percent).unionByName(repeated), "a", "b", rows)

    # What the pivots left apart meets in blocks, first by signature, then the rest by full sets.
    members = (met.join(looked_up.select("rep", "tag", "n"), ["rep", "tag"])
               .join(with_pivots.withColumnRenamed("node", "rep"), "rep", "left")
               .withColumn("component", F.coalesce("component", "rep")))
    apart = (members.groupBy("p_rep", "p_tag").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low < high").select("p_rep", "p_tag"))
    signatures = looked_up.select("rep", "tag", "signature")
    members = members.join(apart, ["p_rep", "p_tag"]).join(signatures, ["rep", "tag"])
    schema = ", ".join(f"{c} long" for c in _MEMBER)
    left = gathered(_in_blocks(members.select(*_MEMBER, "signature"))
                   .mapInArrow(_with_partner(percent, matches), schema).distinct(), "left", rows)
    left = left.join(signatures, ["rep", "tag"]).join(sets, ["rep", "tag"])
    ties = _in_blocks(left.select(*_MEMBER, "signature", "hashes")).mapInArrow(_tied(percent, matches), "a long, b long")
    joined = connected_components(
        with_pivots.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties), "a", "b", rows)

    named = nodes.select("digest", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    found = features.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    return in_tasks(
        found.select("doc_id", "n_shingles",
                     F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), rows)


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``found`` (of ``near_duplicates``) keeps, one per component.

    Of rows that repeat a kept doc_id the smallest, column by column, stays. Rows without a
    doc_id all stay.
    """
    key, rows = F.col(f"`{id_col}`"), docs.count()
    gone = broadcast_if_small(gathered(
        found.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone", rows), MOST_BROADCAST)
    kept = docs.join(gone, key == F.col("_gone"), "left_anti")
    repeated = gathered(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_again")).count()
                       .filter("count > 1").select("_again"), "repeated", rows)
    if repeated.isEmpty():
        return kept
    repeated = broadcast_if_small(repeated, MOST_BROADCAST)
    once = (kept.join(repeated, key == F.col("_again"), "left_semi")
            .groupBy(key.alias("_again")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row"))
            .select("_row.*"))
    return kept.join(repeated, key == F.col("_again"), "left_anti").unionByName(once)


#: Every pair of documents compared, and reachability by links, for the test tables.
ORACLE = """
with recursive words as (
    select doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
    from documents
), shingles as (
    select distinct doc_id, unnest(
        case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
             when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
    from words
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), pairs as (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
), links as (
    select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y
    where 100 * common >= 85 * (a.n + b.n - common)
), reach as (
    select doc_id, doc_id as other from documents
    union
    select r.doc_id, l.y from reach r join links l on l.x = r.other
)
select r.doc_id, coalesce(any_value(z.n), 0) as n_shingles, min(r.other) as component_id,
       r.doc_id = min(r.other) as kept
from reach r left join sizes z on z.doc_id = r.doc_id group by r.doc_id
"""
