"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending array of the ``K`` smallest distinct 64-bit hashes of a text's
word shingles. It needs nothing but built-in columns, is the same however a text's
shingles are spread over parts (``merge``), and estimates distinct counts, resemblance and
containment. All functions take and give columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorline.llm.shared import written

K, WIDTH = 128, 5
#: Bytes of a sketch's hashes as hexadecimal digits.
_DIGITS = 16
#: Rows of a range of ids in which neighbours are found.
RANGE = 1_000
#: Ids per range that the cuts between ranges are taken from.
DRAWN = 50
_LEAST, _SPAN = -(2**63), 2.0**64


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words between ASCII white space, in lower case; null: none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: Column, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` word hashes; of fewer words, of the whole sequence."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - width),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    none = F.expr("cast(array() as array<bigint>)")
    return (F.when(F.size(words) >= width, runs)
            .when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(none))


def sketch(hashes: Column, k: int = K) -> Column:
    """The ``k`` smallest distinct hashes."""
    return F.slice(F.array_distinct(F.sort_array(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated distinct shingles: exact below ``k`` hashes, else (k - 1) over the share of
    the hash range that the k smallest take up."""
    share = (F.get(a, F.lit(k - 1)).cast("double") - float(_LEAST)) / _SPAN
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def _shared_in_union(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    union = merge(a, b, k)
    return F.size(F.array_intersect(F.array_intersect(union, a), b)).cast("double"), F.size(union)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that is in both. Two
    empty sketches resemble each other fully, an empty and another one not at all."""
    both, size = _shared_in_union(a, b, k)
    return F.when(size == 0, 1.0).otherwise(both / size)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds; 1 if a has none."""
    both, size = _shared_in_union(a, b, k)
    overlap = both / size * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), overlap / distinct_count(a, k)))


def merged(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of ``by``. Hashes are cut to distinct ones before they move and
    ranked per group; a group of a third of all rows is combined on the way."""
    flat = sketches.select(*by, F.explode(column).alias("_h")).distinct()
    ranked = flat.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_h"))).filter(F.col("_r") <= k)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(column))


def as_text(a: Column) -> Column:
    """The hashes as fixed-width hexadecimal digits, joined."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), _DIGITS, "0")), "")


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are below ``key``, found in two steps of about the
    square root of their number; -1 for null."""
    if not cuts:
        return F.when(key.isNull(), -1).otherwise(0)
    width = max(1, int(len(cuts) ** 0.5))
    parts = [cuts[k:k + width] for k in range(0, len(cuts), width)]
    part = F.size(F.filter(F.lit([p[-1] for p in parts]), lambda c: c < key))
    inside = F.size(F.filter(F.get(F.array(*[F.lit(p) for p in parts]), part), lambda c: c < key))
    return F.when(key.isNull(), -1).when(part == len(parts), len(cuts)).otherwise(part * width + inside)


def with_next(docs: DataFrame, prepare: Callable[[DataFrame], DataFrame], rows_per_range: int = RANGE) -> DataFrame:
    """``prepare(docs)`` plus ``next``: a struct of what ``prepare`` adds to doc_id, of the row
    that follows by doc_id (null first); the last row is followed by the first.

    ``docs`` has doc_id and text; repeated ids follow each other by text. Ids are cut into
    ranges at approximate quantiles of a sample of ids, at most 100,000. Rows move once, to their range; the
    last one of a range is given the head of the following range by a join.
    """
    rows = docs.count()
    ranges = max(1, min(100_000, -(-rows // rows_per_range)))
    drawn = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, DRAWN * ranges / max(rows, 1))))
    cuts = drawn.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 10 * ranges)
                     ).first()[0] if ranges > 1 else []
    at = _range_of(F.col("doc_id"), sorted(set(cuts or [])))

    # Heads: the smallest id of each range is found on ids alone, then its text is read.
    order = Window.orderBy("_range")
    spots = docs.select("doc_id", at.alias("_range")).groupBy("_range").agg(F.min("doc_id").alias("_head_id"))
    spots = written(spots.select(F.coalesce(F.lag("_range").over(order), F.last("_range").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"), "_head_id"), "heads")
    heads = (docs.join(F.broadcast(spots), F.col("doc_id").eqNullSafe(F.col("_head_id")))
             .groupBy("_before", "doc_id").agg(F.min("text").alias("text")))
    heads = prepare(heads.select("doc_id", "text", "_before"))
    added = [c for c in heads.columns if c not in ("doc_id", "_before")]
    heads = heads.select(F.col("_before").alias("_range"), F.struct(*added).alias("_head"))

    window = Window.partitionBy("_range").orderBy(F.col("doc_id"), "text")
    return (prepare(docs.withColumn("_range", at))
            .withColumn("next", F.lead(F.struct(*added)).over(window))
            .join(heads, "_range").withColumn("next", F.coalesce("next", "_head")).drop("_range", "_head"))


def edited_with_next(text: Column, following: Column) -> Column:
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def with_sketch(docs: DataFrame, text_col: str = "text", column: str = "sketch", k: int = K) -> DataFrame:
    """``docs`` plus the sketch of ``text_col``. Word hashes are a column of their own in between,
    so that each shingle looks them up rather than computing them."""
    hashed = docs.withColumn("_words", word_hashes(F.col(text_col)))
    return hashed.withColumn(column, sketch(shingle_hashes(F.col("_words")), k)).drop("_words")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Per row: the fingerprint of the whole text and of its edited text, the likeness of both,
    the likeness to the next document, the distinct shingles, and the share of them that the
    edited text holds.

    Null texts count as empty; texts without words have empty fingerprints. Other columns
    are not read. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    paired = with_next(own, lambda rows: with_sketch(rows, k=k))
    edited = with_sketch(paired.withColumn("edited", edited_with_next(F.col("text"), F.col("next.text"))),
                         "edited", "edited_sketch", k)
    return edited.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next.sketch"), k).alias("near_next"),
        distinct_count(F.col("sketch"), k).alias("distinct_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("held_by_edited"))
