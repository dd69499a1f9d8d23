"""Repeated passages by relative Lempel-Ziv parsing.

A window is ``WINDOW`` consecutive words. Words of a document that lie in a window which
also starts in a document with a smaller id are duplicates, but for the first document
that holds it.

Every window is routed to a reference block by its anchor, the least hash of the
``ANCHOR``-word runs within it: equal windows have equal anchors, so each meets all others
like it in one block, whatever the number of documents. What travels are segments, the
words of consecutive windows with one anchor. A block is indexed by a suffix array over the
segments of all its documents, and every segment is parsed greedily from left to right into
factors, each the longest match that starts in a segment of an earlier document. A window
within a factor is a duplicate; any other duplicate lies across exactly one boundary
between factors, since a factor that starts within it reaches its end, so windows across
boundaries that both factors together could hold are looked up as well.

Nothing is compared that need not be: documents with the same words are one; anchors that
stand in one document only are left out before anything else; equal segments of an anchor
are one, duplicates from the second document on; and an anchor with a single segment is not
parsed. Where an anchor has more than ``MOST_SEGMENTS``
distinct segments (words that stand in very many different contexts), its windows are
matched by the digests of all their words instead, which is exact and needs no block.

Words, segments and windows are compared by hashes of 64 bits and more.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tenorline.llm.shared import broadcast_if_small, written

WINDOW, ANCHOR = 50, 12
#: Distinct segments of one anchor up to which they are parsed in a block.
MOST_SEGMENTS = 2000
#: Words of one reference block at most, beyond its last anchor.
BLOCK_WORDS = 100_000
#: Keys of documents whose text is read again are broadcast up to this many (16 bytes each).
MOST_BROADCAST = 2_000_000
#: Anchors within a window; a segment has at most that many windows.
_RUNS = WINDOW - ANCHOR + 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: pa.StringScalar) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return text.as_buffer().to_pybytes().split() if text.is_valid else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """One hash for every run of ``length`` words."""
    last = len(hashes) - length + 1
    out = _mixed(hashes[:last] + np.uint64(length))
    for k in range(1, length):
        out = out * _BASE + hashes[k:last + k]
        out ^= out >> np.uint64(32)
    return _mixed(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def segments(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, windows) of each segment of a document: consecutive windows with one anchor,
    at most as many as can share one run of words."""
    if len(hashes) < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    anchors = _least(run_hashes(hashes, ANCHOR), _RUNS)
    first = np.concatenate(([True], anchors[1:] != anchors[:-1]))
    run = np.cumsum(first) - 1
    begins = np.flatnonzero(first)
    first |= (np.arange(len(anchors)) - begins[run]) % _RUNS == 0
    start = np.flatnonzero(first)
    return anchors[start], start, np.diff(np.append(start, len(anchors)))


_SEGMENT = "struct<anchor: bigint, segment: bigint, start: int, words: int>"
_DOCS = f"doc_id long, tag long, n_words long, digest binary, whole_sha256 string, segments array<{_SEGMENT}>"
_ARROW_SEGMENTS = pa.list_(pa.struct([("anchor", pa.int64()), ("segment", pa.int64()), ("start", pa.int32()), ("words", pa.int32())]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, wholes, offsets, parts = [], [], [], [0], ([], [], [], [])
        for text in batch.column(2):
            words = words_of(text)
            hashes = word_hashes(words)
            joined = b" ".join(words)
            counts.append(len(words))
            digests.append(xxhash.xxh3_128_digest(joined))
            wholes.append(sha256(joined).hexdigest())
            anchor, start, windows = segments(hashes)
            raw = hashes.tobytes()
            length = windows + WINDOW - 1
            named = [xxhash.xxh3_64_intdigest(raw[8 * a:8 * (a + n)]) for a, n in zip(start.tolist(), length.tolist())]
            for part, values in zip(parts, (anchor.view(np.int64), np.array(named, np.uint64).view(np.int64),
                                            start.astype(np.int32), length.astype(np.int32))):
                part.append(values)
            offsets.append(offsets[-1] + len(start))
        flat = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(p)) if p else pa.array([], t) for p, t in zip(parts, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            names=["anchor", "segment", "start", "words"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(wholes, pa.string()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)],
            names=["doc_id", "tag", "n_words", "digest", "whole_sha256", "segments"])


_FETCHED = "doc_id long, anchor long, segment long, hashes binary"


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of the segments that are asked for: (doc_id, text, wanted)."""
    for batch in batches:
        for doc, text, wanted in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
            raw = word_hashes(words_of(text)).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc.as_py()] * len(wanted), pa.int64()), pa.array([w["anchor"] for w in wanted], pa.int64()),
                 pa.array([w["segment"] for w in wanted], pa.int64()),
                 pa.array([raw[8 * w["start"]:8 * (w["start"] + w["words"])] for w in wanted], pa.binary())],
                names=["doc_id", "anchor", "segment", "hashes"])


class Block:
    """A suffix array over the segments of a block. ``words`` are all their word hashes one after
    the other, ``docs`` the place of each word's document in the order of ids (equal for equal
    ids), ``starts`` the first word of each segment."""

    def __init__(self, words: np.ndarray, docs: np.ndarray, starts: np.ndarray):
        self.words, self.docs, self.starts = words, docs, starts
        lengths = np.diff(np.append(starts, len(words)))
        self.segment = np.repeat(np.arange(len(starts)), lengths)
        # Words up to the end of the segment: no match passes it.
        self.left = (starts + lengths)[self.segment] - np.arange(len(words))
        self.longest = self._earlier_matches()

    def _ranks(self) -> list[tuple[int, np.ndarray]]:
        """(length, rank of the next ``length`` words), the length doubling until it covers every
        segment; behind the end of a segment stand empty words, which come before all others."""
        length, rank = 1, np.unique(self.words, return_inverse=True)[1].astype(np.int64)
        out = [(1, rank)]
        while length < int(self.left.max()):
            second = np.zeros(len(rank), np.int64)
            inside = np.flatnonzero(self.left > length)
            second[inside] = rank[inside + length] + 1
            rank = np.unique(rank * (len(rank) + 1) + second, return_inverse=True)[1].astype(np.int64)
            length *= 2
            out.append((length, rank))
        return out

    def _earlier_matches(self) -> np.ndarray:
        """For each position the length of the longest match with an earlier document.

        Positions in the order of their suffixes: the longest match is with the nearest
        position before or after that has an earlier document. Both are found by leaving out
        ever smaller runs of positions none of which has one.
        """
        ranks = self._ranks()
        order = np.argsort(ranks[-1][1])
        a, b = order[:-1], order[1:]
        common = np.zeros(len(a), np.int64)
        room = np.minimum(self.left[a], self.left[b])
        for length, rank in reversed(ranks):
            fits = np.flatnonzero(common + length <= room)
            same = rank[a[fits] + common[fits]] == rank[b[fits] + common[fits]]
            common[fits[same]] += length
        docs = self.docs[order]
        up = self._nearest(docs, common)
        down = self._nearest(docs[::-1], common[::-1])[::-1]
        out = np.zeros(len(order), np.int64)
        out[order] = np.maximum(up, down)
        return out

    @staticmethod
    def _nearest(docs: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Common words with the nearest position before that has an earlier document, else 0."""
        n = len(docs)
        least, lowest = [docs], [np.concatenate(([0], common))]  # lowest[k]: common words of k-1 and k
        while 2 * (1 << (len(least) - 1)) <= n:
            step = 1 << (len(least) - 1)
            for table in (least, lowest):
                last = table[-1].copy()
                last[step:] = np.minimum(last[step:], table[-1][:-step])
                table.append(last)
        at, shared = np.arange(n) - 1, np.concatenate(([0], common))
        for k in range(len(least) - 1, -1, -1):
            step = 1 << k
            # All of at-step+1 .. at have no earlier document: pass over them.
            go = np.flatnonzero(at >= step - 1)
            go = go[(least[k][at[go]] >= docs[go]) & (shared[go] > 0)]
            shared[go] = np.minimum(shared[go], lowest[k][at[go]])
            at[go] -= step
        return np.where(at >= 0, np.where(docs[np.maximum(at, 0)] < docs, shared, 0), 0)

    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) of the greedy factors of all segments, in order. A word that no earlier
        document has is a factor of length 1."""
        starts, lengths, now = [], [], self.starts
        ends = now + self.left[now] if len(now) else now
        while len(now):
            length = np.minimum(np.maximum(self.longest[now], 1), ends - now)
            starts.append(now)
            lengths.append(length)
            now = now + length
            going = now < ends
            now, ends = now[going], ends[going]
        start = np.concatenate(starts) if starts else np.empty(0, np.int64)
        order = np.argsort(start)
        return start[order], np.concatenate(lengths)[order] if starts else start

    def duplicates(self) -> np.ndarray:
        """A flag for each word at which a window starts that an earlier document holds."""
        start, length = self.factors()
        marks = np.zeros(len(self.words) + 1, np.int64)
        long = length >= WINDOW
        np.add.at(marks, start[long], 1)
        np.add.at(marks, (start + length)[long] - WINDOW + 1, -1)
        found = np.cumsum(marks)[:-1] > 0
        # Windows across the boundary between a factor and the next of the same segment.
        if len(start) > 1:
            edge, low, high = start[1:], start[:-1], (start + length)[1:]
            inner = self.segment[edge] == self.segment[low]
            first = np.maximum(low, edge - WINDOW + 1)[inner]
            last = np.minimum(edge - 1, high - WINDOW)[inner]
            across = first <= last
            marks = np.zeros(len(self.words) + 1, np.int64)
            np.add.at(marks, first[across], 1)
            np.add.at(marks, last[across] + 1, -1)
            found |= (np.cumsum(marks)[:-1] > 0) & (self.longest >= WINDOW)
        return found


def spans_of(flags: np.ndarray) -> list[dict]:
    """Words that the flagged windows cover, as spans from the first to behind the last."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    new = np.flatnonzero(np.diff(at) > WINDOW) + 1
    first, last = at[np.concatenate(([0], new))], at[np.concatenate((new - 1, [len(at) - 1]))]
    return [{"first": int(a), "behind": int(b) + WINDOW} for a, b in zip(first, last)]


_SPANS = "array<struct<first: int, behind: int>>"
_ARROW_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("behind", pa.int32())]))
_FOUND = f"doc_id long, anchor long, segment long, spans {_SPANS}"


def _parse(rows: list[dict]) -> pa.RecordBatch:
    words = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    ids = np.unique([r["doc_id"] for r in rows], return_inverse=True)[1]
    flags = Block(np.concatenate(words), np.repeat(ids, lengths), starts).duplicates()
    spans = [spans_of(flags[a:a + n]) for a, n in zip(starts, lengths)]
    some = [k for k, s in enumerate(spans) if s]
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[k]["doc_id"] for k in some], pa.int64()), pa.array([rows[k]["anchor"] for k in some], pa.int64()),
         pa.array([rows[k]["segment"] for k in some], pa.int64()), pa.array([spans[k] for k in some], _ARROW_SPANS)],
        names=["doc_id", "anchor", "segment", "spans"])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of duplicates in segments sorted by anchor. A block ends behind an anchor."""
    rows: list[dict] = []
    held = 0
    for batch in batches:
        for r in batch.to_pylist():
            if held >= BLOCK_WORDS and r["anchor"] != rows[-1]["anchor"]:
                yield _parse(rows)
                rows, held = [], 0
            rows.append(r)
            held += len(r["hashes"]) // 8
    if rows:
        yield _parse(rows)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of segments: (doc_id, anchor, segment, at, digest)."""
    for batch in batches:
        for r in batch.to_pylist():
            raw = r["hashes"]
            count = len(raw) // 8 - WINDOW + 1
            digests = [xxhash.xxh3_128_digest(raw[8 * k:8 * (k + WINDOW)]) for k in range(count)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c]] * count, pa.int64()) for c in ("doc_id", "anchor", "segment")]
                + [pa.array(range(count), pa.int32()), pa.array(digests, pa.binary())],
                names=["doc_id", "anchor", "segment", "at", "digest"])


_WINDOWS = "doc_id long, anchor long, segment long, at int, digest binary"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed words and the rest of each document: (first, own_tag, text, spans)."""
    for batch in batches:
        removed, texts = [], []
        for text, spans in zip(batch.column(2), batch.column(3).to_pylist()):
            words = words_of(text)
            marks = np.zeros(len(words) + 1, np.int64)
            np.add.at(marks, [s["first"] for s in spans], 1)
            np.add.at(marks, [s["behind"] for s in spans], -1)
            gone = np.cumsum(marks)[:-1] > 0
            removed.append(int(gone.sum()))
            texts.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
            names=["first", "own_tag", "n_removed", "kept"])


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, tag, text) of the documents that ``keys`` (doc_id, tag), a written table, names, once each."""
    few = broadcast_if_small(keys.select("doc_id", "tag").distinct(), MOST_BROADCAST)
    some = docs.join(few, ["doc_id", "tag"], "left_semi")
    repeated = some.groupBy("doc_id", "tag").count().filter("count > 1")
    return some if repeated.isEmpty() else some.dropDuplicates(["doc_id", "tag"])


def duplicate_spans(docs: DataFrame, most_segments: int = MOST_SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """Of (doc_id, tag, text), where tag tells texts apart: one row per document (doc_id, n_words,
    whole_sha256, first, own_tag), where the latter two name the first document with the same
    words; and (doc_id, tag, spans) of such first documents with duplicate windows. Both written."""
    cut = written(docs.select("doc_id", "tag", "text").mapInArrow(_cut, _DOCS), "cut")
    numbered = cut.filter("doc_id is not null and n_words > 0")
    firsts = numbered.groupBy("digest").agg(F.min(F.struct("doc_id", "tag")).alias("own"))
    named = written(cut.join(firsts, "digest", "left").select(
        "doc_id", "n_words", "whole_sha256", F.col("own.doc_id").alias("first"), F.col("own.tag").alias("own_tag")), "named")
    # Of documents with the same words the first one stands for all.
    own = numbered.filter(f"n_words >= {WINDOW}").groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "tag", "segments"), F.struct("doc_id", "tag")).alias("own"))
    placed = written(own.select("own.doc_id", "own.tag", F.explode("own.segments").alias("s"))
                     .select("doc_id", "tag", "s.anchor", "s.segment", "s.start", "s.words"), "segments")

    # Only where an anchor stands in two documents can one hold a window of the other: all that
    # follows is about these segments. Segments of copies are added up before they are moved.
    met = placed.groupBy("anchor").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")).filter("_low < _high")
    placed = written(placed.join(written(met.select("anchor"), "met"), "anchor", "left_semi"), "placed")
    distinct = placed.groupBy("anchor", "segment").agg(
        F.min(F.struct("doc_id", "tag", "start", "words")).alias("at"), F.max("doc_id").alias("last"))
    distinct = written(distinct.select("anchor", "segment", "at.*", (F.col("last") > F.col("at.doc_id")).alias("again")), "distinct")
    shared = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("segments")).filter("segments > 1")
    shared = written(shared, "shared")

    # The words of segments to compare, looked up in the first document that has each.
    wanted = written(distinct.join(shared, "anchor").groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("anchor", "segment", "start", "words")).alias("wanted")), "wanted")
    fetched = written(_texts(docs, wanted).join(wanted, ["doc_id", "tag"]).select("doc_id", "text", "wanted")
                      .mapInArrow(_fetched, _FETCHED), "fetched")
    large = shared.filter(F.col("segments") > most_segments).select("anchor")
    small = fetched.join(large, "anchor", "left_anti")
    parsed = small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_parsed, _FOUND)

    windows = fetched.join(large, "anchor", "left_semi").select("doc_id", "anchor", "segment", "hashes").mapInArrow(_windows, _WINDOWS)
    earliest = windows.groupBy("digest").agg(F.min("doc_id").alias("earliest"))
    matched = (windows.join(earliest, "digest").filter("earliest < doc_id")
               .select("doc_id", "anchor", "segment",
                       F.array(F.struct(F.col("at").alias("first"), (F.col("at") + WINDOW).alias("behind"))).cast(_SPANS).alias("spans")))
    found = written(parsed.unionByName(matched), "found")

    # The first document of a segment loses what was found there, wherever the segment stands in
    # it, and all later documents the whole segment.
    nothing = F.array().cast(_SPANS)
    later = distinct.filter("again").select("doc_id", "anchor", "segment", nothing.alias("spans"))
    marked = later.unionByName(found).groupBy("anchor", "segment").agg(
        F.min("doc_id").alias("_first"), F.flatten(F.collect_list("spans")).alias("_spans"))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("words").alias("behind"))).cast(_SPANS)
    spans = (placed.join(marked, ["anchor", "segment"])
             .select("doc_id", "tag", "start", F.when(F.col("doc_id") > F.col("_first"), whole).otherwise(F.col("_spans")).alias("spans"))
             .filter(F.size("spans") > 0)
             .select("doc_id", "tag", F.transform("spans", lambda s: F.struct(
                 (F.col("start") + s["first"]).alias("first"), (F.col("start") + s["behind"]).alias("behind"))).cast(_SPANS).alias("spans"))
             .groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    return named, written(spans, "spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept), one row per row of ``docs``: its words without
    those that lie in a window which also starts in a document with a smaller id.

    ``kept`` is the text that stays where words were removed, null where nothing was (the
    text itself stays). Null texts and texts of white space only have no words. Rows that
    repeat an id are documents of their own, none of them before the other. Rows without an
    id are before or behind no document: they lose nothing. Other columns are not read. An
    empty table gives an empty result.
    """
    text = F.col(f"`{text_col}`").cast("string")
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    named, spans = duplicate_spans(docs, most_segments)
    partly = written(_texts(docs, spans).join(spans, ["doc_id", "tag"]).select("doc_id", "tag", "text", "spans")
                     .mapInArrow(_kept, "first long, own_tag long, n_removed long, kept string"), "kept")
    gone = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= WINDOW)
    changed = F.col("doc_id").isNotNull() & (F.col("n_removed") > 0)
    return named.join(partly, ["first", "own_tag"], "left").select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).when(changed, F.col("n_removed")).otherwise(F.lit(0).cast("long")).alias("n_removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).when(changed, F.sha2("kept", 256)).otherwise(F.col("whole_sha256")).alias("kept_sha256"),
        F.when(gone, F.lit("")).when(changed, F.col("kept")).alias("kept"))


ORACLE = r"""
with worded as (
    select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), windows as (
    select doc_id, i, array_to_string(w[i:i + 49], ' ') as words
    from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from worded)
), earliest as (
    select words, min(doc_id) as first from windows group by words
), covered as (
    select distinct x.doc_id, unnest(range(x.i, x.i + 50)) as k
    from windows x join earliest e on e.words = x.words where e.first < x.doc_id
), gone as (
    select doc_id, list(k) as ks from covered group by doc_id
)
select d.doc_id, len(w)::bigint as n_words, coalesce(len(ks), 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, k: ks is null or not list_contains(ks, k)), ' '), '')) as kept_sha256
from worded d left join gone g on g.doc_id = d.doc_id
"""
