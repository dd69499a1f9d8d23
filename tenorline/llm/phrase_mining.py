"""Phrases of words that stand together more often than their parts suggest.

Texts are cut into shards; each shard is an FM-index over the numbers of its words, in
both directions. A phrase is the pair of intervals of rows that start with it in the index of
the text and, read backwards, in that of the reversed text. Reading the symbols in front
of the rows of an interval extends all phrases of a length at once, to the left through one
index and to the right through the other, and either step moves both intervals. Counts are
interval lengths; they are summed across shards, first those of a task, then those of all tasks.

No phrase is more frequent than its parts, so a phrase is counted only if its words are
frequent overall, longer ones only if all their pairs and triples of neighbours are. What is
frequent reaches the shards as a Bloom filter of bounded size. Most pairs and triples are
rare: before they are counted by name, all shards add theirs to hashed counters, and only
those whose counter is large enough follow. Errors of filters and counters let more phrases
be counted than need be, and the sums decide, so no phrase is lost at any size.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorline.llm.shared import written

LONGEST, LEAST, BEST = 5, 100, 2000
#: Words of one language in a shard at most, beyond its last document.
SHARD_WORDS = 1 << 19
#: Rows order by this many symbols at least, which suffices for phrases up to this length.
DEPTH = 6
#: Bits of a Bloom filter per entry, and at most (32 MB).
FILTER_BITS, MOST_BITS = 16, 1 << 28
#: Shards, megabytes each, that Python gets at once.
SHARDS_AT_ONCE = 2
#: Shards take megabytes a row. Parquet by itself looks at sizes only after 100 rows, so pages and row groups would hold
#: all shards of a task, as would the buffers that (de)compress a page and the batch of columns that is read at once. It
#: also keeps the least and greatest value of every row group, whole, until a file ends.
ROW_GROUP = 1 << 23
LARGE_ROWS = {"parquet.block.size": ROW_GROUP, "parquet.column.statistics.enabled": False} | {
    f"parquet.{part}.size.row.check.{bound}": 1 for part in ("block", "page") for bound in ("min", "max")}
#: Phrases whose counts a task adds up at once before it hands them over, and tasks per core that index or count shards.
MOST_HELD, TASKS_PER_CORE = 1 << 18, 2
#: Words per hashed counter of pairs or triples, and counters that one task adds up at once.
COUNTER_WORDS, COUNTERS = 16, 1 << 16

#: Ends of pieces become line feeds, tabs become blanks, A-Z lower case.
_CLEAN = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> Iterator[bytes]:
    """Words of an UTF-8 text, A-Z in lower case, and a line feed after each piece."""
    return filter(None, (text.translate(_CLEAN) + b"\n").replace(b"\n", b" \n ").split(b" "))


def rows_in_order(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` ordered by the ``DEPTH`` symbols from there on (past the end: 0)."""

    def ahead(of: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate((of[by:], np.zeros(min(by, len(of)), np.int64)))

    rank, length = text.astype(np.int64), 1
    while True:
        base = int(rank.max()) + 1
        key = rank * base + ahead(rank, length)
        if length == 1 and base**3 < 2**63:  # the first time three symbols at once, if they fit
            key, length = key * base + ahead(rank, 2), 3
        else:
            length *= 2
        order = np.argsort(key)
        if length >= DEPTH:
            return order
        changed = np.concatenate(([0], np.diff(key[order]) != 0))
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(changed)


def bwt(text: np.ndarray) -> np.ndarray:
    """The symbol in front of each row; a text begins and ends with 0."""
    return text[rows_in_order(text) - 1].astype(np.int32)


class _Numbers(dict):
    """Words by their number, new ones the next."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Shard:
    """Words of one language while a task reads its documents. Number 0 ends every piece."""

    def __init__(self):
        self.numbers = _Numbers({b"\n": 0})
        self.text = array("i", [0])

    def add(self, text: bytes) -> int:
        before = len(self.text)
        self.text.extend(map(self.numbers.__getitem__, tokens(text)))
        return len(self.text) - before

    def row(self, lang: str) -> pa.RecordBatch:
        # Words are numbered in byte order, so that intervals follow the order of phrases.
        words = sorted(w for w in self.numbers if w != b"\n")
        new = np.zeros(len(words) + 1, np.int32)
        new[[self.numbers[w] for w in words]] = np.arange(1, len(words) + 1)
        text = new[np.frombuffer(self.text, np.int32)]
        text = text[np.concatenate(([True], (text[1:] != 0) | (text[:-1] != 0)))]
        counts = np.bincount(text, minlength=len(words) + 1)
        return pa.RecordBatch.from_pydict({
            "lang": [lang], "words": pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
            "counts": pa.array([counts], pa.list_(pa.int64())),
            "forward": [bwt(text).tobytes()], "backward": [bwt(text[::-1]).tobytes()]})


_SHARDS = "lang string, words array<string>, counts array<long>, forward binary, backward binary"


def _indexed(shard_words: int):
    """The shards of a task's documents. A task holds words of twice a shard at most, beyond one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, _Shard] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                shard = open_shards.setdefault(lang, _Shard())
                held += shard.add(text.as_buffer().to_pybytes())
                while len(shard.text) > shard_words or held > 2 * shard_words:
                    full = lang if len(shard.text) > shard_words else max(open_shards, key=lambda s: len(open_shards[s].text))
                    done = open_shards.pop(full)
                    held -= len(done.text) - 1
                    yield done.row(full)
                    shard = open_shards.setdefault(lang, _Shard())
        for lang, shard in open_shards.items():
            if len(shard.text) > 1:
                yield shard.row(lang)

    return run


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _word_hashes(lang: str, words: list[str]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode(), seed) for w in words), np.uint64, len(words))


class Filter:
    """A Bloom filter (two bits per entry) over hashes: ``maybe`` holds for all that were put in."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), np.bool_)
        for place in _places(hashes, len(self.bits) * 64):
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def _places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size - 1)
    return _mixed(hashes) & mask, _mixed(hashes + _STEP) & mask


def _phrase_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from those of their words, one array per word."""
    h = parts[0]
    for part in parts[1:]:
        h = _mixed(h) * _STEP + part
    return h


def frequent_filter(frequent: DataFrame) -> Filter:
    """The filter of written phrases (lang, phrase) of one or two words. Its size follows their
    number up to ``MOST_BITS``; bits are combined by tasks, so the driver gets at most those."""
    size, needed = 1 << 10, min(MOST_BITS, FILTER_BITS * frequent.count())
    while size < needed:
        size *= 2

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                each = _word_hashes(lang, phrase.split(" "))
                hashes.append(_phrase_hashes([each[k:k + 1] for k in range(len(each))])[0])
            places = np.concatenate(_places(np.array(hashes, np.uint64), size))
            word, value = places >> np.uint64(6), np.uint64(1) << (places & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))],
                                             names=["word", "value"])

    found = np.zeros(size // 64, np.uint64)
    set_bits = (frequent.select("lang", "phrase").mapInArrow(bits, "word long, value long")
                .groupBy("word").agg(F.bit_or("value").alias("value")).toArrow())
    found[set_bits["word"].to_numpy()] = set_bits["value"].to_numpy().view(np.uint64)
    return Filter(found)


class Counters:
    """One bit per hashed counter of phrases, set where it reached the least count."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        place = _mixed(hashes) & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _added_up(least: int):
    """(part, bits): counters of each part, from rows (part, gaps, counts) sorted by part."""

    def bits(part: int, counters: np.ndarray) -> pa.RecordBatch:
        reached = np.packbits(counters >= least, bitorder="little").tobytes()
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bits": [reached]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counters = None, np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part, gaps, counts in zip(*batch.columns):
                if part.as_py() != now:
                    if now is not None:
                        yield bits(now, counters)
                    now, counters = part.as_py(), np.zeros(COUNTERS, np.int64)
                # Gaps lead from one counter to the next, so no counter occurs twice in a row.
                places = np.cumsum(np.frombuffer(gaps.as_buffer(), np.uint16), dtype=np.int64)
                counters[places] += np.frombuffer(counts.as_buffer(), np.uint8)
        if now is not None:
            yield bits(now, counters)

    return run


@dataclass(frozen=True)
class Intervals:
    """Phrases of one length in a shard: ``low`` is a phrase's first row in the text's index, ``back``
    its first row in that of the reversed text, ``count`` its rows in either, ``words`` its numbers."""

    low: np.ndarray
    back: np.ndarray
    count: np.ndarray
    words: np.ndarray


class Index:
    """Both indexes of a shard. ``before`` has the symbol in front of each row and ``last`` the row
    that starts there; ``behind`` and ``next`` are the same of the reversed text."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, symbols: int):
        self.before, self.behind = forward, backward
        self.first = np.concatenate(([0], np.cumsum(np.bincount(forward, minlength=symbols)))).astype(np.int32)

    @cached_property
    def last(self) -> np.ndarray:
        return self._steps(self.before)

    @cached_property
    def next(self) -> np.ndarray:
        return self._steps(self.behind)

    def _steps(self, symbols: np.ndarray) -> np.ndarray:
        rows = np.arange(len(symbols), dtype=np.int32)
        steps = np.empty_like(rows)
        steps[np.argsort((symbols.astype(np.int64) << 32) | rows)] = rows
        return steps

    def _groups(self, low: np.ndarray, count: np.ndarray) -> np.ndarray:
        """For every row the number of the interval that it is in, or -1."""
        groups, total = np.full(len(self.before), -1, np.int32), int(count.sum())
        starts = np.cumsum(count) - count
        groups[np.repeat(low - starts, count) + np.arange(total)] = np.repeat(np.arange(len(count), dtype=np.int32), count)
        return groups

    def words(self, wanted: np.ndarray) -> Intervals:
        """Single words, of which ``wanted`` is a flag per symbol. Both indexes hold a word at the
        same rows, as they hold the same symbols."""
        numbers = np.flatnonzero(wanted).astype(np.int32)
        low = self.first[numbers]
        return Intervals(low, low.copy(), self.first[numbers + 1] - low, numbers[:, None])

    def extended(self, now: Intervals, allowed, left: bool) -> Intervals:
        """Phrases one word longer. ``allowed`` says for arrays of phrases and new symbols which to
        keep. Extending to the right is the same step with the two indexes exchanged."""
        before, step = (self.before, self.last) if left else (self.behind, self.next)
        low, back = (now.low, now.back) if left else (now.back, now.low)
        group = self._groups(low, now.count)
        rows = np.flatnonzero(group >= 0).astype(np.int32)
        if not len(rows):
            return Intervals(low, back, now.count, np.empty((0, now.words.shape[1] + 1), np.int32))
        # Symbols of each interval in order: what is smaller comes first in the other index.
        key = group[rows] * np.int64(len(self.first)) + before[rows]
        order = np.argsort(key)
        key, rows = key[order], rows[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(start, len(key))).astype(np.int32)
        of, new = np.divmod(key[start], len(self.first))
        here = np.minimum.reduceat(step[rows], start)
        interval = np.cumsum(now.count) - now.count
        other = back[of] + (start - interval[of]).astype(np.int32)
        keep = np.flatnonzero((new > 0) & allowed(of, new))
        of, new, here, other = of[keep], new[keep].astype(np.int32)[:, None], here[keep], other[keep]
        words = np.concatenate((new, now.words[of]) if left else (now.words[of], new), axis=1)
        low, back = (here, other) if left else (other, here)
        return Intervals(low, back, count[keep], words)


def _opened(shards: Iterator[pa.RecordBatch], words: Filter) -> Iterator[tuple]:
    """Of each shard: language, words, their hashes (that of number 0 first), which of them may be
    frequent, and the index."""
    for batch in shards:
        of = {c: batch.column(c) for c in batch.schema.names}
        for k in range(batch.num_rows):
            lang, names = of["lang"][k].as_py(), of["words"][k].as_py()
            hashes = np.concatenate((np.zeros(1, np.uint64), _word_hashes(lang, names)))
            wanted = np.concatenate(([False], words.maybe(hashes[1:])))
            index = Index(np.frombuffer(of["forward"][k].as_buffer(), np.int32),
                          np.frombuffer(of["backward"][k].as_buffer(), np.int32), len(names) + 1)
            yield lang, names, hashes, wanted, index


def _grown(opened: tuple, pairs, triples, longest: int) -> Iterator[Intervals]:
    """The phrases of two words, of three and so on, whose words may be frequent and whose pairs
    and triples, if given, may be. Steps to the left and to the right take turns."""
    _, _, hashes, wanted, index = opened

    def allowed(now: Intervals, left: bool):
        def check(group, new):
            ends = now.words[group, :2] if left else now.words[group, -2:]
            words = [new, *ends.T] if left else [*ends.T, new]
            ok = wanted[new]
            if pairs is not None:
                ok = ok & pairs.maybe(_phrase_hashes([hashes[w] for w in (words[:2] if left else words[-2:])]))
            if triples is not None and len(words) == 3:
                ok = ok & triples.maybe(_phrase_hashes([hashes[w] for w in words]))
            return ok

        return check

    now, left = index.words(wanted), True
    for _ in range(2, longest + 1):
        now = index.extended(now, allowed(now, left), left)
        left = not left
        yield now


def _added(words: Filter, pairs: Filter | None, length: int, size: int):
    """(part, gaps, counts): for each shard and part of the counters what its phrases of ``length``
    words add to them. A shard adds 255 to a counter at most, which is enough for any phrase."""

    def run(shards: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for opened in _opened(shards, words):
            hashes = opened[2]
            *_, now = _grown(opened, pairs, None, length)
            place = _mixed(_phrase_hashes([hashes[w] for w in now.words.T])) & np.uint64(size - 1)
            place, of = np.unique(place.astype(np.int64), return_inverse=True)
            count = np.minimum(np.bincount(of, now.count, len(place)), 255).astype(np.uint8)
            part = place // COUNTERS
            start = np.flatnonzero(np.diff(part, prepend=-1))
            rows = []
            for a, b in zip(start, np.append(start[1:], len(place))):
                gaps = np.diff(place[a:b] % COUNTERS, prepend=0).astype(np.uint16)
                rows.append({"part": int(part[a]), "gaps": gaps.tobytes(), "counts": count[a:b].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("gaps", pa.binary()), ("counts", pa.binary())]))

    return run


def large_counters(shards: DataFrame, words: Filter, pairs: Filter | None, length: int, total: int, least: int) -> Counters:
    """The counters of phrases of ``length`` words that reach ``least``. There is one for every
    ``COUNTER_WORDS`` of the ``total`` words, up to ``MOST_BITS``; the driver gets one bit of each."""
    size = COUNTERS
    while size < min(MOST_BITS, total // COUNTER_WORDS):
        size *= 2
    parts = (shards.mapInArrow(_added(words, pairs, length, size), "part int, gaps binary, counts binary")
             .repartition("part").sortWithinPartitions("part").mapInArrow(_added_up(min(least, 255)), "part int, bits binary"))
    bits = np.zeros(size // 8, np.uint8)
    for part, reached in zip(*written(parts.hint("rebalance"), "counters", SHARDS_AT_ONCE).toArrow().columns):
        at = part.as_py() * COUNTERS // 8
        bits[at:at + COUNTERS // 8] = np.frombuffer(reached.as_buffer(), np.uint8)
    return Counters(bits)


def _counts(words: Filter, pairs: Filter | Counters, triples: Counters | None, most_held: int = MOST_HELD):
    """(lang, phrase, n): all phrases of two words that may be frequent, or with ``triples`` those of
    three and more. A task adds up the counts of its shards, of ``most_held`` phrases and those of one
    shard and length at most, and then hands them over."""

    def rows(held: dict[str, dict[str, int]]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            phrases, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
            for at in range(0, len(phrases), 20_000):
                part = phrases[at:at + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part), pa.array(n[at:at + 20_000])], names=["lang", "phrase", "n"])

    def run(shards: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {}
        for opened in _opened(shards, words):
            lang, names = opened[:2]
            for now in _grown(opened, pairs, triples, 2 if triples is None else LONGEST):
                if triples is not None and now.words.shape[1] < 3:
                    continue
                counts = held.setdefault(lang, {})
                for at in range(0, len(now.count), 20_000):
                    for row, n in zip(now.words[at:at + 20_000].tolist(), now.count[at:at + 20_000].tolist()):
                        phrase = " ".join([names[w - 1] for w in row])
                        counts[phrase] = counts.get(phrase, 0) + n
                if sum(map(len, held.values())) >= most_held:
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    return run


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                     least: int = LEAST, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of 1 to ``LONGEST`` words with n >= ``least``, and
    (lang, total) with the number of words, both written.

    Null languages count as `und`; null and empty texts have no words. Phrases lie within
    pieces, and overlapping occurrences all count. Other columns are not read. An empty
    table gives empty results.
    """
    given = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    # Fewer, longer tasks make fuller shards and hand over fewer sums: as many as keep the cores busy, however much there is.
    tasks = TASKS_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism
    shards = written(given.coalesce(tasks).mapInArrow(_indexed(shard_words), _SHARDS), "shards", options=LARGE_ROWS)
    seen = shards.select("lang", F.explode(F.arrays_zip("words", F.slice("counts", 2, 2**31 - 1).alias("n"))).alias("w"))
    totals = shards.select("lang", F.expr("aggregate(counts, 0L, (a, c) -> a + c) - counts[0]").alias("total"))
    totals = written(totals.groupBy("lang").agg(F.sum("total").alias("total")).filter("total > 0"), "totals")
    schema = "lang string, phrase string, n long"
    dealt = shards.coalesce(tasks)

    def summed(counted: DataFrame, label: str) -> DataFrame:
        # Little is left of many partitions, so that it is dealt anew by its size instead of written as a tiny file of each.
        sums = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        return written(sums.hint("rebalance"), label, SHARDS_AT_ONCE)

    words = summed(seen.select("lang", F.col("w.words").alias("phrase"), "w.n"), "words")
    word_filter = frequent_filter(words)
    total = totals.agg(F.sum("total")).first()[0] or 0
    pair_counters = large_counters(shards, word_filter, None, 2, total, least)
    pairs = summed(dealt.mapInArrow(_counts(word_filter, pair_counters, None), schema), "pairs")
    pair_filter = frequent_filter(pairs)
    triple_counters = large_counters(shards, word_filter, pair_filter, 3, total, least)
    longer = summed(dealt.mapInArrow(_counts(word_filter, pair_filter, triple_counters), schema), "longer")
    found = words.unionByName(pairs).unionByName(longer)
    return found.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), "n"), totals


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(18,0)")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
                 best: int = BEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases.

    ``score`` is floor(1000 * a * n / (l * r)) for the cut of a phrase (a occurrences) into
    parts (l and r occurrences) that scores lowest, of equal ones the first. Phrases that
    always stand within one longer candidate are left out. Ties order by occurrences, then
    by the phrase's UTF-8 bytes. Counts are exact up to 10^18, products up to 10^38.
    """
    found, totals = frequent_phrases(docs, lang_col, text_col, least, shard_words)
    of = F.split("phrase", " ")
    longer = found.filter("size > 2")
    inner = [longer.select("lang", F.array_join(F.slice(of, start, F.size(of) - 1), " ").alias("phrase"), "n") for start in (1, 2)]
    widest = inner[0].unionByName(inner[1]).groupBy("lang", "phrase").agg(F.max("n").alias("widest"))
    kept = (found.filter("size > 1").join(widest, ["lang", "phrase"], "left")
            .filter("widest is null or widest < n").select("lang", "phrase", "size", F.col("n").alias("a")))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(of, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(of, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    part = found.filter(F.col("size") < LONGEST)
    scored = (cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
              .join(part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
              .join(totals.withColumnRenamed("total", "n"), "lang"))
    scored = scored.withColumns({f"_{c}": _exact(c) for c in "anlr"}).withColumn(
        "score", F.expr("cast(1000 as decimal(4,0)) * _a * _n div (_l * _r)"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    numbered = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return numbered.filter(F.col("rank") <= best).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, row_number() over () as piece, unnest(string_split_regex(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece_text
    from documents
), worded as (
    select lang, list_filter(string_split_regex(piece_text, '[\x20\x09]+'), lambda w: w <> '') as w from pieces
), totals as (
    select lang, sum(len(w))::bigint as n from worded group by lang
), phrases as (
    select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase
    from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from worded, (select unnest(range(1, 6)) as m) s)
), f as (
    select lang, m, phrase, count(*) as a from phrases group by lang, m, phrase having count(*) >= 100
), widest as (
    select lang, phrase, max(a) as widest from (
        select lang, a, array_to_string(string_split(phrase, ' ')[1:m - 1], ' ') as phrase from f where m > 2
        union all
        select lang, a, array_to_string(string_split(phrase, ' ')[2:m], ' ') from f where m > 2) x
    group by lang, phrase
), cuts as (
    select f.lang, f.phrase, f.a, f.m, unnest(range(1, f.m)) as k
    from f left join widest w on w.lang = f.lang and w.phrase = f.phrase where f.m > 1 and coalesce(w.widest, 0) < f.a
), scored as (
    select c.lang, c.phrase, c.a, c.k, x.a as l, y.a as r, t.n,
           ((1000::hugeint * c.a * t.n) // (x.a::hugeint * y.a))::bigint as score
    from cuts c join f x on x.lang = c.lang and x.phrase = array_to_string(string_split(c.phrase, ' ')[1:c.k], ' ')
    join f y on y.lang = c.lang and y.phrase = array_to_string(string_split(c.phrase, ' ')[c.k + 1:c.m], ' ')
    join totals t on t.lang = c.lang
), lowest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
)
select * from (
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from lowest) x
where rank <= 2000
"""
