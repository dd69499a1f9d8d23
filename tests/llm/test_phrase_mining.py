import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tenorline.llm import shared
from tenorline.llm.phrase_mining import (
    Filter, Index, _counts, _indexed, _places, bwt, collocations, frequent_phrases, rows_in_order, tokens,
)

SCHEMA = "doc_id long, lang string, text string, n long, phrase string, words string, `rank` double"


def documents(spark, rows):
    return spark.createDataFrame([(k, lang, text, k, "x", "y", 0.5) for k, (lang, text) in enumerate(rows)], SCHEMA)


def split(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered) if (w := re.findall(r"[^\x20\x09]+", p))]


def counted(rows):
    """(Counter of (lang, words), Counter of words per language)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        for w in split(text):
            n[lang or "und"] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang or "und", tuple(w[i:i + m])] += 1
    return f, n


def brute_force(rows, least, best):
    f, n = counted(rows)
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for lang in n:
        scored = []
        for (of, p), a in found.items():
            if of != lang:
                continue
            inside = lambda q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(o == lang and len(q) > len(p) and b >= a and inside(q) for (o, q), b in found.items()):
                continue
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    word = lambda: rng.choice("aa bb cc dd éé ff gg hh".split()) if rng.random() < 0.8 else f"w{rng.randrange(300)}"
    out = []
    for k in range(120):
        parts = []
        for _ in range(rng.randint(1, 40)):
            parts.append(rng.choice(["New  York\tCity", "to be or not to", "x x x x x x", word(), word(), word()]))
        out.append((rng.choice(["en", "en", "en", "fr", None]), rng.choice([" ", " ", ", ", "\n"]).join(parts)))
    out += [("en", None), ("en", ""), ("de", " \t,.!"), ("und", "to be or not"), ("fr", "q " * 3000), ("zz", "alone")]
    return out


@pytest.mark.parametrize("shard_words", [60, 1 << 20])
def test_matches_all_phrases_counted(spark, rows, shard_words):
    got = collocations(documents(spark, rows), least=6, best=25, shard_words=shard_words).collect()
    want = brute_force(rows, 6, 25)
    assert sorted(tuple(r) for r in got) == want
    assert len(want) > 40 and max(r[1] for r in want) == 25


def test_frequent_phrases_and_totals(spark, rows):
    found, totals = frequent_phrases(documents(spark, rows), least=6, shard_words=500)
    f, n = counted(rows)
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in found.collect()} == {k: a for k, a in f.items() if a >= 6}
    assert {r["lang"]: r["total"] for r in totals.collect()} == n


def test_empty_table(spark):
    got = collocations(documents(spark, []))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_products_beyond_64_bits(spark):
    from tenorline.llm.phrase_mining import _exact
    a, n, left, right = 10**16 + 7, 10**18 - 11, 10**17 + 9, 3 * 10**17 + 1
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").withColumns(
        {f"_{c}": _exact(c) for c in "anlr"}).selectExpr("cast(1000 as decimal(4,0)) * _a * _n div (_l * _r) as score").first()
    assert row["score"] == 1000 * a * n // (left * right)


def test_tokens():
    want = [b"ab", b"c", b"d", b"\n", "É".encode(), b"\n", b"\n", b"\n", b"\n", b"\n", b"x", b"\n", b"y", b"\n"]
    assert list(tokens("Ab\tC  d,É!\r\n..x\x0by".encode())) == want


def test_intervals_move_together():
    rng = np.random.default_rng(1)
    text = np.concatenate(([0], rng.integers(0, 5, 400), [0])).astype(np.int32)
    index = Index(bwt(text), bwt(text[::-1].copy()), 5)
    rows, reverse = rows_in_order(text), rows_in_order(text[::-1].copy())
    now = index.words(np.array([False, True, True, True, True]))
    for left in (False, True, True, False):
        now = index.extended(now, lambda g, s: np.ones(len(g), bool), left)
        occurrences = Counter(tuple(text[i:i + now.words.shape[1]]) for i in range(len(text) - now.words.shape[1] + 1))
        want = {p: c for p, c in occurrences.items() if 0 not in p}
        assert {tuple(w): c for w, c in zip(now.words.tolist(), now.count)} == want
        for w, low, back, count in zip(now.words, now.low, now.back, now.count):
            assert all((text[i:i + len(w)] == w).all() for i in rows[low:low + count])
            assert all((text[::-1][i:i + len(w)] == w[::-1]).all() for i in reverse[back:back + count])


def test_filter_holds_all_that_was_put_in():
    hashes = np.random.default_rng(2).integers(0, 2**63, 5000).astype(np.uint64)
    bits = np.zeros(1 << 11, np.uint64)
    for place in _places(hashes, len(bits) * 64):
        np.bitwise_or.at(bits, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    other = np.random.default_rng(4).integers(0, 2**63, 5000).astype(np.uint64)
    assert Filter(bits).maybe(hashes).all() and Filter(bits).maybe(other).mean() < 0.05


class _All:
    def maybe(self, hashes):
        return np.ones(len(hashes), bool)


def test_a_task_hands_over_each_phrase_once(rows):
    texts = pa.RecordBatch.from_pydict({"lang": [lang or "und" for lang, _ in rows], "text": [text for _, text in rows]})
    shards = list(_indexed(60)([texts]))
    assert len(shards) > 50
    f, _ = counted(rows)
    for triples, sizes in ((None, (2,)), (_All(), (3, 4, 5))):
        want = {(lang, " ".join(p)): n for (lang, p), n in f.items() if len(p) in sizes}
        got = [tuple(r.values()) for b in _counts(_All(), _All(), triples)(iter(shards)) for r in b.to_pylist()]
        assert len(got) == len(want) and {r[:2]: r[2] for r in got} == want


def test_counts_handed_over_early_add_up(rows):
    texts = pa.RecordBatch.from_pydict({"lang": [lang or "und" for lang, _ in rows], "text": [text for _, text in rows]})
    sums, batches = Counter(), 0
    for b in _counts(_All(), _All(), _All(), most_held=100)(_indexed(60)([texts])):
        batches += 1
        for r in b.to_pylist():
            sums[r["lang"], tuple(r["phrase"].split(" "))] += r["n"]
    f, _ = counted(rows)
    assert batches > 10 and sums == {k: n for k, n in f.items() if len(k[1]) > 2}


def test_shards_are_written_in_small_pages_and_row_groups(spark, tmp_path, monkeypatch):
    texts = spark.range(0, 48, 1, 1).selectExpr(
        "'en' as lang", "array_join(transform(sequence(1, 60000), k -> hash(id, k) % 5000), ' ') as text")
    monkeypatch.setattr(shared, "shared_path", lambda _, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    frequent_phrases(texts, least=10**9, shard_words=50_000)
    [file] = tmp_path.glob("shards-*/*.parquet")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(str(file))
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
    groups = list(reader.getFooter().getBlocks())
    assert sum(g.getRowCount() for g in groups) == 48
    assert len(groups) > 1 and max(g.getCompressedSize() for g in groups) < 10 << 20
    for group in groups:
        for column in group.getColumns():
            if column.getPath().toDotString() in ("forward", "backward"):
                assert column.getStatistics().isEmpty()
                # A row is 240 kB, a page at most 1 MB and the row that reaches it.
                assert reader.readOffsetIndex(column).getPageCount() >= group.getRowCount() / 6
    reader.close()


def test_tables_are_written_in_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_path", lambda _, label: f"{tmp_path}/{label}-{len(list(tmp_path.iterdir()))}")
    # Spark by itself keeps the partitions of a shuffle that were large before the filter.
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        words = spark.range(0, 400, 1, 100).selectExpr(
            "'en' as lang", "concat('x y z ', array_join(transform(sequence(1, 2000), k -> concat('w', hash(id, k))), ' ')) as text")
        found, _ = frequent_phrases(words, least=100)
        assert {r["phrase"]: r["n"] for r in found.collect()} == {p: 400 for p in ("x", "y", "z", "x y", "y z", "x y z")}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {d.name.split("-")[0]: len(list(d.glob("*.parquet"))) for d in tmp_path.iterdir()}
    assert files["shards"] <= 2 * spark.sparkContext.defaultParallelism
    assert max(files[t] for t in ("words", "pairs", "longer", "counters")) <= 2
