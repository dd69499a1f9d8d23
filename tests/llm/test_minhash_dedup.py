import random

import numpy as np
import pytest
from helpers import Groups, documents, jaccard, shingles

from tenorline.llm.components import connected_components
from tenorline.llm.minhash_dedup import COORDINATES, keep_one, matches_for, near_duplicates, signature
from tenorline.llm.shingles import shingle_set


def brute_force(rows):
    """(doc_id, text) -> {doc_id: component} with every pair compared."""
    ids = sorted({i for i, _ in rows})
    groups = Groups(ids)
    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                groups.tie(i, j)
    return {i: groups.find(i) for i in ids}


def family(rng, base, copies, edits):
    """Copies of ``base`` with up to ``edits`` words exchanged each."""
    out = []
    for _ in range(copies):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    prose = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    texts = [prose(rng.randint(3, 200)) for _ in range(60)]
    texts += family(rng, prose(150), 330, 5)  # one large family, over a block
    for n in (6, 20, 60, 120):
        texts += family(rng, prose(n), 12, 3)
    shared = prose(40)
    texts += [f"{shared} {prose(60)}" for _ in range(40)]  # a passage alone links nothing
    texts += [texts[3]] * 9 + [None, "", " \t\n", "One two", "one  TWO", "a b c d e", "A b\tc d e"]
    texts.append(" ".join(f"v{k}" for k in range(30_000)))
    texts.append(texts[-1] + " end")
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_matches_every_pair_compared(spark, corpus):
    want = brute_force(corpus)
    got = near_duplicates(documents(spark, corpus)).collect()
    assert len(got) == len(corpus)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t)) for i, t in corpus}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(set(want.values())) < len(corpus) - 150


def test_nulls_and_repeated_ids(spark):
    text, other = "a b c d e f g", "q r s t u v w"
    rows = [(1, text), (1, text), (2, other), (2, text), (5, other), (None, text), (None, None), (9, None), (8, "")]
    got = near_duplicates(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [
        (-1, -1, True), (-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False),
        (5, 1, False), (8, 8, True), (9, 9, True)]


def test_one_of_each_group_stays(spark):
    text = "a b c d e f g"
    docs = documents(spark, [(1, text), (1, text), (4, text), (None, text), (7, None), (8, "z")])
    kept = keep_one(docs, near_duplicates(docs))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 7, 8]


def test_empty_table(spark):
    docs = documents(spark, [])
    found = near_duplicates(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found.count() == 0 and keep_one(docs, found).count() == 0


def test_signatures_estimate_similarity():
    rng = random.Random(2)
    w = [f"t{rng.randrange(10**6)}" for _ in range(2000)]
    a, b = " ".join(w[:1800]), " ".join(w[200:])
    agree = (signature(shingle_set(a)) == signature(shingle_set(b))).mean()
    assert abs(agree - jaccard(shingles(a), shingles(b))) < 4 * (0.25 / COORDINATES) ** 0.5
    assert len(shingle_set(a)) == len(shingles(a))
    assert np.array_equal(shingle_set("A  b\tC d\ne"), shingle_set("a b c d e"))


def test_components_of_long_chains_and_hubs(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 90)] + [(500, k) for k in range(300, 480)] + [(7, 7), (None, 3), (95, 300)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(300)]
    groups = Groups({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None:
            groups.tie(a, b)
    rng.shuffle(edges)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == {
        x: groups.find(x) for a, b in edges if a is not None and a != b for x in (a, b)}


def test_matches_follow_the_similarity():
    assert [matches_for(p) for p in (80, 85, 100)] == [79, 88, COORDINATES]
    assert sorted(map(matches_for, range(50, 101))) == [matches_for(p) for p in range(50, 101)]


def test_pairs_at_the_threshold_of_four_fifths(spark):
    """4,000 pairs of 45 shingles each, 40 of them common: exactly 0.8. 200 more are just below."""
    rows = []
    for k in range(4_200):
        words = [f"w{k}x{n}" for n in range(49)]
        changed = 5 if k < 4_000 else 6
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:-changed] + [f"n{k}y{n}" for n in range(changed)]))]
    assert jaccard(shingles(rows[0][1]), shingles(rows[1][1])) == 0.8 > jaccard(shingles(rows[-2][1]), shingles(rows[-1][1]))
    got = near_duplicates(documents(spark, rows), percent=80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 if i < 8_000 else i for i, _ in rows}
