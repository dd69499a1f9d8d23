from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenorline.llm.merkle_manifest import FANOUT, addresses, folded, leaf_digest, levels_above, manifest, proofs, siblings, verified

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, `digest` double"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = [*row[:4], text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def parents(nodes):
    return [digest("".join(nodes[k:k + FANOUT])) for k in range(0, len(nodes), FANOUT)]


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append(parents(levels[-1]))
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % FANOUT
        out.append(("".join(level[first:at]), "".join(level[at + 1:first + FANOUT])))
        at //= FANOUT
    return out


def brute_force(rows, changed):
    """{doc_id: (leaf, subroot, root, proof, folded)}, every tree built in plain Python."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees.append((own, tree([leaf(r, r[4]) for r in own])))
    top = tree([levels[-1][0] for _, levels in trees])
    out = []
    for k, (own, levels) in enumerate(trees):
        for at, row in enumerate(own):
            way = path(levels, at) + path(top, k)
            cur = leaf(row, changed(row))
            for a, b in way:
                cur = digest(a + cur + b)
            out.append((row[0], leaf(row, row[4]), levels[-1][0], top[-1][0], digest("".join(a + b for a, b in way)), cur))
    return out


def documents(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, 0.5) for r in rows], SCHEMA)


def result(m):
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in verified(m).collect()]


def by_value(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def test_places_are_one_aligned_layout():
    for height in range(5):
        places = addresses(height)
        assert [len(level) for level in places] == [FANOUT**k for k in range(height + 1)]
        assert sorted(np.concatenate(places)) == list(range(sum(FANOUT**k for k in range(height + 1))))
    # The four levels of a full subtree are cut in half: the root and its 16 children, then
    # 256 runs of a node and its 16 leaves.
    root, upper, middle, leaves = addresses(3)
    assert list(upper) == list(range(1, 17)) and list(middle) == list(range(17, 17 + 256 * 17, 17))
    assert list(leaves[:16]) == list(range(18, 34))


def test_levels():
    assert [levels_above(n) for n in (1, 2, 16, 17, 256, 257, 4096, 4097)] == [0, 1, 1, 2, 2, 3, 3, 4]


@pytest.fixture(scope="module")
def rows():
    out = [(k, "big", "en", k % 7, f"Text {k}") for k in range(4400)]  # more than one subtree
    out += [(10_000 + k, "mid", None, None, None if k % 3 else "") for k in range(17)]
    out += [(20_000 + k, f"s{k}é", "fr", 1, "Ünï") for k in range(40)]  # as many trees of one leaf
    out += [(30_000, None, "en", 2, "no source"), (30_001, None, None, None, None), (None, "mid", "en", 1, "no id")]
    out += [(5, "mid", "en", 1, "same id"), (5, "mid", "en", 1, "other text"), (6, "", "-", -1, "x" * 100_000)]
    return out


def test_matches_trees_built_by_hand(spark, rows):
    want = brute_force(rows, lambda r: r[4])
    m = manifest(documents(spark, rows), COLUMNS, "source", "doc_id")
    got = verified(m).collect()
    assert all(r["verified"] for r in got) and len(got) == len(rows)
    assert by_value(result(m)) == by_value(want)
    assert len(m.blocks) == 2 and m.roots.count() == 44


def test_changed_rows_do_not_verify(spark, rows):
    docs = documents(spark, rows)
    text = F.when(F.col("doc_id") % 5 == 0, F.lower("text")).otherwise(F.col("text"))
    claimed = leaf_digest([F.col(c) for c in COLUMNS[:-1]] + [text])
    m = manifest(docs, COLUMNS, "source", "doc_id", claimed)
    change = lambda r: r[4].lower() if r[0] is not None and r[0] % 5 == 0 and r[4] is not None else r[4]
    assert by_value(result(m)) == by_value(brute_force(rows, change))
    wrong = {r["doc_id"] for r in verified(m).filter("not verified").collect()}
    assert wrong == {r[0] for r in rows if change(r) != r[4]} and len(wrong) > 800


def test_repeated_rows(spark):
    rows = [(1, "a", "en", 1, "x")] * 20 + [(2, "a", "en", 1, "x")]
    m = manifest(documents(spark, rows), COLUMNS, "source", "doc_id")
    assert by_value(result(m)) == by_value(brute_force(rows, lambda r: r[4]))


def test_one_row_is_its_own_root(spark):
    m = manifest(documents(spark, [(1, "a", "en", 1, "x")]), COLUMNS, "source", "doc_id")
    row = verified(m).first()
    assert row["leaf"] == row["subroot"] == row["root"] == m.root and row["proof_sha256"] == digest("")


def test_empty_table(spark):
    m = manifest(documents(spark, []), COLUMNS, "source", "doc_id")
    assert m.root is None and proofs(m).count() == 0
    assert verified(m).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_siblings_lead_to_the_root():
    place = addresses(1)
    nodes = np.zeros((17, 32), np.uint8)
    leaves = [bytes([k]) * 32 for k in range(5)]
    for k, d in enumerate(leaves):
        nodes[place[1][k]] = np.frombuffer(d, np.uint8)
    root = sha256(b"".join(leaves).hex().encode()).digest()
    for k, d in enumerate(leaves):
        assert folded(d, list(siblings(nodes, 1, 5, k))) == root
