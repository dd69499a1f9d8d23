import math

import numpy as np
import pytest
from helpers import Groups

from tenorline.llm.itq_neighbours import learn, near_vectors, plan
from tenorline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node long, keys string"


def brute_force(rows, cosine=0.98):
    """vec_id -> (links, component), every pair of a label compared."""
    ids, links, groups = [r[0] for r in rows], {}, Groups([r[0] for r in rows])
    for label in {r[2] for r in rows}:
        own = [(i, np.array(v, np.float32).astype(float)) for i, v, x in rows
               if x == label and x is not None and v and None not in v and np.isfinite(v).all() and any(v)]
        for size in {len(v) for _, v in own}:
            part = [(i, v) for i, v in own if len(v) == size]
            x = np.stack([v / np.linalg.norm(v) for _, v in part])
            near = x @ x.T >= cosine
            np.fill_diagonal(near, False)
            for k, (i, _) in enumerate(part):
                links[i] = int(near[k].sum())
                for j in np.flatnonzero(near[k]):
                    if groups.find(i) != groups.find(part[j][0]):
                        groups.tie(i, part[j][0])
    return {i: (links.get(i, 0), groups.find(i)) for i in ids}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    vectors = list(rng.standard_normal((300, 32)))
    for size, noise in ((700, 0.018), (40, 0.02), (15, 0.03)):  # one group larger than a block
        centre = rng.standard_normal(32)
        centre /= np.linalg.norm(centre)
        vectors += [centre + noise * rng.standard_normal(32) for _ in range(size)]
    vectors += [vectors[0]] * 60
    rng.shuffle(vectors)
    out = [(k, [float(x) for x in np.array(v, np.float32)], k % 3 if k % 5 else 1) for k, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 32, [1.0] * 31 + [None], [1.0] * 31 + [math.nan], [1.0] * 31 + [math.inf],
           [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0], [1.0, 0.0]]
    out += [(10_000 + k, v, 1) for k, v in enumerate(odd)]
    return out + [(20_000, out[0][1], None), (20_001, out[0][1], None)]


def test_against_every_pair(spark, rows):
    want = brute_force(rows)
    got = near_vectors(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    found, all_links = sum(r["n_links"] for r in got), sum(n for n, _ in want.values())
    assert all(r["n_links"] <= want[r["vec_id"]][0] for r in got)
    assert found >= 0.999 * all_links > 100_000
    if found == all_links:
        assert {r["vec_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_query_against_every_pair(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_force(rows)
    got = QUERIES["op5_itq_neighbours"](spark, sf).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want


def test_repeated_rows_and_empty_tables(spark):
    got = near_vectors(frame(spark, [(7, [1.0, 2.0], 1)] * 2 + [(3, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)])).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in got) == [
        (-1, 0, -1, True), (3, 2, 3, True), (7, 2, 3, False), (7, 2, 3, False)]
    assert near_vectors(frame(spark, [])).count() == 0


def test_rotations_balance_the_bits_and_lower_the_loss():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 16)) * np.linspace(0.1, 2, 16)
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes, random = learn(x, 8, 2), learn(x, 8, 2, rounds=0)

    def loss(m):
        v = (x - codes.centre) @ m
        return ((np.sign(v) - v) ** 2).sum()

    assert loss(codes.matrices[0]) < loss(random.matrices[0])
    assert np.allclose(codes.matrices[0].T @ codes.matrices[0], np.eye(16))
    ones = ((x - codes.centre) @ codes.matrices[0] > 0).mean(axis=0)
    assert (abs(ones - 0.5) < 0.2).all()


def test_plan_grows_with_the_logarithm():
    bits = [plan(10**k)[0] for k in range(2, 10)]
    assert bits == sorted(bits) and bits[-1] < 32
    for n in (10**3, 10**6, 10**9):
        b, tables = plan(n)
        assert (1 - (1 - math.acos(0.98) / math.pi) ** b) ** tables <= 1e-4


@pytest.mark.parametrize("norm", [0.0, 0.9, 0.95])
def test_recall_of_links_at_the_threshold(norm):
    """Vectors about a common direction, whose unit vectors have a mean of that norm: pairs just above
    the least cosine are found by the tables that the sample asks for."""
    from tenorline.llm.itq_neighbours import learn_for
    rng = np.random.default_rng(6)

    def unit(x):
        return x / np.linalg.norm(x, axis=1)[:, None]

    def drawn(n):
        x = unit(rng.standard_normal((n, 64)))
        x *= np.sqrt(1 - norm * norm)
        x[:, 0] += norm
        return unit(x)

    codes = learn_for(drawn(2000), 50_000)
    x = drawn(3000)
    aside = rng.standard_normal(x.shape)
    aside = unit(aside - (aside * x).sum(axis=1)[:, None] * x)
    y = 0.9801 * x + np.sqrt(1 - 0.9801**2) * aside
    found = (codes.substrings(x) == codes.substrings(y)).any(axis=1)
    assert found.mean() >= 0.999
