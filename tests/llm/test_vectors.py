"""Whitening and vector codes against plain computations."""

import hashlib
import math

import numpy as np
import pytest
from docflow.llm import queries as q
from docflow.llm.common import table
from docflow.llm.spectrum import Factors, Slices, leading
from docflow.llm.vector_codes import BLOCK, Part, assign, compress, hilbert_order, shortlists
from docflow.llm.whitening import whiten

DATA = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, n long, code string, error string, whitened string"


def usable(rows):
    return [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]


def plain_codes(rows, rounds=4):
    """Vector codes by comparing everything with everything, in Python's integers."""
    rows = usable(rows)
    size = -(-len(rows[0][1]) // 4)
    whole = [[math.floor(1024 * c) for c in r[1]] + [0] * (4 * size - len(r[1])) for r in rows]
    parts = [[w[p * size : (p + 1) * size] for w in whole] for p in range(4)]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:256]
    books = [[part[i] for i in order] for part in parts]

    def nearest(x, book):
        distances = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return min(zip(distances, range(len(book))))

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for x in parts[p]:
                groups.setdefault(nearest(x, books[p])[1], []).append(x)
            for k, xs in groups.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(parts[p][i], books[p]) for p in range(4)] for i in range(len(rows))]
    labels = {}
    for r, f in zip(rows, found):
        labels[r[2]] = labels.get(r[2], 0) + sum(e for e, _ in f)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(r[0], "".join("%02x" % k for _, k in f), sum(e for e, _ in f), labels[r[2]], digest) for r, f in zip(rows, found)]


def sample(seed, n, width, scale=1.0):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(7, width))
    vectors = (centers[draw.integers(0, 7, n)] + draw.normal(size=(n, width)) * 0.2) * scale
    return [(int(i), [float(np.float32(c)) for c in v], None if i % 5 == 0 else int(i % 3)) for i, v in zip(draw.permutation(n), vectors)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, "c", "e", "w") for i, v, y in rows], SCHEMA).repartition(3)


ODD = [(None, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1), (None, None, 1), (3, [], 1), (3, [1.0, None, 2.0, 2.0, 2.0, 2.0], 1),
       (3, [float("nan")] * 6, 2), (3, [float("inf")] * 6, 2)]


@pytest.mark.parametrize("rows", [
    sample(1, 500, 8), sample(2, 40, 8), sample(3, 300, 6) + ODD, sample(4, 60, 8, 1e6), sample(5, 30, 4, 1e4) + sample(5, 30, 4, 1e4),
    [(1, [2.0, 2.0, 2.0, 2.0], None)], [(i, [1.0, 0.0, -1.0, 0.5], 1) for i in range(300)],
])
def test_codes_against_all_comparisons(spark, rows):
    found = [tuple(r) for r in compress(frame(spark, rows)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, plain_codes(rows)))


def test_codes_of_the_table(spark):
    rows = [tuple(r) for r in table(spark, DATA, "embeddings").limit(400).select("vec_id", "embedding", "label").collect()]
    found = [tuple(r) for r in compress(frame(spark, rows)).collect()]
    assert sorted(found) == sorted(plain_codes(rows))
    assert q.op12_vector_codes(spark, DATA).count() == table(spark, DATA, "embeddings").count()


def test_shortlists_keep_the_nearest_and_drop_others():
    draw = np.random.default_rng(9)
    centers = draw.integers(-500, 500, (40, 4))
    members = centers[draw.integers(0, 40, 2000)] + draw.integers(-30, 30, (2000, 4))
    entries = np.concatenate([centers, centers[:3]])
    part = Part.of(members)
    assert sorted(part.place.tolist()) == list(range(2000))
    kept = shortlists(part, entries)
    assert kept.mean() < 0.2
    chosen, single = assign(part, entries)
    plain = ((part.members[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert (chosen == plain).all() and 0 < single.sum()
    assert (part.sums[0] == part.members[:BLOCK].sum(0)).all()


def test_the_curve_visits_neighbours():
    grid = np.array([(x, y) for x in range(16) for y in range(16)])
    path = grid[hilbert_order(grid)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def plain_whitening(rows):
    x = np.array([[math.floor(64 * c) + 1000000 for c in r[1]] for r in rows], object)
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, sums = len(fit), fit.sum(0)
    centred = np.array([[float(a) for a in row] for row in fit * n - sums]) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("rows", [sample(6, 400, 24), sample(7, 10, 24), sample(8, 50, 3) * 2 + [(None, [9.0, 9.0, 9.0], 0)], sample(9, 30, 5, 1e7)])
def test_whitening_against_eigh(spark, rows):
    odd = [(7, None, 0), (7, [], 0), (7, [None] * len(rows[0][1]), 0), (7, [float("inf")] * len(rows[0][1]), 0)]
    found = whiten(frame(spark, rows + odd)).collect()
    x, n, sums, values, vectors = plain_whitening(rows)
    count = min(16, sum(values > 1e-9 * values[0]))
    assert len(found) == len(rows) * count and all(r.n == n and r.identity_error <= 1e-9 for r in found)
    expected = {}
    for r, row in zip(rows, x):
        deviation = int(((row * n - sums) ** 2).sum())
        centred = (row * n - sums).astype(float) / n
        for k in range(count):
            expected.setdefault((r[0], k + 1), []).append((deviation if deviation < 1 << 63 else None, centred @ vectors[:, k] / values[k] ** 0.5))
    for k in range(1, count + 1):
        part = [r for r in found if r.component == k]
        assert np.allclose([r.explained for r in part], values[k - 1] / values.sum(), rtol=1e-9)
        assert any(
            all(any(r.deviation == d and abs(sign * r.whitened - w) < 1e-6 for d, w in expected[r.vec_id, k]) for r in part) for sign in (1, -1)
        )


def test_whitening_without_spread(spark):
    assert whiten(frame(spark, [(1, [1.0, 2.0], 0)] * 3)).count() == 0
    assert whiten(frame(spark, [(1, None, 0)])).count() == 0
    assert compress(frame(spark, [(1, None, 0)])).count() == 0
    assert whiten(spark.createDataFrame([], SCHEMA)).columns == q.op11_whitening(spark, DATA).columns


def test_whitening_of_the_table(spark):
    rows = q.op11_whitening(spark, DATA).toPandas()
    assert len(rows) == 16 * table(spark, DATA, "embeddings").count()
    assert rows.identity_error.nunique() == 1 and rows.identity_error.max() < 1e-9


def test_counts_of_eigenvalues_and_solutions():
    draw = np.random.default_rng(0)
    for size in (1, 2, 9, 30):
        a = draw.normal(size=(size, size))
        a = a + a.T
        factors, b = Factors(a, 1e-15), draw.normal(size=size)
        assert factors.above() == (np.linalg.eigvalsh(a) > 0).sum()
        assert np.allclose(factors.solve(b), np.linalg.solve(a, b))


@pytest.mark.parametrize("spectrum", [[5.0] * 4 + [1.0] * 8, [3 + 1e-12 * i for i in range(6)] + [1.0] * 6, [0.0] * 10 + [2.0, 1.0], list(range(12))])
def test_equal_and_close_eigenvalues(spectrum):
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(12, 12)))[0]
    v = turn @ np.diag(spectrum) @ turn.T
    v = (v + v.T) / 2
    values, vectors = leading(v, 6)
    expected = [e for e in sorted(spectrum, reverse=True)[:6] if e > 0]
    assert np.allclose(values, expected, atol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12) and np.allclose(v @ vectors, vectors * values, atol=1e-12)
    assert Slices(v).above(-1.0) == 12
