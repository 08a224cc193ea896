"""Whitening (op11) and centroid clustering (op12)."""

import hashlib
import itertools

import numpy as np
import pytest

from martspark.llm import bidiagonal, centroids, whitening

ROWS = "vec_id bigint, embedding array<float>, x string, cluster string, n string, component string"


@pytest.fixture(scope="module")
def make(spark):
    return lambda rows: spark.createDataFrame([(i, v, "x", "c", "n", "k") for i, v in rows], ROWS)


def odd_vectors(rng, dim, n=60):
    vectors = [(i, rng.standard_normal(dim).astype(np.float32).tolist()) for i in range(n)]
    bad = [(900, None), (901, []), (902, [None] * dim), (903, [float("nan")] * dim),
           (904, [float("inf")] * dim), (905, [0.5] * (dim - 1) + [None])]
    return vectors + bad + [(3, vectors[3][1]), (3, vectors[3][1]), (None, vectors[4][1]),
                            (77, vectors[5][1]), (78, vectors[5][1])]


def kept(rows, dim):
    return [(i, v) for i, v in rows if v and len(v) == dim
            and all(c is not None and np.isfinite(c) for c in v)]


# -- op11 ------------------------------------------------------------------

MATRICES = {
    "random": np.triu(np.random.default_rng(0).standard_normal((40, 40))),
    "rank 5 of 9": np.linalg.qr(np.vstack([np.random.default_rng(1).standard_normal((5, 9)),
                                           np.zeros((9, 9))]))[1],
    "zero": np.zeros((4, 4)), "one": np.array([[3.0]]), "identity": np.eye(6),
    "falling diagonal": np.diag(10.0 ** -np.arange(12)),
    "rising diagonal": np.diag(10.0 ** -np.arange(11, -1, -1.0)),
    "equal values": np.linalg.qr(np.diag(np.repeat([5.0, 5, 3, 1], 4)) @ np.linalg.qr(
        np.random.default_rng(2).standard_normal((16, 16)))[0])[1],
    # eigenvalues that agree to many digits though the matrix does not split
    "close pairs": np.linalg.cholesky(np.diag(np.abs(np.arange(21) - 10) + 3.0)
                                      + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
}


@pytest.mark.parametrize("name", MATRICES)
def test_right_vectors(name):
    r = MATRICES[name]
    squares, v = bidiagonal.right_vectors(r, len(r))
    want = np.linalg.svd(r, compute_uv=False)
    np.testing.assert_allclose(np.sqrt(squares), want, rtol=1e-12, atol=1e-13 * max(want[0], 1e-300))
    k = v.shape[1]
    assert k == (want > 10 * len(r) * np.finfo(float).eps * want[0]).sum()
    np.testing.assert_allclose(v.T @ v, np.eye(k), atol=1e-10)
    np.testing.assert_allclose(r.T @ (r @ v), v * squares[:k], atol=1e-13 * max(want[0], 1) ** 2)


def test_small_singular_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(0, 30, 2.0), 10.0 ** -np.arange(1, 29, 2.0)
    squares = bidiagonal.dqds(a, b)
    # the product of the values is the determinant, which is known exactly
    assert np.log(squares).sum() == pytest.approx(2 * np.log(a).sum(), abs=1e-11)


def reference(rows, dim, k):
    x = np.floor(64 * np.array([v for _, v in rows], float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = (n * fit - s) / n
    cov = z.T @ z / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ q[:, :k] / np.sqrt(e[:k]), e / e.sum()


def test_whitening(make):
    dim, rows = 20, odd_vectors(np.random.default_rng(4), 20)
    want = kept(rows, dim)
    n, deviation, white, share = reference(want, dim, 16)
    out = whitening.whiten(make(rows)).collect()
    assert len(out) == 16 * len(want)
    sign = {}
    by_row = {}
    for r in out:
        assert (r.n, r.explained) == (n, pytest.approx(share[r.component - 1], rel=1e-9))
        assert r.identity_error < 1e-9
        by_row.setdefault(r.vec_id, {}).setdefault(r.component, []).append((int(r.deviation), r.whitened))
    for j, (i, _) in enumerate(want):
        for c in range(16):
            d, w = by_row[i][c + 1][0]
            sign.setdefault(c, np.sign(w * white[j, c]))
            assert d == deviation[j]
            assert w * sign[c] == pytest.approx(white[j, c], abs=1e-8)
    assert len(by_row[3][1]) == 3


def test_whitening_merges_factors(make, monkeypatch):
    monkeypatch.setattr(whitening, "MERGED", 2)
    rows = [(i, np.random.default_rng(i).standard_normal(5).tolist()) for i in range(40)]
    n, _, white, _ = reference(rows, 5, 5)
    got = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(make(rows).repartition(7)).collect()}
    assert len(got) == 5 * len(rows)
    for (i, c), w in got.items():
        assert abs(w) == pytest.approx(abs(white[i, c - 1]), abs=1e-8)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])],
                                  [(i, [1.0, 2.0]) for i in range(5)]])
def test_whitening_without_variance(make, rows):
    out = whitening.whiten(make(rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.collect() == []


def test_whitening_constant_and_repeated_dimensions(make):
    rng = np.random.default_rng(8)
    rows = [(i, [a, 0.25, a, b]) for i, (a, b) in enumerate(rng.standard_normal((30, 2)).tolist())]
    out = whitening.whiten(make(rows)).collect()
    assert {r.component for r in out} == {1, 2}
    assert max(r.identity_error for r in out) < 1e-9


def test_whitening_uses_the_most_frequent_length(make):
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(6)] + [(50, [1.0]), (51, [1.0, 2.0, 3.0])]
    assert {r.vec_id for r in whitening.whiten(make(rows)).collect()} == set(range(6))


def test_deviation_beyond_a_long():
    y = np.array([[1 << 40, -(1 << 41)], [3, 4]])
    assert whitening._square_sums(y) == [(1 << 80) + (1 << 82), 25]


# -- op12 ------------------------------------------------------------------

def brute(rows, k, rounds, scale=1024, seed=3):
    x = [[int(np.floor(scale * float(np.float32(c)))) for c in v] for _, v in rows]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(range(len(rows)), key=lambda j: (name(rows[j][0]), x[j]))
    points = [list(x[j]) for j in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for v in x]

    for _ in range(rounds):
        a = assign()
        for c in range(len(points)):
            own = [v for v, (_, m) in zip(x, a) if m == c]
            if own:
                points[c] = [sum(col) // len(own) for col in zip(*own)]
    return sorted(((rows[j][0], c, d) for j, (d, c) in enumerate(assign())), key=str), points


@pytest.mark.parametrize("k,dim", [(8, 4), (1, 3), (200, 3)])
def test_clusters_equal_brute_force(make, k, dim):
    rows = odd_vectors(np.random.default_rng(k), dim)
    want, points = brute(kept(rows, dim), k, 10)
    assigned, got = centroids.cluster(make(rows), k=k, dim=dim)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in assigned.collect()), key=str) == want
    assert got.tolist() == points
    report = centroids.clustering_report(assigned, got).collect()
    assert len(report) == len(want)
    for r in report:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(
            ",".join(map(str, points[r.cluster])).encode()).hexdigest()


def test_no_usable_vectors(make):
    for rows in ([], [(1, None), (2, [1.0])]):
        assigned, points = centroids.cluster(make(rows))
        assert centroids.clustering_report(assigned, points).collect() == [] and len(points) == 0


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_tree_search_ties_and_pruning(leaf):
    # a grid has many equally near centroids; some centroids are equal
    grid = np.array(list(itertools.product(range(0, 40, 10), repeat=3)) * 2, np.int64)
    rows = np.random.default_rng(leaf).integers(0, 8, (400, 3)) * 5
    tree = centroids.build_tree(grid, leaf)
    name, best, measured = centroids.nearest(tree, rows)
    d = ((rows[:, None, :] - grid) ** 2).sum(axis=2)
    assert name.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()
    assert measured < 0.6 * d.size  # branches are cut off


def test_tree_search_large_numbers():
    rng = np.random.default_rng(1)
    points = rng.integers(-(1 << 26), 1 << 26, (50, 64))
    points[7] = points[40] + np.eye(64, dtype=np.int64)[0]
    rows = np.concatenate([points + rng.integers(-1, 2, points.shape), points])
    name, best, _ = centroids.nearest(centroids.build_tree(points), rows)
    d = ((rows[:, None, :] - points) ** 2).sum(axis=2)
    assert name.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()


def test_component_out_of_range(make):
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster(make([(1, [1e30, 1.0])]), dim=2)
