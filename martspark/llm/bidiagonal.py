"""Singular values and right singular vectors of a small triangular matrix.

Householder reflections make it bidiagonal; dqds (differential quotient
difference with shifts) finds the squared singular values, the small ones as
accurately as the large ones; twisted factorisations give a vector for each.
Plain numpy on a matrix as wide as the data has dimensions.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TOL2 = (10 * EPS) ** 2
CLOSE = 1e-5  # relative gap below which vectors are found together


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit h with (I - 2hh')x along the first axis; None if x is zero there already."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0.0 or not x[1:].any():
        return None
    h = x / scale
    h[0] += np.copysign(np.linalg.norm(h), h[0])
    return h / np.linalg.norm(h)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of U'RV = B."""
    a, d = r.astype(float).copy(), r.shape[1]
    v = np.eye(d)
    for k in range(d):
        h = _reflector(a[k:, k])
        if h is not None:
            a[k:, k:] -= np.outer(2 * h, h @ a[k:, k:])
        h = _reflector(a[k, k + 1:]) if k + 2 < d else None
        if h is not None:
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ h, 2 * h)
            v[:, k + 1:] -= np.outer(v[:, k + 1:] @ h, 2 * h)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _transform(q: list, e: list, shift: float) -> tuple[list, list, list]:
    """One dqds step: the qd array of the matrix less ``shift``, and its pivots d."""
    d, pivots, q2, e2 = q[0] - shift, [q[0] - shift], [], []
    for i in range(len(e)):
        top = d + e[i]
        t = q[i + 1] / top if top else 0.0
        q2.append(top)
        e2.append(e[i] * t)
        d = (d * t if top else q[i + 1]) - shift
        pivots.append(d)
    return [*q2, d], e2, pivots


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling.

    Each turn makes a step without a shift, whose pivots d bound the smallest
    value from below by 1 / sum(1/d), and a step shifted by that bound.
    """
    found = []
    parts = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    turns = 200 * len(diagonal) + 200  # far more than it takes
    while parts:
        q, e, sigma = parts.pop()
        while q:
            if not (turns := turns - 1):
                raise RuntimeError("dqds: no convergence")
            cut = next((i for i in range(len(e) - 1, -1, -1)
                        if e[i] <= TOL2 * (sigma + (q[-1] if i == len(e) - 1 else 0.0))), None)
            if len(q) == 1 or cut == len(e) - 1:
                found.append(max(0.0, q.pop() + sigma))
                if e:
                    e.pop()
                continue
            if cut is not None:  # two matrices
                parts.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1] / 2:  # graded the slow way round
                q, e = q[::-1], e[::-1]
            q, e, d = _transform(q, e, 0.0)
            if min(d) <= 0.0:  # singular: the zero has moved to the end
                continue
            with np.errstate(over="ignore", divide="ignore"):
                shift = float(1 / np.sum(1 / np.array(d)))
            while shift > 0.0:
                q2, e2, d = _transform(q, e, shift)
                if min(d) >= 0.0:
                    q, e, sigma = q2, e2, sigma + shift
                    break
                shift = shift * 0.75 if shift > TOL2 * sigma else 0.0
    return np.sort(np.array(found))[::-1]


def _twisted(a: np.ndarray, b: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """One unit vector per eigenvalue of B'B (columns).

    Top-down and bottom-up factorisations of B'B - lam meet at the twist with
    the smallest pivot; the vector is solved outwards from there.
    """
    q, e, ab, n = a * a, b * b, a[:len(b)] * b, len(a)
    tiny = EPS * EPS * np.maximum(lam, np.finfo(float).tiny)
    off_zero = lambda x: np.where(x == 0.0, tiny, x)
    s, p = np.empty((n, len(lam))), np.empty((n, len(lam)))
    down, up = np.empty((n - 1, len(lam))), np.empty((n - 1, len(lam)))
    s[0] = -lam
    for i in range(n - 1):
        pivot = off_zero(s[i] + q[i])
        down[i] = ab[i] / pivot
        s[i + 1] = e[i] * (s[i] / pivot) - lam
    p[-1] = q[-1] - lam
    for i in range(n - 2, -1, -1):
        pivot = off_zero(e[i] + p[i + 1])
        up[i] = ab[i] / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - lam
    twist = np.argmin(np.abs(s + p + lam), axis=0)
    z = np.zeros((n, len(lam)))
    z[twist, np.arange(len(lam))] = 1.0
    for i in range(n - 2, -1, -1):
        z[i] = np.where(i < twist, -down[i] * z[i + 1], z[i])
    for i in range(n - 1):
        z[i + 1] = np.where(i >= twist, -up[i] * z[i], z[i + 1])
    return z / np.linalg.norm(z, axis=0)


def _together(a: np.ndarray, b: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of eigenvalues that hardly differ: inverse iteration on a block."""
    t = np.diag(a * a) + np.diag(a[:len(b)] * b, 1) + np.diag(a[:len(b)] * b, -1)
    t[np.arange(1, len(a)), np.arange(1, len(a))] += b * b
    scale = max(np.abs(t).max(), np.finfo(float).tiny)
    m = t - (lam.mean() + 4 * EPS * scale) * np.eye(len(a))
    z = np.random.default_rng(5).standard_normal((len(a), len(lam)))
    for _ in range(4):
        z = np.linalg.qr(np.linalg.solve(m, z))[0]
    return z @ np.linalg.eigh(z.T @ t @ z)[1][:, ::-1]  # one vector per value, falling


def right_vectors(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of ``r``, falling, and the vectors (columns) of the
    first ``count`` that differ from zero."""
    a, b, v = bidiagonalise(r)
    lam = dqds(a, b)
    zero = (10 * len(a) * EPS) ** 2 * lam[0] if len(lam) else 0.0
    some = lam[:count][lam[:count] > zero]
    if not len(some):
        return lam, np.empty((len(a), 0))
    # close values are told apart among all, so that none loses its neighbour
    used = lam[lam > zero]
    group = np.concatenate([[0], np.cumsum(used[:-1] - used[1:] > CLOSE * used[:-1])])
    z = _twisted(a, b, used) if len(a) > 1 else np.ones((1, len(used)))
    for g in np.unique(group[:len(some)]):
        at = np.flatnonzero(group == g)
        if len(at) > 1:
            z[:, at] = _together(a, b, used[at])
    return lam, v @ z[:, :len(some)]
