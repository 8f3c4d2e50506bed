"""Singular values and right singular vectors of a small upper triangular matrix: Householder bidiagonalisation,
dqds for the values, twisted factorisations for the vectors.

The matrix is the ``R`` of a distributed QR: its size is the dimension of the vectors, never their number.
"""

from __future__ import annotations

import math

import numpy as np

EPS, TINY = np.finfo(float).eps, 1e-300
TOL2 = (100 * EPS) ** 2
CLOSE = 1e-5  # relative gap below which vectors of one block are found together


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``v, beta`` with ``(I - beta v v') x`` a multiple of the first unit vector."""
    v, size = x.copy(), float(np.linalg.norm(x))
    if size == 0.0:
        return v, 0.0
    v[0] += math.copysign(size, v[0])
    return v, 2.0 / float(v @ v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a, b, p``: ``r p = u B`` for orthogonal u and p; B has the diagonal a and the superdiagonal b, none negative."""
    m, n = np.array(r, float), r.shape[1]
    p = np.eye(n)
    for k in range(n):
        v, beta = _reflector(m[k:, k])
        m[k:, k:] -= beta * np.outer(v, v @ m[k:, k:])
        if k < n - 2:
            v, beta = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= beta * np.outer(m[k:, k + 1:] @ v, v)
            p[:, k + 1:] -= beta * np.outer(p[:, k + 1:] @ v, v)
    a, b = np.diag(m).copy(), np.diag(m, 1).copy()
    right = 1.0
    for k in range(n):  # signs go into the columns of u and p
        p[:, k] *= right
        left = right * math.copysign(1.0, a[k])
        if k < n - 1:
            right = left * math.copysign(1.0, b[k])
    return np.abs(a), np.abs(b), p


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with a shift: new q, new e and the sum of 1/d; None where a d is negative, that
    is, where the shift was above the smallest eigenvalue."""
    n, d = len(q), q[0] - shift
    qq, ee, inverse = [0.0] * n, [0.0] * (n - 1), 0.0
    for k in range(n - 1):
        if d < 0:
            return None
        inverse += 1.0 / d if d > TINY else math.inf
        qq[k] = d + e[k]
        ratio = q[k + 1] / qq[k] if qq[k] > 0 else 0.0
        ee[k] = e[k] * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    qq[-1] = d
    return qq, ee, inverse + (1.0 / d if d > TINY else math.inf)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), descending.

    Each step shifts by 1/trace(inverse), read off a transform without shift. That is never above the smallest
    eigenvalue (but by rounding; then the step is made without a shift), and close to it once it stands alone.
    """
    found: list[float] = []
    parts = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while parts:
        q, e, done = parts.pop()
        if len(q) > 1 and 1.5 * q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        for _ in range(60 * len(q) + 60):
            while len(q) > 1 and e[-1] <= TOL2 * (done + q[-1]):
                found.append(done + q.pop())
                e.pop()
            if len(q) == 1:
                found.append(done + q[0])
                break
            cut = next((k for k in range(len(e) - 2, -1, -1) if e[k] <= TOL2 * q[k] or e[k] <= TOL2 * done), None)
            if cut is not None:
                parts += [(q[:cut + 1], e[:cut], done), (q[cut + 1:], e[cut + 1:], done)]
                break
            plain = _sweep(q, e, 0.0)
            shift = (1.0 - 8 * EPS * len(q)) / plain[2]
            moved = _sweep(q, e, shift) if shift > EPS * EPS * done else None
            if moved is None:
                q, e = plain[0], plain[1]
            else:
                q, e, done = moved[0], moved[1], done + shift
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1]


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue: from the twisted factorisation with the smallest middle pivot."""
    n = len(a)
    q, ell = a * a, b / a[:-1]
    s, p, down, up = np.empty(n), np.empty(n), np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for k in range(n - 1):  # L+ D+ L+', from the top
        pivot = s[k] + q[k]
        down[k] = a[k] * b[k] / (pivot if pivot != 0 else TINY)
        s[k + 1] = down[k] * ell[k] * s[k] - value
    p[-1] = q[-1] - value
    for k in range(n - 2, -1, -1):  # U- D- U-', from the bottom
        pivot = b[k] * b[k] + p[k + 1]
        t = q[k] / (pivot if pivot != 0 else TINY)
        up[k] = ell[k] * t
        p[k] = p[k + 1] * t - value
    r = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def _beside(y: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The unit vector of what ``y`` has outside the columns of ``near``."""
    for _ in range(2):
        y = y - near @ (near.T @ y)
        y /= np.linalg.norm(y)
    return y


def _vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, noise: float) -> np.ndarray:
    """Orthonormal eigenvectors of B'B, one column a value; ``values`` descend. Values closer than ``CLOSE`` share
    their directions: those are made orthogonal by inverse iteration within the group. Values up to ``noise`` are
    zero to rounding: any directions orthogonal to all others will do."""
    n = len(a)
    if n == 1:
        return np.ones((1, 1))
    a = np.maximum(a, EPS * EPS * max(a.max(), b.max()))
    t = np.diag(a * a + np.concatenate([[0.0], b * b])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    out, first = np.empty((n, len(values))), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            first = k
        y = np.random.default_rng(k).standard_normal(n)
        if value <= noise:
            out[:, k] = _beside(y, out[:, :k])
        elif k == first:
            out[:, k] = _twisted(a, b, value)
        else:
            for _ in range(4):
                y = np.linalg.solve(t - (value + 4 * EPS * values[0]) * np.eye(n), _beside(y, out[:, first:k]))
            out[:, k] = _beside(y, out[:, first:k])
    return out


def right_singular(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of all singular values of ``r``, descending, and the right singular vectors of the first ``k``."""
    n = r.shape[1]
    scale = float(np.abs(r).max()) if n else 0.0
    if scale == 0.0:
        return np.zeros(n), np.eye(n)[:, :k]
    a, b, p = bidiagonalise(r / scale)
    b[b <= EPS * (a[:-1] + a[1:])] = 0.0
    ends = [*(np.flatnonzero(b == 0.0) + 1).tolist(), n]
    blocks, at = [], 0
    for end in ends:  # a zero on the superdiagonal cuts the problem in two
        blocks.append((at, end, dqds(a[at:end], b[at:end - 1])))
        at = end
    ranked = sorted(((v, at, end) for at, end, values in blocks for v in values), reverse=True)
    wanted: dict[tuple[int, int], list[float]] = {}
    for v, at, end in ranked[:k]:
        wanted.setdefault((at, end), []).append(v)
    columns = []
    for (at, end), values in wanted.items():
        z = _vectors(a[at:end], b[at:end - 1], np.array(values), ranked[0][0] * (8 * n * EPS) ** 2)
        columns += [(v, p[:, at:end] @ z[:, j]) for j, v in enumerate(values)]
    columns.sort(key=lambda c: -c[0])
    return np.array([v for v, _, _ in ranked]) * scale * scale, np.array([c for _, c in columns]).T
