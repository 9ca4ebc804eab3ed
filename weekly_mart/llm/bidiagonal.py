"""Singular values and right vectors of a small square matrix by the bidiagonal qd route.

Householder reflections make the matrix bidiagonal, dqds finds its singular
values to high relative accuracy, and twisted factorisations of the squared
bidiagonal give the vectors of the largest ones. The matrix is d x d for
vectors of d numbers, whatever the number of rows it stands for.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Relative distance of eigenvalues below which vectors are made orthogonal to each other.
CLOSE = 1e-3


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor W, with matrix = U B W^T."""
    a = np.array(matrix, float)
    n = len(a)
    right = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float] | None:
        size = np.linalg.norm(x)
        if size == 0:
            return None
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        return v, 2 / float(v @ v)

    for k in range(n):
        if k < n - 1 and (h := reflector(a[k:, k])):
            v, scale = h
            a[k:, k:] -= np.outer(scale * v, v @ a[k:, k:])
        if k < n - 2 and (h := reflector(a[k, k + 1 :])):
            v, scale = h
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, scale * v)
            right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, scale * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, int]:
    """One differential qd step with a shift; the least d, and where d turned negative first (-1: nowhere)."""
    n, d = len(q), q[0] - shift
    least = d
    out_q, out_e = [0.0] * n, [0.0] * (n - 1)
    for k in range(n - 1):
        if d < 0:
            return q, e, d, k
        out_q[k] = d + e[k]
        ratio = q[k + 1] / out_q[k] if out_q[k] > 0 else 0.0
        out_e[k] = e[k] * ratio
        d = d * ratio - shift if out_q[k] > 0 else q[k + 1] - shift
        least = min(least, d)
    if d < 0:
        return q, e, d, n - 1
    out_q[n - 1] = d
    return out_q, out_e, least, -1


def _tail(q: list[float], e: list[float]) -> float:
    """Smaller eigenvalue of the last two by two block."""
    x, y, z = q[-2], e[-1], q[-1]
    half = (x + y + z) / 2
    return x * z / (half + np.sqrt(max(half * half - x * z, 0.0))) if half > 0 else 0.0


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """All singular values of a bidiagonal matrix, falling, by dqds."""
    top = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if top == 0:
        return np.zeros(len(diagonal))
    blocks = [([float(x) for x in (diagonal / top) ** 2], [float(x) for x in (above / top) ** 2], 0.0)]
    found: list[float] = []
    while blocks:
        q, e, sigma = blocks.pop()
        least, fixed = 0.0, False
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + sigma)
                break
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= (10 * EPS) ** 2 * (sigma + q[k])
                        or e[k] <= (10 * EPS) ** 2 * (sigma + q[k + 1])), None)
            if cut == n - 2:
                found.append(q.pop() + sigma)
                e.pop()
                fixed = False
                continue
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], sigma))
                q, e, fixed = q[cut + 1 :], e[cut + 1 :], False
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            # a shift is tried after one step without; where it was too large, what the step left over corrects it
            shift = min(least, _tail(q, e)) * 0.999 if fixed else 0.0
            for _ in range(4):
                new_q, new_e, least_d, bad = _transform(q, e, shift)
                if bad < 0:
                    break
                shift = max(0.0, shift + least_d) * (1 - 4 * EPS) if bad == n - 1 else shift / 4
            else:
                shift = 0.0
                new_q, new_e, least_d, _ = _transform(q, e, 0.0)
            q, e, least, fixed = new_q, new_e, least_d, True
            sigma += shift
    return top * np.sqrt(np.sort(np.array(found))[::-1])


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: E741
    """Stationary and progressive factors of L D L^T - value, and the twist at every index."""
    n = len(d)
    tiny = EPS * EPS * max(float(d.max()), value)
    plus, minus = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):
        pivot = s[k] + d[k]
        pivot = pivot if abs(pivot) > tiny else -tiny
        plus[k] = d[k] * l[k] / pivot
        s[k + 1] = plus[k] * l[k] * s[k] - value
    p[n - 1] = d[n - 1] - value
    for k in range(n - 2, -1, -1):
        pivot = d[k] * l[k] * l[k] + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        ratio = d[k] / pivot
        minus[k] = l[k] * ratio
        p[k] = p[k + 1] * ratio - value
    return plus, minus, s + p + value


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right vectors, as columns, of a bidiagonal matrix for its ``values``, which fall."""
    n = len(diagonal)
    out = np.zeros((n, len(values)))
    if n == 1 or len(values) == 0:
        return out + 1
    top = max(float(np.abs(diagonal).max()), float(np.abs(above).max(initial=0.0)))
    a = np.where(np.abs(diagonal) < EPS * top, np.copysign(EPS * top, diagonal), diagonal) / top
    d, l = a * a, above / top / a[:-1]  # noqa: E741
    squares = (values / top) ** 2
    for j, value in enumerate(squares):
        plus, minus, twist = _twisted(d, l, float(value))
        near = out[:, [i for i in range(j) if abs(squares[i] - value) <= CLOSE * max(squares[i], value)]]
        best, best_size = None, -1.0
        for r in np.argsort(np.abs(twist), kind="stable")[: max(8, 4 * near.shape[1])]:
            z = np.zeros(n)
            z[r] = 1.0
            for k in range(r - 1, -1, -1):
                z[k] = -plus[k] * z[k + 1]
            for k in range(r, n - 1):
                z[k + 1] = -minus[k] * z[k]
            z /= np.linalg.norm(z)
            for _ in range(2):
                z -= near @ (near.T @ z)
            size = np.linalg.norm(z)
            if size > best_size:
                best, best_size = z / max(size, EPS), size
            if size > 0.5:
                break
        for _ in range(2):
            best = best - near @ (near.T @ best)
        out[:, j] = best / np.linalg.norm(best)
    return out
