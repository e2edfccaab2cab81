"""Singular values and right vectors of a small matrix: Householder bidiagonal form, dqds, twisted factorisations.

The matrix is as wide as an embedding, so this is the part that does not grow with the data.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = 1e-300
#: Squares below this share of their neighbours are zero to double precision.
NEGLIGIBLE = (16 * EPS) ** 2
#: Eigenvalues closer than this, relative to their size, get a representation of their own.
CLUSTER = 1e-3
DEEPEST = 8


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and V, with ``matrix = U B V'``."""
    work, size = np.array(matrix, np.float64), matrix.shape[1]
    v = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0:
            return None
        u = x / norm
        u[0] += math.copysign(1.0, u[0])
        return u / np.linalg.norm(u)

    for k in range(size):
        u = reflector(work[k:, k].copy())
        if u is not None:
            work[k:, k:] -= 2 * np.outer(u, u @ work[k:, k:])
        if k + 2 <= size - 1:
            u = reflector(work[k, k + 1 :].copy())
            if u is not None:
                work[k:, k + 1 :] -= 2 * np.outer(work[k:, k + 1 :] @ u, u)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diagonal(work).copy(), np.diagonal(work, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd transform, or None if the shift passed the smallest eigenvalue."""
    new_q, new_e, d = [], [], q[0] - shift
    for k, off in enumerate(e):
        if d < 0:
            return None
        top = d + off
        ratio = q[k + 1] / top if top > 0 else 1.0
        new_q.append(top)
        new_e.append(off * ratio)
        d = d * ratio - shift
    if not d >= 0:
        return None
    return [*new_q, d], new_e


def _last_pair(q: list[float], e: list[float]) -> float:
    """Smaller eigenvalue of the last two rows."""
    a, b, c = q[-2], e[-1], q[-1]
    if len(e) > 1:
        a, b, c = q[-2] + e[-2], q[-2] * e[-1], q[-1] + e[-1]
        half, prod = (a + c) / 2, a * c - b
    else:
        half, prod = (a + b + c) / 2, a * c
    return prod / (half + math.sqrt(max(half * half - prod, 0.0))) if half > 0 else 0.0


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B, falling, from the squares of B's diagonals; each to high relative accuracy."""
    found, parts = [], [(list(q), list(e), 0.0)]
    while parts:
        q, e, sigma = parts.pop()
        while len(q) > 1:
            if e[-1] <= NEGLIGIBLE * (sigma + q[-1]) or e[-1] < TINY:
                found.append(sigma + q.pop())
                e.pop()
                continue
            cut = next((k for k in range(len(e)) if e[k] <= NEGLIGIBLE * (sigma + min(q[k], q[k + 1])) or e[k] < TINY), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            guess, done = _last_pair(q, e), None
            for share in (1.0, 0.999, 0.9, 0.5, 0.1, 0.01):
                shift = guess * share
                done = _dqds_step(q, e, shift) if shift > EPS * EPS * (sigma + q[-1]) else None
                if done:
                    break
            else:
                shift, done = 0.0, _dqds_step(q, e, 0.0)
            (q, e), sigma = done, sigma + shift
        found.append(sigma + q[0])
    return sorted(found, reverse=True)


def _stationary(d: np.ndarray, l: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:  # noqa: E741
    """``LDL' - shift = L+ D+ L+'``, and the auxiliary terms."""
    n = len(d)
    plus, low, s = np.empty(n), np.empty(max(n - 1, 0)), np.empty(n)
    s[0] = -shift
    for k in range(n - 1):
        plus[k] = d[k] + s[k] or TINY
        low[k] = d[k] * l[k] / plus[k]
        s[k + 1] = low[k] * l[k] * s[k] - shift
    plus[n - 1] = d[n - 1] + s[n - 1]
    return plus, low, s


def _below(d: np.ndarray, l: np.ndarray, at: float) -> int:  # noqa: E741
    """Number of eigenvalues of LDL' below ``at``."""
    count, s = 0, -at
    for k in range(len(d) - 1):
        plus = d[k] + s or TINY
        count += plus < 0
        s = d[k] * l[k] / plus * l[k] * s - at
    return count + (d[-1] + s < 0)


def _refined(d: np.ndarray, l: np.ndarray, rank: int, guess: float, spread: float) -> float:  # noqa: E741
    """The ``rank``-th smallest eigenvalue of LDL', by bisection from a bracket around ``guess``."""
    low, high, step = guess - spread, guess + spread, spread
    while _below(d, l, low) > rank:
        step *= 4
        low -= step
    step = spread
    while _below(d, l, high) <= rank:
        step *= 4
        high += step
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high) or high - low <= 2 * EPS * max(abs(low), abs(high)):
            break
        if _below(d, l, middle) > rank:
            high = middle
        else:
            low = middle
    return (low + high) / 2


def twisted(d: np.ndarray, l: np.ndarray, value: float) -> np.ndarray:  # noqa: E741
    """Unit eigenvector of LDL': both factorisations meet where they fit best."""
    n = len(d)
    _, low, s = _stationary(d, l, value)
    p, up = np.empty(n), np.empty(max(n - 1, 0))
    p[n - 1] = d[n - 1] - value
    for k in range(n - 2, -1, -1):
        minus = d[k] * l[k] * l[k] + p[k + 1] or TINY
        ratio = d[k] / minus
        up[k] = l[k] * ratio
        p[k] = p[k + 1] * ratio - value
    gamma = np.abs(s + p + value)
    gamma[np.isnan(gamma)] = np.inf
    twist = int(np.argmin(gamma))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    z = np.nan_to_num(z, nan=0.0, posinf=1e150, neginf=-1e150)
    z /= np.abs(z).max()
    return z / np.linalg.norm(z)


def _vectors(d: np.ndarray, l: np.ndarray, values: np.ndarray, first: int = 0, depth: int = 0) -> np.ndarray:  # noqa: E741
    """Eigenvectors, as columns, of rising ``values``, of which the smallest has rank ``first`` in LDL'."""
    out, at = np.empty((len(d), len(values))), 0
    while at < len(values):
        end = at + 1
        while end < len(values) and values[end] - values[end - 1] <= CLUSTER * max(abs(values[end]), abs(values[end - 1])):
            end += 1
        if end == at + 1:
            out[:, at] = twisted(d, l, values[at])
        elif depth == DEEPEST:
            out[:, at:end] = np.column_stack([twisted(d, l, v * (1 + 4 * EPS * k)) for k, v in enumerate(values[at:end])])
        else:
            # Seen from a shift beside the cluster, its members are far apart relative to what is left of them.
            width = max(values[end - 1] - values[at], 4 * EPS * max(abs(values[end - 1]), abs(values[at])))
            sides = (values[at] - width, values[end - 1] + width)
            forms = [_stationary(d, l, side)[:2] for side in sides]
            growth = [np.abs(f[0]).max() if np.isfinite(f[0]).all() and np.isfinite(f[1]).all() else np.inf for f in forms]
            pick = int(growth[1] < growth[0])
            new_d, new_l = forms[pick]
            moved = [_refined(new_d, new_l, first + k, values[k] - sides[pick], width / 2) for k in range(at, end)]
            out[:, at:end] = _vectors(new_d, new_l, np.array(moved), first + at, depth + 1)
        if end > at + 1:
            out[:, at:end] = np.linalg.qr(out[:, at:end])[0]
        at = end
    return out


def right_vectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the singular values of a square matrix, falling, and their right vectors as columns."""
    size = matrix.shape[1]
    top = np.abs(matrix).max() if size else 0.0
    if not top:
        return np.zeros(size), np.eye(size)
    diagonal, upper, v = bidiagonalise(matrix / top)
    norm = max(np.abs(diagonal).max(), np.abs(upper).max() if size > 1 else 0.0)
    # A zero on the diagonal would leave no LDL' form; moving it by a rounding error changes nothing above that.
    diagonal = np.where(np.abs(diagonal) < EPS * norm * 1e-2, EPS * norm * 1e-2, diagonal)
    upper = np.where(np.abs(upper) <= EPS * norm * 1e-3, 0.0, upper)
    values, vectors = np.empty(size), np.zeros((size, size))
    cuts = [0, *(np.flatnonzero(upper == 0) + 1).tolist(), size]
    for start, end in zip(cuts, cuts[1:]):
        a, b = diagonal[start:end], upper[start : end - 1]
        rising = np.array(dqds((a * a).tolist(), (b * b).tolist())[::-1])
        values[start:end] = rising
        vectors[start:end, start:end] = _vectors(a * a, b / a[:-1], rising)
    order = np.argsort(-values, kind="stable")
    return values[order] * top * top, (v @ vectors)[:, order]
