"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of a shifted matrix, read off the pivots of its LDLᵀ factors, says how many
eigenvalues lie above the shift. Bisection on that count gives each wanted eigenvalue an
interval of its own; Rayleigh quotient iteration converges cubically inside it, and the
counts on both sides of the result certify its number. Eigenvalues too close to be told
apart share an interval: their subspace is found by block inverse iteration, and the small
matrix it projects to, less its centre, is sliced in turn.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

EPS = np.finfo(float).eps
# Eigenvalues closer than this share of the matrix's norm are found together.
TIGHT = 1e-9
# The threshold of complete pivoting that bounds the growth of the factors.
PIVOT = (1 + 17**0.5) / 8


def inertia(a: np.ndarray) -> tuple[int, int]:
    """How many eigenvalues are negative and how many are zero, by LDLᵀ with complete pivoting."""
    a, negative = a.copy(), 0
    while len(a):
        sizes = np.abs(a)
        diagonal = sizes.diagonal()
        i = int(diagonal.argmax())
        r, s = np.unravel_index(int(sizes.argmax()), a.shape)
        if not sizes[r, s]:
            return negative, len(a)
        if diagonal[i] >= PIVOT * sizes[r, s]:
            rest = np.delete(np.arange(len(a)), i)
            negative += a[i, i] < 0
            column = a[rest, i]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / a[i, i])
        else:
            # The largest entry lies off the diagonal: such a block has one value of each sign.
            pair, rest = np.array([r, s]), np.delete(np.arange(len(a)), (r, s))
            negative += 1
            columns = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_(pair, pair)], columns.T)
        a = (a + a.T) / 2
    return int(negative), 0


def counts(a: np.ndarray) -> Callable[[float], int]:
    """A function from a shift to the number of eigenvalues above it."""
    known: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = len(a) - sum(inertia(a - shift * np.eye(len(a))))
        return known[shift]

    return above


def intervals(
    above: Callable[[float], int], low: float, high: float, wanted: int, tight: float
) -> Iterator[tuple[float, float]]:
    """Intervals from high to low, each with one of the ``wanted`` largest or a tight group."""
    inside = above(low) - above(high)
    if not inside or above(high) >= wanted:
        return
    if inside == 1 or high - low <= tight:
        yield low, high
        return
    middle = (low + high) / 2
    yield from intervals(above, middle, high, wanted, tight)
    yield from intervals(above, low, middle, wanted, tight)


def solved(a: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """``(a - shift) x = b``; a shift that is an eigenvalue is moved by what rounding moves it."""
    size = np.linalg.norm(a)
    for nudge in (0.0, EPS, 16 * EPS, 256 * EPS):
        try:
            x = np.linalg.solve(a - (shift + nudge * size) * np.eye(len(a)), b)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all():
            return x
    raise ArithmeticError("no solution near an eigenvalue")


def pair(a: np.ndarray, above: Callable[[float], int], low: float, high: float, floor: float):
    """The one eigenpair inside an interval, certified by counts."""
    number, start = above(low), np.random.default_rng(len(a)).standard_normal(len(a))
    for _ in range(200):
        q = start / np.linalg.norm(start)
        shift = (low + high) / 2
        for _ in range(3):
            q = solved(a, shift, q)
            q /= np.linalg.norm(q)
        best = np.inf
        while True:
            value = float(q @ a @ q)
            error = float(np.linalg.norm(a @ q - value * q))
            if not error < best / 2:
                break
            best, found = error, q
            q = solved(a, value, q)
            q /= np.linalg.norm(q)
        value, error = float(found @ a @ found), best
        margin = error + floor
        if error <= floor and above(value - margin) == number and above(value + margin) == number - 1:
            return np.array([value]), found[:, None]
        if above(shift) == number:
            low = shift
        else:
            high = shift
    raise ArithmeticError(f"eigenvalue {number} was not certified")


def group(a: np.ndarray, low: float, high: float, size: int, floor: float):
    """The eigenpairs of a tight interval: their subspace, then the small matrix inside it."""
    middle = (low + high) / 2
    q = np.linalg.qr(np.random.default_rng(len(a)).standard_normal((len(a), size)))[0]
    for _ in range(6):
        q = np.linalg.qr(solved(a, middle, q))[0]
    inner = q.T @ a @ q - middle * np.eye(size)
    inner = (inner + inner.T) / 2
    values, vectors = sliced(inner, size, floor)
    return middle + values, q @ vectors


def sliced(a: np.ndarray, wanted: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    size = float(np.linalg.norm(a))
    if size <= floor:
        return a.diagonal()[:wanted].copy(), np.eye(len(a))[:, :wanted]
    above, values, vectors = counts(a), [], []
    for low, high in intervals(above, -1.01 * size, 1.01 * size, wanted, max(TIGHT * size, floor)):
        inside = above(low) - above(high)
        found = pair(a, above, low, high, floor) if inside == 1 else group(a, low, high, inside, floor)
        values.append(found[0])
        vectors.append(found[1])
    return np.concatenate(values)[:wanted], np.concatenate(vectors, axis=1)[:, :wanted]


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues in falling order, and their unit vectors as columns.

    A vector's largest entry is positive, so the signs do not depend on the way there.
    """
    wanted, centre = min(wanted, len(a)), float(np.mean(a.diagonal()))
    floor = 8 * len(a) * EPS * float(np.linalg.norm(a))
    values, vectors = sliced(a - centre * np.eye(len(a)), wanted, floor)
    values, (vectors, upper) = values + centre, np.linalg.qr(vectors)
    vectors *= np.where(upper.diagonal() < 0, -1.0, 1.0)
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(wanted)] < 0, -1.0, 1.0)
