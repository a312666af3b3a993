"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of the LDL-transpose factors of ``V - s`` counts the eigenvalues above ``s``. Bisection
on these counts isolates each leading eigenvalue in an interval of its own; Rayleigh
quotient iteration then converges within that interval, and two more counts, just below
and above the result, certify that it has the number it is given.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17**0.5) / 8
_EPS = np.finfo(np.float64).eps


class Factors:
    """``a = L D Lt`` up to a permutation, with blocks of one and two rows in ``D``."""

    def __init__(self, a: np.ndarray, tiny: float):
        a, size = a.copy(), len(a)
        self.order, self.lower = np.arange(size), np.eye(size)
        self.blocks: list[tuple[int, np.ndarray]] = []
        k = 0
        while k < size:
            step, swap = self._pivot(a, k)
            if swap is not None:
                self._swap(a, k, k + step - 1, swap)
            block = a[k : k + step, k : k + step].copy()
            if step == 1 and abs(block[0, 0]) < tiny:
                block[0, 0] = -tiny  # an eigenvalue at the shift itself is not above it
            self.blocks.append((k, block))
            below = a[k + step :, k : k + step]
            part = np.linalg.solve(block, below.T).T
            self.lower[k + step :, k : k + step] = part
            a[k + step :, k + step :] -= part @ below.T
            k += step

    def _pivot(self, a: np.ndarray, k: int) -> tuple[int, int | None]:
        """Rows of the next block, and the row to bring to its end."""
        column = np.abs(a[k + 1 :, k])
        if not len(column) or (most := column.max()) == 0 or abs(a[k, k]) >= _ALPHA * most:
            return 1, None
        r = k + 1 + int(column.argmax())
        row = np.abs(a[r, k:])
        row[r - k] = 0
        if abs(a[k, k]) * row.max() >= _ALPHA * most**2:
            return 1, None
        return (1, r) if abs(a[r, r]) >= _ALPHA * row.max() else (2, r)

    def _swap(self, a: np.ndarray, done: int, i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]
        self.order[[i, j]] = self.order[[j, i]]
        self.lower[[i, j], :done] = self.lower[[j, i], :done]

    def above(self) -> int:
        """The number of positive eigenvalues."""
        return sum(int((np.linalg.eigvalsh(block) > 0).sum()) for _, block in self.blocks)

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].copy()
        for k, block in self.blocks:
            end = k + len(block)
            x[end:] -= self.lower[end:, k:end] @ x[k:end]
        for k, block in self.blocks:
            x[k : k + len(block)] = np.linalg.solve(block, x[k : k + len(block)])
        for k, block in reversed(self.blocks):
            end = k + len(block)
            x[k:end] -= self.lower[end:, k:end].T @ x[end:]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Slices:
    """The counts found so far, and the eigenvectors found so far."""

    def __init__(self, v: np.ndarray):
        self.v, self.size = v, len(v)
        self.norm = float(np.abs(v).sum(1).max()) if len(v) else 0.0
        self.tiny = max(_EPS * self.norm, np.finfo(np.float64).tiny)
        self.known: dict[float, int] = {}
        self.found = np.zeros((self.size, 0))

    def factors(self, shift: float) -> Factors:
        made = Factors(self.v - shift * np.eye(self.size), self.tiny)
        self.known[shift] = made.above()
        return made

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.factors(shift)
        return self.known[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The tightest known bounds of eigenvalue ``k``."""
        low = max(s for s, n in self.known.items() if n >= k)
        return low, min(s for s, n in self.known.items() if n < k and s > low)

    def _apart(self, x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - self.found @ (self.found.T @ x)
        return x / max(np.linalg.norm(x), np.finfo(np.float64).tiny)

    def eigenpair(self, k: int) -> tuple[float, np.ndarray]:
        """Eigenvalue ``k``, from 1 by falling size, and its vector; the earlier ones are found."""
        enough, narrow = 8 * self.size * self.tiny, 4 * self.tiny
        draw = np.random.default_rng(k)
        best = None
        while True:
            low, high = self.interval(k)
            alone = self.above(low) == k and self.above(high) == k - 1
            if not alone and high - low > narrow and low < (low + high) / 2 < high:
                self.above((low + high) / 2)
                continue
            shift, x = (low + high) / 2, self._apart(draw.normal(size=self.size))
            for _ in range(12):
                x = self._apart(self.factors(shift).solve(x))
                value = float(x @ self.v @ x)
                residual = float(np.linalg.norm(self.v @ x - value * x))
                inside = low - enough <= value <= high + enough
                if inside and (best is None or residual < best[0]):
                    best = residual, value, x
                # Inside the interval the quotient is the better shift; outside it is another's.
                shift = value if inside and low < value < high else (low + high) / 2
            if best is not None and best[0] <= enough and self._certified(k, best[1], enough):
                return best[1], best[2]
            if high - low <= narrow or not low < (low + high) / 2 < high:
                if best is None:
                    raise ArithmeticError(f"eigenvalue {k} was not found")
                return best[1], best[2]
            self.above((low + high) / 2)

    def _certified(self, k: int, value: float, room: float) -> bool:
        return self.above(value - 2 * room) >= k > self.above(value + 2 * room)


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, those at rounding error left out, and unit vectors as columns.

    Of either sign, a vector's is the one that makes its largest entry positive.
    """
    slices = Slices(v)
    if slices.norm == 0:
        return np.zeros(0), slices.found
    slices.above(1.01 * slices.norm)
    slices.above(-1.01 * slices.norm)
    count = min(most, slices.above(8 * slices.size * slices.tiny))
    values = []
    for k in range(1, count + 1):
        value, x = slices.eigenpair(k)
        x = x * np.sign(x[np.abs(x).argmax()])
        slices.found = np.column_stack([slices.found, x])
        values.append(value)
    return np.array(values), slices.found
