"""Choice of bands and rows for a similarity threshold."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np


@dataclass(frozen=True)
class Banding:
    """``bands`` slices of ``rows`` signature values each."""

    bands: int
    rows: int

    @property
    def used(self) -> int:
        return self.bands * self.rows


def expected_error(
    threshold: float, bands: int, rows: int, fp_weight: float = 0.5, fn_weight: float = 0.5
) -> float:
    """Weighted area of false positives below the threshold and false negatives above it.

    The integrand is a polynomial of degree bands*rows, which a Gauss-Legendre rule with
    half as many nodes integrates without error.
    """
    nodes, weights = _rule(bands * rows // 2 + 1)

    def integral(low: float, high: float, missed: bool) -> float:
        s = low + (nodes + 1) * (high - low) / 2
        no_match = (1 - s**rows) ** bands
        return float(np.sum(weights * (no_match if missed else 1 - no_match)) * (high - low) / 2)

    return fp_weight * integral(0.0, threshold, False) + fn_weight * integral(threshold, 1.0, True)


@lru_cache(maxsize=None)
def _rule(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.polynomial.legendre.leggauss(n)


@lru_cache(maxsize=64)
def choose_banding(
    threshold: float = 0.7,
    num_perm: int = 256,
    bands: int | None = None,
    rows: int | None = None,
    fp_weight: float = 0.5,
    fn_weight: float = 0.5,
) -> Banding:
    """The given banding if both numbers are given, else the one with the least error.

    Ties go to the fewest bands, then the fewest rows.
    """
    if num_perm < 1:
        raise ValueError(f"num_perm must be positive, got {num_perm}")
    if bands is not None and rows is not None:
        if bands < 1 or rows < 1 or bands * rows > num_perm:
            raise ValueError(f"{bands} bands of {rows} rows do not fit {num_perm} permutations")
        return Banding(bands, rows)
    if not 0 <= threshold <= 1:
        raise ValueError(f"threshold must lie in [0, 1], got {threshold}")
    grid = ((b, r) for b in range(1, num_perm + 1) for r in range(1, num_perm // b + 1))
    best = min(grid, key=lambda br: expected_error(threshold, *br, fp_weight, fn_weight))
    return Banding(*best)
