"""Numeric expressions used by decisions and evaluations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wilson_low(hits: Column, n: Column, z: float = 1.96) -> Column:
    """Wilson's lower bound of a share; 0 for n = 0."""
    p = hits / n
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return F.when(n == 0, F.lit(0.0)).otherwise(bound)


def logit(p: Column, eps: float = 1e-4) -> Column:
    """Log odds, p kept within eps of 0 and 1."""
    kept = F.greatest(F.least(p, F.lit(1 - eps)), F.lit(eps))
    return F.ln(kept / (1 - kept))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def overlap(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Length of the overlap of two intervals; negative: the gap between them."""
    return F.least(end, other_end) - F.greatest(start, other_start)
