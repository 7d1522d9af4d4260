"""Hilbert-space basis functions on an interval [-L, L]."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def phase(x: Column, center: float, length: float) -> Column:
    """Angle pi (x - center + L) / 2L; the j-th basis function is sin(j * angle) / sqrt(L)."""
    return (x - F.lit(float(center)) + F.lit(float(length))) * F.lit(math.pi / (2.0 * length))


def eigenfunctions(x: Column, m: int, center: float, length: float) -> Column:
    """ARRAY<DOUBLE> of the first `m` basis functions at x."""
    angle = phase(x, center, length)
    root = F.lit(1.0 / math.sqrt(length))
    return F.array(*[F.sin(angle * F.lit(float(j))) * root for j in range(1, m + 1)])


def tensor_product(spatial: Column, temporal: Column) -> Column:
    """All products, spatial index slowest."""
    return F.flatten(F.transform(spatial, lambda a: F.transform(temporal, lambda b: a * b)))
