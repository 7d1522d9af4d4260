"""Distances, nearest zone and covariance kernels as column expressions."""

import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrisk.schemas import EARTH_RADIUS_KM, ZONES


def wind_speed(u, v) -> Column:
    u, v = F.col(u), F.col(v)
    return F.sqrt(u * u + v * v)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2.0)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))


def zone_distances(lat: Column, lon: Column, zones: Mapping[str, tuple[float, float]] = ZONES,
                   metric: str = "degrees") -> list[Column]:
    """One distance column per centroid: squared degrees, or km."""
    if metric not in ("degrees", "haversine"):
        raise ValueError(f"metric must be 'degrees' or 'haversine', got {metric!r}")
    out = []
    for zone_lat, zone_lon in zones.values():
        if metric == "degrees":
            dlat, dlon = lat - F.lit(float(zone_lat)), lon - F.lit(float(zone_lon))
            out.append(dlat * dlat + dlon * dlon)
        else:
            out.append(haversine_km(lat, lon, F.lit(float(zone_lat)), F.lit(float(zone_lon))))
    return out


def _bessel_kernel(nu: float):
    """Matern correlation of general smoothness, from the integral form of K_nu.

    K_nu(x) = int_0^inf exp(-x cosh t) cosh(nu t) dt, by the trapezoidal rule, which
    converges geometrically for this integrand. Works on Arrow batches.
    """
    t = np.linspace(0.0, 30.0, 3001)
    step = t[1] - t[0]
    scale = 2.0 ** (1.0 - nu) / math.gamma(nu)

    @F.pandas_udf(T.DoubleType())
    def correlation(r: pd.Series) -> pd.Series:
        x = np.sqrt(2.0 * nu) * np.maximum(r.to_numpy(dtype=float), 1e-10)
        out = np.empty_like(x)
        for start in range(0, len(x), 1024):
            part = x[start:start + 1024, None]
            log_terms = -part * np.cosh(t) + nu * t
            terms = np.exp(log_terms) * (1.0 + np.exp(-2.0 * nu * t)) / 2.0
            terms[:, 0] *= 0.5
            out[start:start + 1024] = terms.sum(axis=1) * step
        return pd.Series(scale * x ** nu * out)

    return correlation


def matern(distance: Column, lengthscale: float = 100.0, nu: float = 1.5, variance: float = 1.0) -> Column:
    """Matern covariance of a distance; closed forms for nu = 1/2, 3/2, 5/2."""
    r = distance / F.lit(lengthscale + 1e-9)
    if nu == 0.5:
        corr = F.exp(-r)
    elif nu == 1.5:
        s = F.lit(math.sqrt(3.0)) * r
        corr = (F.lit(1.0) + s) * F.exp(-s)
    elif nu == 2.5:
        s = F.lit(math.sqrt(5.0)) * r
        corr = (F.lit(1.0) + s + s * s / 3.0) * F.exp(-s)
    else:
        corr = F.when(distance == 0.0, F.lit(1.0)).otherwise(_bessel_kernel(nu)(r))
    return F.lit(float(variance)) * corr
