"""Orbit functions: element-derived parameters as expressions, and an SGP4 kernel.

The kernel is the simplified general perturbations model (Hoots and Roehrich,
Spacetrack Report 3; Vallado and others, AIAA 2006-6753) over numpy arrays.
Orbits of 225 minutes and more take its deep-space part (``deep_space``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotide import codes
from geotide.functions.deep_space import DeepSpace
from geotide.schemas import struct


def period_minutes(n: Column) -> Column:
    return F.try_divide(F.lit(1440.0), n)


def semi_major_axis(n: Column) -> Column:
    rate = n * 2.0 * F.pi() / 86400.0
    return F.cbrt(F.try_divide(F.lit(codes.EARTH_MU), rate * rate))


def parameters(df: DataFrame, n: str = "mean_motion", e: str = "eccentricity") -> DataFrame:
    """Adds sma_km, period_minutes, perigee_km, apogee_km and orbit_regime."""
    df = df.withColumn("sma_km", semi_major_axis(F.col(n))).withColumn("period_minutes", period_minutes(F.col(n)))
    df = df.withColumn("perigee_km", F.col("sma_km") * (1 - F.col(e)) - codes.EARTH_RADIUS_KM)
    df = df.withColumn("apogee_km", F.col("sma_km") * (1 + F.col(e)) - codes.EARTH_RADIUS_KM)
    return df.withColumn("orbit_regime", regime(F.col("sma_km"), F.col(e)))


def regime(sma: Column, e: Column) -> Column:
    return (
        F.when(e > codes.HEO_ECCENTRICITY, "heo")
        .when(F.abs(sma - codes.GEO_AXIS_KM) < codes.GEO_TOLERANCE_KM, "geo")
        .when(sma < codes.EARTH_RADIUS_KM + codes.LEO_ALTITUDE_KM, "leo")
        .otherwise("meo")
    )


def maneuvered(period: Column, old_period: Column, inclination: Column, old_inclination: Column) -> Column:
    """Mean motion or inclination moved by more than the thresholds; false without a predecessor."""
    moved = F.abs(F.try_divide(F.lit(1440.0), period) - F.try_divide(F.lit(1440.0), old_period)) > codes.MANEUVER_MEAN_MOTION
    tilted = F.abs(inclination - old_inclination) > codes.MANEUVER_INCLINATION
    return F.coalesce((period != old_period) & moved | tilted, F.lit(False))


def status(maneuver: Column, perigee: Column, bstar: Column) -> Column:
    decaying = (perigee < codes.DECAY_PERIGEE_KM) | (bstar > codes.DECAY_BSTAR)
    return F.when(maneuver, "maneuvering").when(decaying, "decaying").otherwise("")


def confidence(given: Column, orbit: Column, epoch: Column, now: Column) -> Column:
    """'stale' once the elements are too old for their regime, else as given."""
    days = (F.unix_millis(now) - F.unix_millis(epoch)) / 86_400_000.0
    limit = F.when(orbit.isin("leo", "heo"), F.lit(codes.STALE_DAYS["leo"])).otherwise(F.lit(codes.STALE_DAYS["geo"]))
    return F.when(days > limit, "stale").otherwise(given)


def source_label(given_confidence: Column) -> Column:
    return F.when(given_confidence == "community_derived", "classfd").otherwise("celestrak")


# WGS-72, as the element sets assume
_RE, _MU = 6378.135, 398600.8
_XKE = 60.0 / np.sqrt(_RE**3 / _MU)
_J2, _J3, _J4 = 0.001082616, -0.00000253881, -0.00000165597


def sgp4(n_rev: np.ndarray, e: np.ndarray, incl: np.ndarray, node: np.ndarray, argp: np.ndarray, mean: np.ndarray, bstar: np.ndarray, minutes: np.ndarray, since_1950: np.ndarray | None = None) -> np.ndarray:
    """Inertial positions (3 x n, km) so many minutes after epoch; nan for decayed orbits.  Angles in degrees, n in rev/day.

    ``since_1950``: the epochs in days since 1949-12-31, which deep-space
    orbits need for the places of Sun and Moon; without them they are nan.
    """
    with np.errstate(all="ignore"):
        i0, om, w0, m0 = (np.radians(np.asarray(x, float)) for x in (incl, node, argp, mean))
        n0, e0, b = np.asarray(n_rev, float) * 2 * np.pi / 1440, np.asarray(e, float), np.asarray(bstar, float)
        t = np.asarray(minutes, float)
        cos_i = np.cos(i0)
        theta2, eta2 = cos_i**2, 1 - e0**2
        beta = np.sqrt(eta2)
        # mean motion and axis without the secular effect of J2
        a1 = (_XKE / n0) ** (2 / 3)
        d1 = 0.75 * _J2 * (3 * theta2 - 1) / (beta * eta2)
        delta = d1 / a1**2
        a0 = a1 * (1 - delta**2 - delta * (1 / 3 + 134 * delta**2 / 81))
        n = n0 / (1 + d1 / a0**2)
        a = (_XKE / n) ** (2 / 3)
        deep = 2 * np.pi / n >= 225.0
        perigee = (a * (1 - e0) - 1) * _RE
        s = np.where(perigee < 98, 20.0, np.where(perigee < 156, perigee - 78, 78.0)) / _RE + 1
        q4 = ((120 - (s - 1) * _RE) / _RE) ** 4
        simple = (perigee < 220) | deep
        xi = 1 / (a - s)
        eta = a * e0 * xi
        eta_sq, psi = eta**2, np.abs(1 - eta**2)
        coef = q4 * xi**4
        coef1 = coef / psi**3.5
        con41 = 3 * theta2 - 1
        c2 = coef1 * n * (a * (1 + 1.5 * eta_sq + e0 * eta * (4 + eta_sq)) + 0.375 * _J2 * xi / psi * con41 * (8 + 3 * eta_sq * (8 + eta_sq)))
        c1 = b * c2
        sin_i = np.sin(i0)
        c3 = np.where(e0 > 1e-4, -2 * coef * xi * (_J3 / _J2) * n * sin_i / np.where(e0 > 1e-4, e0, 1), 0)
        x1mth2 = 1 - theta2
        c4 = 2 * n * coef1 * a * eta2 * (
            eta * (2 + 0.5 * eta_sq) + e0 * (0.5 + 2 * eta_sq)
            - _J2 * xi / (a * psi) * (-3 * con41 * (1 - 2 * e0 * eta + eta_sq * (1.5 - 0.5 * e0 * eta)) + 0.75 * x1mth2 * (2 * eta_sq - e0 * eta * (1 + eta_sq)) * np.cos(2 * w0))
        )
        c5 = 2 * coef1 * a * eta2 * (1 + 2.75 * (eta_sq + e0 * eta) + e0 * eta * eta_sq)
        p2 = 1 / (a**2 * eta2**2)
        k1, k2, k3 = 1.5 * _J2 * p2 * n, 0.0, 0.0
        k2 = 0.5 * k1 * _J2 * p2
        k3 = -0.46875 * _J4 * p2**2 * n
        theta4 = theta2**2
        m_dot = n + 0.5 * k1 * beta * con41 + 0.0625 * k2 * beta * (13 - 78 * theta2 + 137 * theta4)
        w_dot = -0.5 * k1 * (1 - 5 * theta2) + 0.0625 * k2 * (7 - 114 * theta2 + 395 * theta4) + k3 * (3 - 36 * theta2 + 49 * theta4)
        node1 = -k1 * cos_i
        node_dot = node1 + (0.5 * k2 * (4 - 19 * theta2) + 2 * k3 * (3 - 7 * theta2)) * cos_i
        node_cf = 3.5 * eta2 * node1 * c1
        t2cof = 1.5 * c1
        xl = 0.5 * -(_J3 / _J2) * 0.5 * sin_i * (3 + 5 * cos_i) / np.where(np.abs(cos_i + 1) > 1.5e-12, 1 + cos_i, 1.5e-12)
        ay = -0.5 * (_J3 / _J2) * sin_i
        delmo, sin_m0 = (1 + eta * np.cos(m0)) ** 3, np.sin(m0)
        x7 = 7 * theta2 - 1
        d2 = 4 * a * xi * c1**2
        tmp = d2 * xi * c1 / 3
        d3 = (17 * a + s) * tmp
        d4 = 0.5 * tmp * a * xi * (221 * a + 31 * s) * c1
        t3, t4, t5 = d2 + 2 * c1**2, 0.25 * (3 * d3 + c1 * (12 * d2 + 10 * c1**2)), 0.2 * (3 * d4 + 12 * c1 * d3 + 6 * d2**2 + 15 * c1**2 * (2 * d2 + c1**2))
        # secular gravity and drag
        m_df, w_df, node_df = m0 + m_dot * t, w0 + w_dot * t, om + node_dot * t
        w, m = w_df.copy(), m_df.copy()
        node_t = node_df + node_cf * t**2
        temp_a, temp_e, temp_l = 1 - c1 * t, b * c4 * t, t2cof * t**2
        full = ~simple
        d_w = b * c3 * np.cos(w0) * t
        d_m = np.where(e0 > 1e-4, -(2 / 3) * coef * b / np.where(e0 * eta != 0, e0 * eta, 1), 0) * ((1 + eta * np.cos(m_df)) ** 3 - delmo)
        m = np.where(full, m_df + d_w + d_m, m_df)
        w = np.where(full, w_df - d_w - d_m, w_df)
        temp_a = np.where(full, temp_a - d2 * t**2 - d3 * t**3 - d4 * t**4, temp_a)
        temp_e = np.where(full, temp_e + b * c5 * (np.sin(m) - sin_m0), temp_e)
        temp_l = np.where(full, temp_l + t3 * t**3 + t**4 * (t4 + t * t5), temp_l)
        n_t, e_t, i_t = n.copy(), e0.copy(), i0.copy()
        far, at = None, np.flatnonzero(deep & np.isfinite(n) & (e0 < 1)) if since_1950 is not None else np.zeros(0, int)
        if len(at):
            far = DeepSpace(n[at], e0[at], i0[at], om[at], w0[at], m0[at], np.asarray(since_1950, float)[at], m_dot[at], w_dot[at], node_dot[at], _XKE)
            n_t[at], e_t[at], i_t[at], w[at], node_t[at], m[at] = far.secular(t[at], e0[at], i0[at], w[at], node_t[at], m[at])
        am = (_XKE / n_t) ** (2 / 3) * temp_a**2
        em = np.maximum(e_t - temp_e, 1e-6)
        m = m + n * temp_l
        lon = m + w + node_t
        node_t, w = np.mod(node_t, 2 * np.pi), np.mod(w, 2 * np.pi)
        m = np.mod(np.mod(lon, 2 * np.pi) - w - node_t, 2 * np.pi)
        if far is not None:
            em[at], i_t[at], w[at], node_t[at], m[at] = far.periodics(t[at], em[at], i_t[at], w[at], node_t[at], m[at])
            back = i_t < 0
            i_t, node_t, w = np.where(back, -i_t, i_t), np.where(back, node_t + np.pi, node_t), np.where(back, w - np.pi, w)
            # what depends on the inclination, which has moved
            cos_i, sin_i = np.cos(i_t), np.sin(i_t)
            con41, x1mth2, x7 = 3 * cos_i**2 - 1, 1 - cos_i**2, 7 * cos_i**2 - 1
            ay = -0.5 * (_J3 / _J2) * sin_i
            xl = -0.25 * (_J3 / _J2) * sin_i * (3 + 5 * cos_i) / np.where(np.abs(cos_i + 1) > 1.5e-12, 1 + cos_i, 1.5e-12)
        # long-period periodics, Kepler's equation
        axn = em * np.cos(w)
        p = 1 / (am * (1 - em**2))
        ayn = em * np.sin(w) + p * ay
        u = np.mod(m + w + p * xl * axn, 2 * np.pi)
        eo = u.copy()
        for _ in range(10):
            step = (u - ayn * np.cos(eo) + axn * np.sin(eo) - eo) / (1 - axn * np.cos(eo) - ayn * np.sin(eo))
            eo = eo + np.clip(step, -0.95, 0.95)
        sin_e, cos_e = np.sin(eo), np.cos(eo)
        e_cos, e_sin, el2 = axn * cos_e + ayn * sin_e, axn * sin_e - ayn * cos_e, axn**2 + ayn**2
        pl = am * (1 - el2)
        r = am * (1 - e_cos)
        beta_l = np.sqrt(1 - el2)
        q = e_sin / (1 + beta_l)
        sin_u, cos_u = am / r * (sin_e - ayn - axn * q), am / r * (cos_e - axn + ayn * q)
        su = np.arctan2(sin_u, cos_u)
        sin2, cos2 = 2 * cos_u * sin_u, 1 - 2 * sin_u**2
        t1 = 0.5 * _J2 / pl
        t2 = t1 / pl
        # short-period periodics
        mr = r * (1 - 1.5 * t2 * beta_l * con41) + 0.5 * t1 * x1mth2 * cos2
        su = su - 0.25 * t2 * x7 * sin2
        xn = node_t + 1.5 * t2 * cos_i * sin2
        xinc = i_t + 1.5 * t2 * cos_i * sin_i * cos2
        x = np.cos(xn) * np.cos(su) - np.sin(xn) * np.cos(xinc) * np.sin(su)
        y = np.sin(xn) * np.cos(su) + np.cos(xn) * np.cos(xinc) * np.sin(su)
        z = np.sin(xinc) * np.sin(su)
        known = ~deep
        known[at] = True
        bad = ~known | ~(pl > 0) | ~(em < 1) | ~(em >= 0) | (mr < 1)
        return np.where(bad, np.nan, _RE * mr * np.stack([x, y, z]))


def geodetic(xyz: np.ndarray, unix_seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Latitude and longitude (degrees) and altitude (km) of inertial positions."""
    d = np.asarray(unix_seconds, float) / 86400 + 2440587.5 - 2451545.0
    tc = d / 36525
    gmst = np.radians(np.mod(280.46061837 + 360.98564736629 * d + 0.000387933 * tc**2, 360))
    x, y, z = xyz
    lon = np.degrees(np.mod(np.arctan2(y, x) - gmst + np.pi, 2 * np.pi) - np.pi)
    f, rho = 1 / 298.257223563, np.hypot(x, y)
    e2, re = f * (2 - f), 6378.137
    lat = np.arctan2(z, rho)
    for _ in range(6):
        c = 1 / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(z + re * c * e2 * np.sin(lat), rho)
    return np.degrees(lat), lon, rho / np.cos(lat) - re / np.sqrt(1 - e2 * np.sin(lat) ** 2)


@F.pandas_udf(struct("lat double, lon double, alt_km double"))
def propagate(n: pd.Series, e: pd.Series, incl: pd.Series, node: pd.Series, argp: pd.Series, mean: pd.Series, bstar: pd.Series, epoch_ms: pd.Series, at_ms: pd.Series) -> pd.DataFrame:
    """Geodetic position of each element set at a time; null where the kernel doesn't apply."""
    xyz = sgp4(n, e, incl, node, argp, mean, bstar, (at_ms - epoch_ms) / 60000.0, epoch_ms / 86_400_000.0 + 7306.0)
    lat, lon, alt = geodetic(xyz, at_ms / 1000.0)
    out = pd.DataFrame({"lat": lat, "lon": lon, "alt_km": alt})
    return out.where(out.notna(), None)
