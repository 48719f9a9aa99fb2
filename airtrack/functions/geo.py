"""WGS84 <-> UTM (transverse Mercator) as Column expressions.

Sixth-order Krueger series as published by Karney (2011).  Everything stays in JVM codegen; the
intermediate angles are separate projections so that they are computed once per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrack.settings import UTM_ZONE

_A = 6378137.0
_FLATTENING = 1 / 298.257223563
_N = _FLATTENING / (2 - _FLATTENING)
_E = math.sqrt(_FLATTENING * (2 - _FLATTENING))
_K0 = 0.9996
_FALSE_EASTING = 500000.0
_RADIUS = _K0 * _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)

# Published series coefficients (fixed values).
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288 + 7891 * _N**6 / 37800,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630 - 1983433 * _N**6 / 1935360,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880 + 167603 * _N**6 / 181440,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168 + 6601661 * _N**6 / 7257600,
    34729 * _N**5 / 80640 - 3418889 * _N**6 / 1995840,
    212378941 * _N**6 / 319334400,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360 - 81 * _N**5 / 512 + 96199 * _N**6 / 604800,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440 + 46 * _N**5 / 105 - 1118711 * _N**6 / 3870720,
    17 * _N**3 / 480 - 37 * _N**4 / 840 - 209 * _N**5 / 4480 + 5569 * _N**6 / 90720,
    4397 * _N**4 / 161280 - 11 * _N**5 / 504 - 830251 * _N**6 / 7257600,
    4583 * _N**5 / 161280 - 108847 * _N**6 / 3991680,
    20648693 * _N**6 / 638668800,
)


def central_meridian(zone: int) -> float:
    return 6.0 * zone - 183.0


def _series(coefficients, xi: Column, eta: Column, along, across) -> Column:
    total = None
    for j, coefficient in enumerate(coefficients, start=1):
        term = F.lit(coefficient) * along(F.lit(2.0 * j) * xi) * across(F.lit(2.0 * j) * eta)
        total = term if total is None else total + term
    return total


def with_utm(
    df: DataFrame,
    longitude: str = "longitude",
    latitude: str = "latitude",
    x: str = "utm_x",
    y: str = "utm_y",
    zone: int = UTM_ZONE,
) -> DataFrame:
    """Add planar coordinates in metres for longitude / latitude in degrees."""
    sin_lat = F.sin(F.radians(F.col(latitude)))
    dlon = F.radians(F.col(longitude) - F.lit(central_meridian(zone)))
    keep = [c for c in df.columns if c not in (x, y)]
    return (
        df.withColumns({
            "_t": F.sinh(F.atanh(sin_lat) - F.lit(_E) * F.atanh(F.lit(_E) * sin_lat)),
            "_sin_l": F.sin(dlon),
            "_cos_l": F.cos(dlon),
        })
        .withColumns({
            "_xi": F.atan2("_t", "_cos_l"),
            "_eta": F.asinh(F.col("_sin_l") / F.hypot("_t", "_cos_l")),
        })
        .select(
            *keep,
            (
                F.lit(_FALSE_EASTING)
                + F.lit(_RADIUS) * (F.col("_eta") + _series(_ALPHA, F.col("_xi"), F.col("_eta"), F.cos, F.sinh))
            ).alias(x),
            (
                F.lit(_RADIUS) * (F.col("_xi") + _series(_ALPHA, F.col("_xi"), F.col("_eta"), F.sin, F.cosh))
            ).alias(y),
        )
    )


def with_lonlat(
    df: DataFrame,
    x: str = "utm_x",
    y: str = "utm_y",
    longitude: str = "longitude",
    latitude: str = "latitude",
    zone: int = UTM_ZONE,
) -> DataFrame:
    """Inverse of :func:`with_utm`; two fixed Newton steps give the latitude to 1e-13 degrees."""
    keep = [c for c in df.columns if c not in (longitude, latitude)]
    out = (
        df.withColumns({
            "_xi": F.col(y) / F.lit(_RADIUS),
            "_eta": (F.col(x) - F.lit(_FALSE_EASTING)) / F.lit(_RADIUS),
        })
        .withColumns({
            "_u": F.col("_xi") - _series(_BETA, F.col("_xi"), F.col("_eta"), F.sin, F.cosh),
            "_v": F.col("_eta") - _series(_BETA, F.col("_xi"), F.col("_eta"), F.cos, F.sinh),
        })
        .withColumn("_sinh_v", F.sinh("_v"))
        .withColumn("_cos_u", F.cos("_u"))
        .withColumn("_target", F.sin("_u") / F.hypot("_sinh_v", "_cos_u"))
        .withColumn("_t", F.col("_target"))
    )
    square = F.lit(1.0 - _E**2)
    for _ in range(2):
        t = F.col("_t")
        out = (
            out.withColumn("_q", F.sqrt(1 + t * t))
            .withColumn("_s", F.sinh(F.lit(_E) * F.atanh(F.lit(_E) * t / F.col("_q"))))
            .withColumn("_w", t * F.sqrt(1 + F.col("_s") * F.col("_s")) - F.col("_s") * F.col("_q"))
            .withColumn(
                "_t",
                t
                + (F.col("_target") - F.col("_w"))
                / F.sqrt(1 + F.col("_w") * F.col("_w"))
                * (1 + square * t * t)
                / (square * F.col("_q")),
            )
        )
    return out.select(
        *keep,
        (F.lit(central_meridian(zone)) + F.degrees(F.atan2("_sinh_v", "_cos_u"))).alias(longitude),
        F.degrees(F.atan("_t")).alias(latitude),
    )


def planar_speed(dx: Column, dy: Column, seconds: Column) -> Column:
    """Metres per second between two planar points; null when no time has passed."""
    return F.when(seconds > 0, F.sqrt(dx * dx + dy * dy) / seconds)


def planar_heading(dx: Column, dy: Column) -> Column:
    """Degrees counter-clockwise from east in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(360.0))
