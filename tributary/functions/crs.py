"""Geographic coordinates to UTM and back, as column expressions: the Krueger series to the sixth order (public formulas).

WGS 84; zone 48 north unless another central meridian is given. Good to well under a millimetre within the zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

A, INVERSE_FLATTENING = 6378137.0, 298.257223563
SCALE, FALSE_EASTING = 0.9996, 500000.0
FLAT = 1 / INVERSE_FLATTENING
N = FLAT / (2 - FLAT)
E = math.sqrt(FLAT * (2 - FLAT))
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)


def _series(rows: list[list[float]]) -> list[float]:
    """Sums of c * n^k: row j holds the terms from n^(j+1) on."""
    return [sum(c * N ** (j + 1 + k) for k, c in enumerate(row)) for j, row in enumerate(rows)]


#: Coefficients of the forward and inverse series, and of the latitude from the conformal latitude.
FORWARD = _series([[1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800], [13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360], [61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440], [49561 / 161280, -179 / 168, 6601661 / 7257600], [34729 / 80640, -3418889 / 1995840], [212378941 / 319334400]])
INVERSE = _series([[1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800], [1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720], [17 / 480, -37 / 840, -209 / 4480, 5569 / 90720], [4397 / 161280, -11 / 504, -830251 / 7257600], [4583 / 161280, -108847 / 3991680], [20648693 / 638668800]])

LATITUDE = _series([[2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675], [7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945], [56 / 15, -136 / 35, -1262 / 105, 73814 / 2835], [4279 / 630, -332 / 35, -399572 / 14175], [4174 / 315, -144838 / 6237], [601676 / 22275]])


def geographic_to_utm(lon: Column, lat: Column, meridian: float = 105.0) -> tuple[Column, Column]:
    """(easting, northing) of degrees."""
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - E * F.atanh(E * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(FORWARD, 1):
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return FALSE_EASTING + SCALE * RADIUS * x, SCALE * RADIUS * y


def utm_to_geographic(east: Column, north: Column, meridian: float = 105.0) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees."""
    xi, eta = north / (SCALE * RADIUS), (east - FALSE_EASTING) / (SCALE * RADIUS)
    y, x = xi, eta
    for j, b in enumerate(INVERSE, 1):
        y = y - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        x = x - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(y) / F.cosh(x))
    lat = chi
    for j, d in enumerate(LATITUDE, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return meridian + F.degrees(F.atan2(F.sinh(x), F.cos(y))), F.degrees(lat)


def meridian_of(crs: str) -> float | None:
    """The central meridian of a UTM zone north (EPSG:32601 to 32660), null for geographic coordinates (EPSG:4326); others are an error."""
    if crs == "EPSG:4326":
        return None
    code = int(crs.removeprefix("EPSG:")) if crs.startswith("EPSG:") and crs[5:].isdigit() else 0
    if not 32601 <= code <= 32660:
        raise ValueError(f"no change of coordinates for {crs}")
    return 6.0 * (code - 32600) - 183.0


def transformed(df: DataFrame, x: str, y: str, source: str, target: str) -> DataFrame:
    """``df`` with its columns ``x`` and ``y`` in another system; longitude comes first.

    The inverse series are columns one upon the other, as each stands in many terms of the next: in one expression they would be written out anew each time.
    """
    if source == target:
        return df
    a, b = meridian_of(source), meridian_of(target)
    if a is not None:
        xi, eta = F.col("__xi"), F.col("__eta")
        df = df.withColumns({"__xi": F.col(y) / (SCALE * RADIUS), "__eta": (F.col(x) - FALSE_EASTING) / (SCALE * RADIUS)})
        up, across = xi, eta
        for j, c in enumerate(INVERSE, 1):
            up = up - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            across = across - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        df = df.withColumns({"__up": up, "__across": across})
        df = df.withColumn("__chi", F.asin(F.sin("__up") / F.cosh("__across")))
        lat = F.col("__chi")
        for j, d in enumerate(LATITUDE, 1):
            lat = lat + d * F.sin(2 * j * F.col("__chi"))
        df = df.withColumns({x: a + F.degrees(F.atan2(F.sinh("__across"), F.cos("__up"))), y: F.degrees(lat)}).drop("__xi", "__eta", "__up", "__across", "__chi")
    if b is not None:
        t = F.sinh(F.atanh(F.sin(F.radians(y))) - E * F.atanh(E * F.sin(F.radians(y))))
        df = df.withColumns({"__t": t, "__lam": F.radians(F.col(x) - b)})
        df = df.withColumns({"__xi": F.atan2(F.col("__t"), F.cos("__lam")), "__eta": F.atanh(F.sin("__lam") / F.sqrt(1 + F.col("__t") * F.col("__t")))})
        up, across = F.col("__xi"), F.col("__eta")
        for j, c in enumerate(FORWARD, 1):
            up = up + c * F.sin(2 * j * F.col("__xi")) * F.cosh(2 * j * F.col("__eta"))
            across = across + c * F.cos(2 * j * F.col("__xi")) * F.sinh(2 * j * F.col("__eta"))
        df = df.withColumns({x: FALSE_EASTING + SCALE * RADIUS * across, y: SCALE * RADIUS * up}).drop("__t", "__lam", "__xi", "__eta")
    return df
