"""String similarities: Jaro-Winkler for field names (on the driver), trigrams and distances over columns."""

from __future__ import annotations

import math
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def field_name(name: str) -> str:
    """A field name without accents, in lower case, with one underscore between words."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
    parts = "".join("_" if c in "- ./" else c for c in plain).split("_")
    out = "_".join(p for p in parts if p)
    return out


def jaro_winkler(a: str, b: str) -> float:
    """Similarity of 0 to 1; a common prefix of up to four letters counts where Jaro's is over 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, ours = set(), []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if j not in taken and b[j] == c), None)
        if j is not None:
            taken.add(j)
            ours.append(c)
    if not ours:
        return 0.0
    theirs = [b[j] for j in sorted(taken)]
    m, swapped = len(ours), sum(x != y for x, y in zip(ours, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= 0.7:
        return jaro
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + 0.1 * same * (1 - jaro)


def trigrams(x: Column) -> Column:
    """Distinct three-letter parts of a text's words, each with two blanks before and one behind."""
    words = F.filter(F.split(F.lower(x), r"(?U)[^\w]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substr(p, i, F.lit(3))))))


def trigram_similarity(a: Column, b: Column) -> Column:
    ta, tb = trigrams(a), trigrams(b)
    return F.size(F.array_intersect(ta, tb)) / F.nullif(F.size(F.array_union(ta, tb)), F.lit(0))


EARTH_M = 6371008.8


def haversine_m(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Metres on the sphere; differs from the ellipsoid by half a per cent at most."""
    a = F.pow(F.sin(F.radians(lat - lat0) / 2), 2) + F.cos(F.radians(lat)) * math.cos(math.radians(lat0)) * F.pow(F.sin(F.radians(lon - lon0) / 2), 2)
    return 2 * EARTH_M * F.asin(F.when(a > 1, 1.0).otherwise(F.sqrt(a)))


# The WGS 84 ellipsoid.
AXIS_M, FLATTENING = 6378137.0, 1 / 298.257223563
#: Rounds of Vincenty's iteration; it settles in six where points are not nearly opposite.
ROUNDS = 12


def vincenty_m(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Metres on the WGS 84 ellipsoid by Vincenty's inverse formula; on the sphere for points nearly opposite, where it does not settle."""
    f, b = FLATTENING, AXIS_M * (1 - FLATTENING)
    u1 = math.atan((1 - f) * math.tan(math.radians(lat0)))
    su1, cu1 = math.sin(u1), math.cos(u1)
    u2 = F.atan((1 - f) * F.tan(F.radians(lat)))
    gap = F.radians(lon - lon0)
    fixed = F.struct(F.sin(u2).alias("s"), F.cos(u2).alias("c"), gap.alias("gap"))

    def arc(u: Column, x: Column) -> Column:
        """What an angle x on the auxiliary sphere gives: sigma, its sine and cosine, the sine of the azimuth, and more."""
        across, along = u.c * F.sin(x), cu1 * u.s - su1 * u.c * F.cos(x)
        sine, cosine = F.sqrt(across * across + along * along), su1 * u.s + cu1 * u.c * F.cos(x)
        turn = F.coalesce(cu1 * u.c * F.sin(x) / F.nullif(sine, F.lit(0.0)), F.lit(0.0))
        level = 1 - turn * turn
        middle = F.when(level < 1e-15, 0.0).otherwise(cosine - 2 * su1 * u.s / F.nullif(level, F.lit(0.0)))
        return F.struct(sine.alias("sine"), cosine.alias("cosine"), turn.alias("turn"), level.alias("level"), middle.alias("middle"))

    def step(state: Column, _: Column) -> Column:
        u, x = state.u, state.x
        a = let(arc(u, x))
        c = lambda r: f / 16 * r.level * (4 + f * (4 - 3 * r.level))
        sigma = lambda r: F.atan2(r.sine, r.cosine)
        new = lambda r: u.gap + (1 - c(r)) * f * r.turn * (sigma(r) + c(r) * r.sine * (r.middle + c(r) * r.cosine * (2 * r.middle * r.middle - 1)))
        return F.element_at(F.transform(a, lambda r: F.struct(u.alias("u"), new(r).alias("x"), F.abs(new(r) - x).alias("moved"))), 1)

    def let(x: Column) -> Column:
        return F.array(x)

    def length(state: Column) -> Column:
        def metres(r: Column) -> Column:
            w = r.level * (AXIS_M**2 - b**2) / b**2
            big = 1 + w / 16384 * (4096 + w * (w * (320 - 175 * w) - 768))
            small = w / 1024 * (256 + w * (w * (74 - 47 * w) - 128))
            m2 = 2 * r.middle * r.middle - 1
            less = small * r.sine * (r.middle + small / 4 * (r.cosine * m2 - small / 6 * r.middle * (4 * r.sine * r.sine - 3) * (4 * r.middle * r.middle - 3)))
            return b * big * (F.atan2(r.sine, r.cosine) - less)

        return F.element_at(F.transform(F.array(arc(state.u, state.x)), metres), 1)

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    start = F.struct(fixed.alias("u"), gap.alias("x"), F.lit(1.0).alias("moved"))
    end = F.aggregate(rounds, start, step)
    settled = F.element_at(F.transform(F.array(end), lambda s: F.when(s.moved < 1e-11, length(s))), 1)
    return F.coalesce(settled, haversine_m(lat, lon, lat0, lon0))
