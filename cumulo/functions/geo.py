"""Geometry on the sphere as column expressions; on the ellipsoid as steps of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earth radius, kilometres per degree of latitude, and per degree of longitude at the equator.
EARTH_KM = 6371.0
KM_PER_DEGREE_LAT = 110.574
KM_PER_DEGREE_LON = 111.320
# Semi-major axis in metres and flattening of the WGS 84 ellipsoid.
AXIS_M = 6378137.0
FLATTENING = 1 / 298.257223563
POLAR_AXIS_M = AXIS_M * (1 - FLATTENING)
#: Each round of a geodesic's iteration leaves about a 300th of the error.
ROUNDS = 4


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def wrap_lon(lon) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(_c(lon) + 180.0, F.lit(360.0)) - 180.0


def wrap_around(lon, centre) -> Column:
    """Longitude moved by whole turns to within half a turn of ``centre``."""
    return _c(centre) + wrap_lon(_c(lon) - _c(centre))


def degree_buffer(km, min_lat, max_lat) -> tuple[Column, Column]:
    """(latitude, longitude) degrees that ``km`` spans in a box."""
    middle = F.radians((_c(min_lat) + _c(max_lat)) / 2)
    return _c(km) / KM_PER_DEGREE_LAT, _c(km) / (F.lit(KM_PER_DEGREE_LON) * F.greatest(F.cos(middle), F.lit(1e-6)))


def box_centre(min_lat, max_lat, min_lon, max_lon) -> tuple[Column, Column]:
    """Centre of a box that may cross the date line (min_lon > max_lon)."""
    width = _c(max_lon) - _c(min_lon)
    width = F.when(width < 0, width + 360.0).otherwise(width)
    return (_c(min_lat) + _c(max_lat)) / 2, wrap_lon(_c(min_lon) + width / 2)


# Vincenty's series, step by step: {x} is the column x of a place. A step's columns are used several times by the next,
# so Spark keeps the steps apart, and each value is computed once, in generated code.
_K = "({f} / 16 * {cos2} * (4 + {f} * (4 - 3 * {cos2})))"
_TURN = "(1 - {k}) * {f} * {sin_a} * ({sigma} + {k} * {sin_s} * ({mid} + {k} * {cos_s} * (2 * {mid} * {mid} - 1)))"
_ARC = "{b} * {sin_s} * ({mid} + {b} / 4 * ({cos_s} * (2 * {mid} * {mid} - 1) - {b} / 6 * {mid} * (4 * {sin_s} * {sin_s} - 3) * (4 * {mid} * {mid} - 3)))"
_SCALES = {"a": "1 + {u} / 16384 * (4096 + {u} * (-768 + {u} * (320 - 175 * {u})))", "b": "{u} / 1024 * (256 + {u} * (-128 + {u} * (74 - 47 * {u})))"}
_CHORD = [
    {"east": "{c2} * sin({lam})", "north": "{c1} * {s2} - {s1} * {c2} * cos({lam})", "cos_s": "{s1} * {s2} + {c1} * {c2} * cos({lam})", "sin_s": "hypot({c2} * sin({lam}), {c1} * {s2} - {s1} * {c2} * cos({lam}))"},
    {"sigma": "atan2({sin_s}, {cos_s})", "cos2": "1 - if({sin_s} = 0, 0, {c1} * {east} / {sin_s}) * if({sin_s} = 0, 0, {c1} * {east} / {sin_s})", "sin_a": "if({sin_s} = 0, 0, {c1} * {east} / {sin_s})"},
    {"k": _K, "mid": "if({cos2} < 1e-15, 0, {cos_s} - 2 * {s1} * {s2} / {cos2})", "u": "{cos2} * {e2}"},
]
_PROJECT = [
    {"s1": "sin({u1})", "c1": "cos({u1})", "s2": "sin({u2})", "c2": "cos({u2})", "lam": "{turn}"},
    *[*_CHORD, {"lam": "{turn} + " + _TURN, "moved": "abs({turn} + " + _TURN + " - {lam})"}] * ROUNDS,
    *_CHORD, _SCALES, {"metres": "{axis} * {a} * ({sigma} - " + _ARC + ")", "azimuth": "atan2({east}, {north})"},
]
_BEND = {"sin_s": "sin({sigma})", "cos_s": "cos({sigma})", "mid": "cos(2 * {begin} + {sigma})"}
_UNPROJECT = [
    {"s1": "sin({u1})", "c1": "cos({u1})", "sin_z": "sin({azimuth})", "cos_z": "cos({azimuth})"},
    {"sin_a": "{c1} * {sin_z}", "begin": "atan2({s1}, {c1} * {cos_z})", "cos2": "1 - {c1} * {sin_z} * {c1} * {sin_z}"},
    {"k": _K, "u": "{cos2} * {e2}"}, _SCALES, {"plain": "{metres} / ({axis} * {a})", "sigma": "{metres} / ({axis} * {a})"},
    *[_BEND, {"sigma": "{plain} + " + _ARC}] * ROUNDS, _BEND,
    {"lat": "atan2({s1} * {cos_s} + {c1} * {sin_s} * {cos_z}, (1 - {f}) * hypot({sin_a}, {s1} * {sin_s} - {c1} * {cos_s} * {cos_z}))", "lon": "atan2({sin_s} * {sin_z}, {c1} * {cos_s} - {s1} * {sin_s} * {cos_z}) - " + _TURN},
]


def _reduced(lat: Column) -> Column:
    return F.atan((1 - FLATTENING) * F.tan(F.radians(lat)))


def _stepwise(df: DataFrame, given: dict[str, dict[str, Column]], steps: list[dict[str, str]]) -> DataFrame:
    """The columns of all steps, for every place of ``given``, all places at once."""
    df = df.withColumns({f"__{place}_{name}": c for place, columns in given.items() for name, c in columns.items()})
    every = {n for step in [*given.values(), *steps] for n in step}
    fixed = {"f": f"{FLATTENING!r}d", "axis": f"{POLAR_AXIS_M!r}d", "e2": f"{(AXIS_M / POLAR_AXIS_M) ** 2 - 1!r}d"}
    terms = {place: {n: f"`__{place}_{n}`" for n in every} | fixed for place in given}
    for step in steps:
        df = df.withColumns({f"__{place}_{name}": F.expr(text.format_map(terms[place])) for place in given for name, text in step.items()})
    return df


def project(df: DataFrame, places: dict[str, tuple], lat0, lon0) -> DataFrame:
    """For each named place (lat, lon), a column struct(x, y): azimuthal equidistant metres about (lat0, lon0), from the
    length and azimuth of the geodesic on the ellipsoid. Null where a coordinate is, and for places so
    nearly opposite to the centre that the series does not settle. Store the result before filtering by it: Spark would
    push the filter below the steps, and repeat them in it."""
    lat0, lon0 = _c(lat0), _c(lon0)
    given = {p: {"u1": _reduced(lat0), "u2": _reduced(_c(lat)), "turn": F.radians(wrap_lon(_c(lon) - lon0))} for p, (lat, lon) in places.items()}
    out = _stepwise(df, given, _PROJECT)
    xy = lambda p: F.struct(F.expr(f"`__{p}_metres` * sin(`__{p}_azimuth`)").alias("x"), F.expr(f"`__{p}_metres` * cos(`__{p}_azimuth`)").alias("y"))
    return out.select(*df.columns, *[F.when(F.expr(f"`__{p}_moved` < 1e-9 AND `__{p}_metres` IS NOT NULL"), xy(p)).alias(p) for p in places])


def unproject(df: DataFrame, places: dict[str, tuple], lat0, lon0) -> DataFrame:
    """For each named place (x, y), as ``project`` gives it, a column struct(lat, lon); null where a coordinate is."""
    given = {p: {"u1": _reduced(_c(lat0)), "azimuth": F.atan2(_c(x), _c(y)), "metres": F.hypot(_c(x), _c(y)), "lon0": _c(lon0)} for p, (x, y) in places.items()}
    out = _stepwise(df, given, _UNPROJECT)
    place = lambda p: F.struct(F.expr(f"degrees(`__{p}_lat`)").alias("lat"), wrap_lon(F.expr(f"`__{p}_lon0` + degrees(`__{p}_lon`)")).alias("lon"))
    return out.select(*df.columns, *[F.when(F.expr(f"`__{p}_lat` IS NOT NULL AND `__{p}_lon` IS NOT NULL AND `__{p}_lon0` IS NOT NULL"), place(p)).alias(p) for p in places])


def ground_range(range_m, elevation_deg) -> Column:
    return _c(range_m) * F.cos(F.radians(_c(elevation_deg)))


def ray_window(azimuth_deg, min_x, max_x, min_y, max_y) -> tuple[Column, Column]:
    """Least and greatest ground range at which a ray from the origin lies inside a rectangle; null if
    it misses, or if any of these is null. A direction component under 1e-6 counts as parallel to its axis."""
    s, c = F.sin(F.radians(_c(azimuth_deg))), F.cos(F.radians(_c(azimuth_deg)))
    low, high = F.lit(0.0), F.lit(float("inf"))
    ok = _c(azimuth_deg).isNotNull()
    for d, a, b in ((s, _c(min_x), _c(max_x)), (c, _c(min_y), _c(max_y))):
        flat = F.abs(d) < 1e-6
        r1, r2 = a / d, b / d
        low = F.when(flat, low).otherwise(F.greatest(low, F.least(r1, r2)))
        high = F.when(flat, high).otherwise(F.least(high, F.greatest(r1, r2)))
        # greatest and least pass over nulls
        ok = ok & a.isNotNull() & b.isNotNull() & (~flat | ((a <= 0) & (b >= 0)))
    hit = ok & (low <= high)
    return F.when(hit, low), F.when(hit, high)


def circular_difference(a, b) -> Column:
    """Least angle between two directions in degrees."""
    d = F.pmod(_c(a) - _c(b), F.lit(360.0))
    return F.least(d, F.lit(360.0) - d)

