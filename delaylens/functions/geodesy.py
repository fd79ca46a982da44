"""Distances on the earth, in statute miles, as SQL expressions over named columns.

The formulas are long, so each is one expression text: building it costs a single call.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS-84 ellipsoid in metres, the mile, and the distance reported when two
# places cannot be compared (the equatorial circumference in miles).
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SEMI_MINOR = SEMI_MAJOR * (1 - FLATTENING)
METRES_PER_MILE = 1609.344
UNKNOWN_MILES = 24902
ROUNDS = 20
TOLERANCE = 1e-11

# Smallest and largest radius of curvature anywhere on the ellipsoid, in miles. A sphere of the
# first radius never overstates a distance on the ellipsoid, one of the second never understates.
_E2 = FLATTENING * (2 - FLATTENING)
INNER_RADIUS = SEMI_MAJOR * (1 - _E2) / METRES_PER_MILE
OUTER_RADIUS = SEMI_MAJOR / math.sqrt(1 - _E2) / METRES_PER_MILE


def sphere_miles(lat1: str, lon1: str, lat2: str, lon2: str, radius: float) -> Column:
    """Great-circle distance by the haversine formula."""
    return F.expr(f"""{2 * radius}D * asin(sqrt(least(1D,
        pow(sin(radians({lat2} - {lat1}) / 2), 2)
        + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))""")


def _let(value: str, name: str, body: str) -> str:
    """``body`` over a value that is evaluated once however often the body uses it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _arc(lam: str, name: str, body: str) -> str:
    """``body`` over the arc length and azimuth terms ``name`` for a longitude difference."""
    sides = f"""named_struct(
        'ss', sqrt(pow(t.c2 * sin({lam}), 2) + pow(t.c1 * t.s2 - t.s1 * t.c2 * cos({lam}), 2)),
        'cs', t.s1 * t.s2 + t.c1 * t.c2 * cos({lam}))"""
    # Coinciding places have no azimuth; along the equator cos²α is zero and its term drops out.
    azimuth = f"""named_struct('ss', a.ss, 'cs', a.cs, 'sg', atan2(a.ss, a.cs),
        'sa', coalesce(t.c1 * t.c2 * sin({lam}) / nullif(a.ss, 0D), 0D))"""
    square = "named_struct('ss', b.ss, 'cs', b.cs, 'sg', b.sg, 'sa', b.sa, 'ca', 1D - b.sa * b.sa)"
    middle = f"""named_struct('ss', d.ss, 'cs', d.cs, 'sg', d.sg, 'sa', d.sa, 'ca', d.ca,
        'cm', coalesce(d.cs - 2D * t.s1 * t.s2 / nullif(d.ca, 0D), 0D),
        'c', {FLATTENING}D / 16 * d.ca * (4D + {FLATTENING}D * (4D - 3D * d.ca)))"""
    terms = _let(_let(_let(sides, "a", azimuth), "b", square), "d", middle)
    return _let(terms, name, body)


def ellipsoid_miles(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Distance on the WGS-84 ellipsoid by Vincenty's inverse formula (1975).

    NULL for a missing coordinate and for nearly antipodal places, where the iteration does
    not settle.
    """
    f = f"{FLATTENING}D"
    longitude = f"""t.l + (1D - x.c) * {f} * x.sa
        * (x.sg + x.c * x.ss * (x.cm + x.c * x.cs * (2D * x.cm * x.cm - 1D)))"""
    improved = _arc("p.lam", "x", _let(longitude, "v", "named_struct('lam', v, 'step', abs(v - p.lam))"))
    # A settled pair keeps its state; the rounds left over cost one comparison each.
    step = f"CASE WHEN p.step <= {TOLERANCE}D THEN p ELSE {improved} END"
    series = f"""named_struct('k', x.ca * {(SEMI_MAJOR**2 - SEMI_MINOR**2) / SEMI_MINOR**2}D,
        'ss', x.ss, 'cs', x.cs, 'sg', x.sg, 'cm', x.cm)"""
    factors = """named_struct('ss', y.ss, 'cs', y.cs, 'sg', y.sg, 'cm', y.cm,
        'a', 1D + y.k / 16384 * (4096D + y.k * (-768D + y.k * (320D - 175D * y.k))),
        'b', y.k / 1024 * (256D + y.k * (-128D + y.k * (74D - 47D * y.k))))"""
    miles = f"""{SEMI_MINOR / METRES_PER_MILE}D * z.a * (z.sg - z.b * z.ss * (z.cm + z.b / 4 * (
        z.cs * (2D * z.cm * z.cm - 1D)
        - z.b / 6 * z.cm * (4D * z.ss * z.ss - 3D) * (4D * z.cm * z.cm - 3D))))"""
    length = _arc("p.lam", "x", _let(_let(series, "y", factors), "z", miles))
    walk = f"""aggregate(sequence(1, {ROUNDS}), named_struct('lam', t.l, 'step', 1D),
        (p, i) -> {step}, p -> CASE WHEN p.step <= {TOLERANCE}D THEN {length} END)"""
    angles = f"""named_struct('u1', atan((1D - {f}) * tan(radians({lat1}))),
        'u2', atan((1D - {f}) * tan(radians({lat2}))), 'l', radians({lon2} - {lon1}))"""
    sines = "named_struct('s1', sin(u.u1), 'c1', cos(u.u1), 's2', sin(u.u2), 'c2', cos(u.u2), 'l', u.l)"
    return F.expr(f"""CASE WHEN {lat1} = {lat2} AND {lon1} = {lon2} THEN 0D
        WHEN {lat1} + {lat2} + {lon1} + {lon2} IS NOT NULL THEN {_let(_let(angles, 'u', sines), 't', walk)} END""")


def rounded_miles(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Whole miles, half to even; the circumference where no distance can be computed."""
    miles = F.bround(ellipsoid_miles(lat1, lon1, lat2, lon2))
    return F.coalesce(miles, F.lit(float(UNKNOWN_MILES))).cast("bigint")


def miles_to_cell(lat: str, lon: str, south: str, west: str, size: float) -> Column:
    """A distance that no place inside a latitude/longitude cell can undercut.

    The closest point of a side meridian is the foot of the perpendicular on it, or a pole when
    the meridian lies more than 90° away.
    """
    # The slack absorbs rounding where a position lies on a cell boundary.
    gap, slack = f"greatest({south} - {lat}, {lat} - {south} - {size}D, 0D)", 1e-9
    turn = f"""CASE WHEN {lon} BETWEEN {west} AND {west} + {size}D THEN 0D ELSE least(
        abs(pmod({lon} - {west} + 540D, 360D) - 180D),
        abs(pmod({lon} - {west} - {size}D + 540D, 360D) - 180D)) END"""
    foot = f"degrees(asin(cos(radians({lat})) * sin(radians(least({turn}, 90D)))))"
    side = f"CASE WHEN ({turn}) >= 90 THEN 90D - abs({lat}) ELSE {foot} END"
    return F.expr(f"radians(greatest({gap}, {side}, {slack}D) - {slack}D) * {INNER_RADIUS}D")
