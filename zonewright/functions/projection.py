"""EPSG:6933 (cylindrical equal area, WGS 84) as SQL expressions over SQL text.

Forward and inverse follow Snyder, "Map Projections: A Working Manual" (1987),
ellipsoidal Lambert cylindrical equal-area, standard parallel 30 degrees.
"""

from __future__ import annotations

import math

# Fixed values of the WGS 84 ellipsoid and of the projection.
SEMI_MAJOR = 6378137.0
ECC = 0.08181919084262149
ECC2 = 0.0066943799901413165
SCALE = 0.8667510025721987


def _authalic_q(s: float) -> float:
    return (1 - ECC2) * (
        s / (1 - ECC2 * s * s) - math.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC)
    )


_Q_POLE = _authalic_q(1.0)
_E4, _E6 = ECC2**2, ECC2**3
_SIN2 = ECC2 / 3 + 31 * _E4 / 180 + 517 * _E6 / 5040
_SIN4 = 23 * _E4 / 360 + 251 * _E6 / 3780
_SIN6 = 761 * _E6 / 45360


def forward_x(lon: str) -> str:
    return f"(radians({lon}) * {SEMI_MAJOR * SCALE!r}D)"


def forward_y(lat: str) -> str:
    s = f"sin(radians({lat}))"
    q = (
        f"({s} / (1D - {s} * {s} * {ECC2!r}D)"
        f" - ln((1D - {s} * {ECC!r}D) / (1D + {s} * {ECC!r}D)) / {2 * ECC!r}D)"
    )
    return f"({q} * {(1 - ECC2) * SEMI_MAJOR / (2 * SCALE)!r}D)"


def inverse_x(x: str) -> str:
    return f"degrees({x} / {SEMI_MAJOR * SCALE!r}D)"


def inverse_y(y: str) -> str:
    beta = f"asin(greatest(least({y} * {2 * SCALE / (SEMI_MAJOR * _Q_POLE)!r}D, 1D), -1D))"
    return (
        f"degrees({beta} + sin({beta} * 2) * {_SIN2!r}D"
        f" + sin({beta} * 4) * {_SIN4!r}D + sin({beta} * 6) * {_SIN6!r}D)"
    )
