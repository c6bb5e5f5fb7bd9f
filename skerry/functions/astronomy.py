"""Arguments of the tide: mean longitudes, node factors and phases of the harmonic constituents, over arrays of instants.

The formulas are those of Schureman's manual (1958) with the mean longitudes of Meeus; angles in degrees.
"""

from __future__ import annotations

import numpy as np

#: Of each constituent, in the order of their published numbers, the multiples of T (hour angle of the mean sun, from noon),
#: s, h, p, p1 and of 90 degrees, and the node terms (name, power) that it has.
CONSTITUENTS: dict[str, tuple[tuple[int, int, int, int, int, int], tuple[tuple[str, int], ...]]] = {
    "M2": ((2, -2, 2, 0, 0, 0), (("M2", 1),)),
    "S2": ((2, 0, 0, 0, 0, 0), ()),
    "N2": ((2, -3, 2, 1, 0, 0), (("M2", 1),)),
    "K1": ((1, 0, 1, 0, 0, -1), (("K1", 1),)),
    "M4": ((4, -4, 4, 0, 0, 0), (("M2", 2),)),
    "O1": ((1, -2, 1, 0, 0, 1), (("O1", 1),)),
    "M6": ((6, -6, 6, 0, 0, 0), (("M2", 3),)),
    "MK3": ((3, -2, 3, 0, 0, -1), (("M2", 1), ("K1", 1))),
    "S4": ((4, 0, 0, 0, 0, 0), ()),
    "MN4": ((4, -5, 4, 1, 0, 0), (("M2", 2),)),
    "NU2": ((2, -3, 4, -1, 0, 0), (("M2", 1),)),
    "S6": ((6, 0, 0, 0, 0, 0), ()),
    "MU2": ((2, -4, 4, 0, 0, 0), (("M2", 1),)),
    "2N2": ((2, -4, 2, 2, 0, 0), (("M2", 1),)),
    "OO1": ((1, 2, 1, 0, 0, -1), (("OO1", 1),)),
    "LAM2": ((2, -1, 0, 1, 0, 2), (("M2", 1),)),
    "S1": ((1, 0, 0, 0, 0, 0), ()),
    "M1": ((1, -1, 1, 0, 0, 1), (("M1", 1),)),
    "J1": ((1, 1, 1, -1, 0, -1), (("J1", 1),)),
    "MM": ((0, 1, 0, -1, 0, 0), (("MM", 1),)),
    "SSA": ((0, 0, 2, 0, 0, 0), ()),
    "SA": ((0, 0, 1, 0, 0, 0), ()),
    "MSF": ((0, 2, -2, 0, 0, 0), (("M2", -1),)),
    "MF": ((0, 2, 0, 0, 0, 0), (("MF", 1),)),
    "RHO": ((1, -3, 3, -1, 0, 1), (("O1", 1),)),
    "Q1": ((1, -3, 1, 1, 0, 1), (("O1", 1),)),
    "T2": ((2, 0, -1, 0, 1, 0), ()),
    "R2": ((2, 0, 1, 0, -1, 2), ()),
    "2Q1": ((1, -4, 1, 2, 0, 1), (("O1", 1),)),
    "P1": ((1, 0, -1, 0, 0, 1), ()),
    "2SM2": ((2, 2, -2, 0, 0, 0), (("M2", -1),)),
    "M3": ((3, -3, 3, 0, 0, 0), (("M3", 1),)),
    "L2": ((2, -1, 2, -1, 0, 2), (("L2", 1),)),
    "2MK3": ((3, -4, 3, 0, 0, 1), (("M2", 2), ("K1", -1))),
    "K2": ((2, 0, 2, 0, 0, 0), (("K2", 1),)),
    "M8": ((8, -8, 8, 0, 0, 0), (("M2", 4),)),
    "MS4": ((4, -2, 2, 0, 0, 0), (("M2", 1),)),
}
NAMES = tuple(CONSTITUENTS)
INCLINATION, OBLIQUITY = 5.145, 23.4392911  # of the moon's orbit and of the ecliptic


def longitudes(seconds: np.ndarray) -> dict[str, np.ndarray]:
    """T, s, h, p, p1 and N (the moon's node) at instants in seconds since 1970 UTC."""
    days = seconds / 86_400.0 - 10_957.5  # since noon of 2000-01-01
    c = days / 36_525.0
    return {
        "T": (days % 1.0) * 360.0,
        "s": 218.3164591 + 481_267.88134236 * c - 0.0013268 * c**2,
        "h": 280.46645 + 36_000.76983 * c + 0.0003032 * c**2,
        "p": 83.3532430 + 4_069.0137111 * c - 0.0103238 * c**2,
        "p1": 282.93734098 + 1.71945766 * c,
        "N": 125.0445550 - 1_934.1361849 * c + 0.0020762 * c**2,
    }


def node_terms(node: np.ndarray, perigee: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Node factor f and phase u (degrees) of each term, from the longitudes of the moon's node and perigee."""
    n, i, w = np.radians(node), np.radians(INCLINATION), np.radians(OBLIQUITY)
    big = np.arccos(np.cos(i) * np.cos(w) - np.sin(i) * np.sin(w) * np.cos(n))  # inclination of the orbit to the equator
    half = np.tan(n / 2)
    e1 = np.arctan(np.cos((w - i) / 2) / np.cos((w + i) / 2) * half)
    e2 = np.arctan(np.sin((w - i) / 2) / np.sin((w + i) / 2) * half)
    wind = 2 * np.round(n / (2 * np.pi)) * np.pi  # the half angles are those of the node within half a turn of 0
    xi, nu = (n - wind) - e1 - e2, e1 - e2
    s2, sq = np.sin(2 * big), np.sin(big) ** 2
    nu1 = np.arctan2(s2 * np.sin(nu), s2 * np.cos(nu) + 0.3347)
    nu2 = np.arctan2(sq * np.sin(2 * nu), sq * np.cos(2 * nu) + 0.0727)  # twice nu''
    c2, t2 = np.cos(big / 2), np.tan(big / 2)
    lat = np.radians(perigee) - xi
    f_m2, f_o1 = c2**4 / 0.9154, np.sin(big) * c2**2 / 0.3800
    m1 = np.sqrt(0.25 + 1.5 * np.cos(2 * lat) * np.cos(big) / c2**2 + 2.25 * np.cos(big) ** 2 / c2**4)
    q = np.arctan2((5 * np.cos(big) - 1) * np.sin(lat), (7 * np.cos(big) + 1) * np.cos(lat))
    l2 = np.sqrt(1 - 12 * t2**2 * np.cos(2 * lat) + 36 * t2**4)
    r = np.arctan2(np.sin(2 * lat), 1 / (6 * t2**2) - np.cos(2 * lat))
    deg = np.degrees
    return {
        "M2": (f_m2, deg(2 * xi - 2 * nu)),
        "O1": (f_o1, deg(2 * xi - nu)),
        "K1": (np.sqrt(0.8965 * s2**2 + 0.6001 * s2 * np.cos(nu) + 0.1006), -deg(nu1)),
        "K2": (np.sqrt(19.0444 * sq**2 + 2.7702 * sq * np.cos(2 * nu) + 0.0981), -deg(nu2)),
        "J1": (s2 / 0.7214, -deg(nu)),
        "OO1": (np.sin(big) * np.sin(big / 2) ** 2 / 0.01640, -deg(2 * xi + nu)),
        "MM": ((2 / 3 - sq) / 0.5021, np.zeros_like(n)),
        "MF": (sq / 0.1578, -deg(2 * xi)),
        "M3": (c2**6 / 0.8758, deg(3 * xi - 3 * nu)),
        "M1": (f_o1 * m1, deg(xi - nu + q)),
        "L2": (f_m2 * l2, deg(2 * xi - 2 * nu - r)),
    }


def tide_arguments(seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """f and V + u (degrees), each (constituents, instants), in the order of ``NAMES``."""
    at = longitudes(seconds)
    terms = node_terms(at["N"], at["p"])
    f, v = np.ones((len(NAMES), seconds.size)), np.empty((len(NAMES), seconds.size))
    for k, (multiples, nodes) in enumerate(CONSTITUENTS.values()):
        v[k] = sum(m * at[x] for m, x in zip(multiples, ("T", "s", "h", "p", "p1"), strict=False)) + 90.0 * multiples[5]
        for name, power in nodes:
            f[k] *= terms[name][0] ** abs(power)
            v[k] += power * terms[name][1]
    return f, v % 360.0
