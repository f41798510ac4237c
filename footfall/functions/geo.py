"""EPSG:4326 <-> EPSG:5179 as column expressions (no per-row projection library).

EPSG:5179 is transverse Mercator on GRS80 (origin 38N 127.5E, scale 0.9996,
false easting 1,000,000 m, false northing 2,000,000 m; datum shift to WGS84 is
zero). The Krueger series to sixth order in n (Karney 2011) is accurate to well
under a millimetre inside the country.

The formulas are kept as ordered stages of SQL expressions: Spark evaluates them
as successive projections (each stage a named column, so a shared term is
computed once), and the same stages render as nested SELECTs for the SQL oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.constants import (
    GRS80_A, GRS80_INV_F, TM_FALSE_EASTING, TM_FALSE_NORTHING, TM_K0, TM_LAT0_DEG, TM_LON0_DEG,
)

_f = 1.0 / GRS80_INV_F
_n = _f / (2.0 - _f)
_e2 = _f * (2.0 - _f)
_e = math.sqrt(_e2)
_A = GRS80_A / (1.0 + _n) * (1.0 + _n**2 / 4.0 + _n**4 / 64.0 + _n**6 / 256.0)

_ALPHA = [
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180 - 127 * _n**5 / 288 + 7891 * _n**6 / 37800,
    13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440 + 281 * _n**5 / 630 - 1983433 * _n**6 / 1935360,
    61 * _n**3 / 240 - 103 * _n**4 / 140 + 15061 * _n**5 / 26880 + 167603 * _n**6 / 181440,
    49561 * _n**4 / 161280 - 179 * _n**5 / 168 + 6601661 * _n**6 / 7257600,
    34729 * _n**5 / 80640 - 3418889 * _n**6 / 1995840,
    212378941 * _n**6 / 319334400,
]
_BETA = [
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360 - 81 * _n**5 / 512 + 96199 * _n**6 / 604800,
    _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440 + 46 * _n**5 / 105 - 1118711 * _n**6 / 3870720,
    17 * _n**3 / 480 - 37 * _n**4 / 840 - 209 * _n**5 / 4480 + 5569 * _n**6 / 90720,
    4397 * _n**4 / 161280 - 11 * _n**5 / 504 - 830251 * _n**6 / 7257600,
    4583 * _n**5 / 161280 - 108847 * _n**6 / 3991680,
    20648693 * _n**6 / 638668800,
]
# conformal latitude -> geodetic latitude
_DELTA = [
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3 + 116 * _n**4 / 45 + 26 * _n**5 / 45 - 2854 * _n**6 / 675,
    7 * _n**2 / 3 - 8 * _n**3 / 5 - 227 * _n**4 / 45 + 2704 * _n**5 / 315 + 2323 * _n**6 / 945,
    56 * _n**3 / 15 - 136 * _n**4 / 35 - 1262 * _n**5 / 105 + 73814 * _n**6 / 2835,
    4279 * _n**4 / 630 - 332 * _n**5 / 35 - 399572 * _n**6 / 14175,
    4174 * _n**5 / 315 - 144838 * _n**6 / 6237,
    601676 * _n**6 / 22275,
]


def _xi0() -> float:
    phi0 = math.radians(TM_LAT0_DEG)
    t0 = math.sinh(math.atanh(math.sin(phi0)) - _e * math.atanh(_e * math.sin(phi0)))
    xi_p = math.atan(t0)
    return xi_p + sum(a * math.sin(2 * (j + 1) * xi_p) for j, a in enumerate(_ALPHA))


_XI0 = _xi0()
_KA = TM_K0 * _A


def _r(v: float) -> str:
    return repr(float(v))


Stages = list[tuple[str, str]]


def forward_stages(lon: str, lat: str, x_out: str, y_out: str, tmp: str = "_tm") -> Stages:
    """(lon, lat) degrees -> (x, y) metres."""
    phi, lam, t, xp, ep = (f"{tmp}_{s}" for s in ("phi", "lam", "t", "xip", "etap"))
    st: Stages = [
        (phi, f"radians({lat})"),
        (lam, f"radians({lon}) - {_r(math.radians(TM_LON0_DEG))}"),
        (t, f"sinh(atanh(sin({phi})) - {_r(_e)} * atanh({_r(_e)} * sin({phi})))"),
        (xp, f"atan2({t}, cos({lam}))"),
        (ep, f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"),
    ]
    xi = " + ".join([xp] + [f"{_r(a)} * sin({2 * (j + 1)} * {xp}) * cosh({2 * (j + 1)} * {ep})"
                            for j, a in enumerate(_ALPHA)])
    eta = " + ".join([ep] + [f"{_r(a)} * cos({2 * (j + 1)} * {xp}) * sinh({2 * (j + 1)} * {ep})"
                             for j, a in enumerate(_ALPHA)])
    st.append((x_out, f"{_r(TM_FALSE_EASTING)} + {_r(_KA)} * ({eta})"))
    st.append((y_out, f"{_r(TM_FALSE_NORTHING)} + {_r(_KA)} * (({xi}) - {_r(_XI0)})"))
    return st


def inverse_stages(x: str, y: str, lon_out: str, lat_out: str, tmp: str = "_tm") -> Stages:
    """(x, y) metres -> (lon, lat) degrees."""
    eta, xi, xp, ep, chi = (f"{tmp}_{s}" for s in ("eta", "xi", "xip", "etap", "chi"))
    st: Stages = [
        (eta, f"({x} - {_r(TM_FALSE_EASTING)}) / {_r(_KA)}"),
        (xi, f"({y} - {_r(TM_FALSE_NORTHING)}) / {_r(_KA)} + {_r(_XI0)}"),
    ]
    st.append((xp, " - ".join([xi] + [f"{_r(b)} * sin({2 * (j + 1)} * {xi}) * cosh({2 * (j + 1)} * {eta})"
                                      for j, b in enumerate(_BETA)])))
    st.append((ep, " - ".join([eta] + [f"{_r(b)} * cos({2 * (j + 1)} * {xi}) * sinh({2 * (j + 1)} * {eta})"
                                       for j, b in enumerate(_BETA)])))
    st.append((chi, f"asin(sin({xp}) / cosh({ep}))"))
    st.append((lat_out, "degrees(" + " + ".join([chi] + [f"{_r(d)} * sin({2 * (j + 1)} * {chi})"
                                                      for j, d in enumerate(_DELTA)]) + ")"))
    st.append((lon_out, f"{_r(TM_LON0_DEG)} + degrees(atan2(sinh({ep}), cos({xp})))"))
    return st


def apply_stages(df: DataFrame, stages: Stages, tmp: str = "_tm") -> DataFrame:
    """Add the stage columns in order, then drop the temporaries."""
    for name, expr in stages:
        df = df.withColumn(name, F.expr(expr))
    return df.drop(*[n for n, _ in stages if n.startswith(tmp + "_")])


def apply_stage_groups(df: DataFrame, groups: list[Stages], tmps: list[str]) -> DataFrame:
    """Several independent stage lists side by side: one projection per level, not per stage."""
    depth = max(len(g) for g in groups)
    for level in range(depth):
        df = df.withColumns({g[level][0]: F.expr(g[level][1]) for g in groups if level < len(g)})
    return df.drop(*[n for g, t in zip(groups, tmps) for n, _ in g if n.startswith(t + "_")])


def to_wgs84_many(df: DataFrame, points: list[tuple[str, str, str, str]]) -> DataFrame:
    """Inverse projections of several (x, y) -> (lon, lat) column pairs at once."""
    tmps = [f"_tm{i}" for i in range(len(points))]
    groups = [inverse_stages(f"CAST(`{x}` AS DOUBLE)", f"CAST(`{y}` AS DOUBLE)", lo, la, tmp=t)
              for (x, y, lo, la), t in zip(points, tmps)]
    return apply_stage_groups(df, groups, tmps)


def to_tm(df: DataFrame, lon: str, lat: str, x_out: str, y_out: str) -> DataFrame:
    return apply_stages(df, forward_stages(f"`{lon}`", f"`{lat}`", x_out, y_out))


def to_wgs84(df: DataFrame, x: str, y: str, lon_out: str, lat_out: str) -> DataFrame:
    return apply_stages(df, inverse_stages(f"CAST(`{x}` AS DOUBLE)", f"CAST(`{y}` AS DOUBLE)", lon_out, lat_out))


def stages_sql(source: str, keep: list[str], stages: Stages, tmp: str = "_tm") -> str:
    """Render stages as nested SELECTs over ``source`` (for the SQL oracle)."""
    sql = f"SELECT * FROM ({source})"
    for name, expr in stages:
        sql = f"SELECT *, {expr} AS {name} FROM ({sql})"
    outs = [n for n, _ in stages if not n.startswith(tmp + "_")]
    return f"SELECT {', '.join(keep + outs)} FROM ({sql})"
