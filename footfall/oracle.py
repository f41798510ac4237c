"""DuckDB SQL for each catalog query, over the pre-registered test tables.

Written independently of the Spark plans, in the most direct form: per-order
windows, interval joins between calendar and orders, ``quantile_disc`` /
``median`` over whole groups. Dates are rendered as ISO text and decimals as
doubles, like ``catalog.present``. Traps: DuckDB ``CAST(x AS INT)`` rounds (use
``trunc``), ``concat`` skips NULLs (use ``||``), ``substr(s, 0, n)`` drops a character.
The projection is Redfearn's series in powers of the longitude difference over an arc of the meridian that is
integrated numerically; its inverse finds the footpoint by Newton's method. The library uses another series.
"""

from __future__ import annotations

from footfall.catalog import (
    FILTER_RANGE, HEAVY_SHARE, LOADED_UNTIL, LONG_CELL, MID_MONTHS, MOVEMENT_RANGE, QUARTER_DAYS, SHORT_CELL, SNAPSHOT_RANGE,
)
from footfall.constants import (
    AGES, DISTRICTS, GRS80_A, GRS80_INV_F, HOURS, KINDS, SEXES, TM_FALSE_EASTING, TM_FALSE_NORTHING, TM_K0, TM_LAT0_DEG, TM_LON0_DEG,
)
from footfall.functions.geo import Stages, stages_sql


_E2 = (2 - 1 / GRS80_INV_F) / GRS80_INV_F
#: Nodes and weights of the five-point Gauss-Legendre rule.
_GAUSS = [(0.0, 0.5688888888888889), (0.5384693101056831, 0.47862867049936647), (-0.5384693101056831, 0.47862867049936647),
          (0.906179845938664, 0.23692688505618908), (-0.906179845938664, 0.23692688505618908)]


def _arc(phi: str) -> str:
    """Metres along the meridian from the origin's latitude to ``phi`` (radians): one Gauss rule, a few degrees long at most."""
    half, mid = f"(({phi} - radians({TM_LAT0_DEG})) / 2)", f"(({phi} + radians({TM_LAT0_DEG})) / 2)"
    terms = " + ".join(f"{w} * pow(1 - {_E2} * pow(sin({mid} + {half} * {x}), 2), -1.5)" for x, w in _GAUSS)
    return f"({GRS80_A * (1 - _E2)} * {half} * ({terms}))"


def _radii(phi: str, tmp: str) -> Stages:
    """nu and rho: radii of curvature across and along the meridian; psi: their ratio; tt: squared tangent."""
    return [(f"{tmp}_nu", f"{GRS80_A} / sqrt(1 - {_E2} * pow(sin({phi}), 2))"),
            (f"{tmp}_rho", f"{GRS80_A * (1 - _E2)} / pow(1 - {_E2} * pow(sin({phi}), 2), 1.5)"),
            (f"{tmp}_psi", f"{tmp}_nu / {tmp}_rho"), (f"{tmp}_tt", f"pow(tan({phi}), 2)")]


def forward_redfearn(lon: str, lat: str, x_out: str, y_out: str, tmp: str = "_tm") -> Stages:
    """(lon, lat) degrees -> (x, y) metres, for points within a few degrees of the central meridian."""
    phi, nu, p, t = (f"{tmp}_{c}" for c in ("phi", "nu", "psi", "tt"))
    q = f"{tmp}_q"                                     # (longitude difference x cosine)^2
    east = (f"1 + {q} / 6 * ({p} - {t}) + pow({q}, 2) / 120 * (4 * pow({p}, 3) * (1 - 6 * {t}) + pow({p}, 2) * (1 + 8 * {t}) - 2 * {p} * {t} + {t} * {t})"
            f" + pow({q}, 3) / 5040 * (61 - 479 * {t} + 179 * pow({t}, 2) - pow({t}, 3))")
    north = (f"{q} / 2 + pow({q}, 2) / 24 * (4 * pow({p}, 2) + {p} - {t}) + pow({q}, 3) / 720 * (8 * pow({p}, 4) * (11 - 24 * {t})"
             f" - 28 * pow({p}, 3) * (1 - 6 * {t}) + pow({p}, 2) * (1 - 32 * {t}) - 2 * {p} * {t} + {t} * {t})"
             f" + pow({q}, 4) / 40320 * (1385 - 3111 * {t} + 543 * pow({t}, 2) - pow({t}, 3))")
    return [(phi, f"radians({lat})"), (f"{tmp}_w", f"radians({lon} - {TM_LON0_DEG})"), *_radii(phi, tmp),
            (q, f"pow({tmp}_w * cos({phi}), 2)"),
            (x_out, f"{TM_FALSE_EASTING} + {TM_K0} * {nu} * {tmp}_w * cos({phi}) * ({east})"),
            (y_out, f"{TM_FALSE_NORTHING} + {TM_K0} * ({_arc(phi)} + {nu} * tan({phi}) * ({north}))")]


def inverse_redfearn(x: str, y: str, lon_out: str, lat_out: str, tmp: str = "_tm") -> Stages:
    """(x, y) metres -> (lon, lat) degrees."""
    nu, rho, p, t, d = (f"{tmp}_{c}" for c in ("nu", "rho", "psi", "tt", "d"))
    st: Stages = [(f"{tmp}_m", f"({y} - {TM_FALSE_NORTHING}) / {TM_K0}"),
                  (f"{tmp}_f0", f"radians({TM_LAT0_DEG}) + {tmp}_m / {GRS80_A}")]
    for i in range(4):
        f = f"{tmp}_f{i}"
        st.append((f"{tmp}_f{i + 1}", f"{f} + ({tmp}_m - {_arc(f)}) * pow(1 - {_E2} * pow(sin({f}), 2), 1.5) / {GRS80_A * (1 - _E2)}"))
    f = f"{tmp}_f4"
    st += [*_radii(f, tmp), (d, f"({x} - {TM_FALSE_EASTING}) / ({TM_K0} * {nu})")]
    lat = (f"pow({d}, 2) / 2 - pow({d}, 4) / 24 * (-4 * pow({p}, 2) + 9 * {p} * (1 - {t}) + 12 * {t})"
           f" + pow({d}, 6) / 720 * (8 * pow({p}, 4) * (11 - 24 * {t}) - 12 * pow({p}, 3) * (21 - 71 * {t})"
           f" + 15 * pow({p}, 2) * (15 - 98 * {t} + 15 * pow({t}, 2)) + 180 * {p} * (5 * {t} - 3 * pow({t}, 2)) + 360 * pow({t}, 2))"
           f" - pow({d}, 8) / 40320 * (1385 + 3633 * {t} + 4095 * pow({t}, 2) + 1575 * pow({t}, 3))")
    lon = (f"{d} - pow({d}, 3) / 6 * ({p} + 2 * {t})"
           f" + pow({d}, 5) / 120 * (-4 * pow({p}, 3) * (1 - 6 * {t}) + pow({p}, 2) * (9 - 68 * {t}) + 72 * {p} * {t} + 24 * pow({t}, 2))"
           f" - pow({d}, 7) / 5040 * (61 + 662 * {t} + 1320 * pow({t}, 2) + 720 * pow({t}, 3))")
    return [*st, (lat_out, f"degrees({f} - tan({f}) * {nu} / {rho} * ({lat}))"), (lon_out, f"{TM_LON0_DEG} + degrees(({lon}) / cos({f}))")]


def _d(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d') AS {name}"


FX_ORDERS = """fx_orders AS (
    SELECT o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS ordr_de,
           CAST(o_totalprice AS DECIMAL(18,2)) AS gds_ordr_gramt, o_orderkey AS ordr_key
      FROM orders)"""


def _calendar(start: str, end: str) -> str:
    return f"""cal AS (
    SELECT CAST(s AS DATE) AS snapshot_stdr_de,
           CAST(s - INTERVAL 12 MONTH AS DATE) AS interval_start_de,
           CAST(s - INTERVAL 1 DAY AS DATE) AS interval_end_de
      FROM generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 MONTH) t(s))"""


def _gaps(start: str, end: str) -> str:
    return f"""um AS (
    SELECT DISTINCT cust_id, CAST(date_trunc('month', ordr_de) AS DATE) AS ordr_ym_01
      FROM fx_orders WHERE ordr_de BETWEEN DATE '{start}' AND DATE '{end}'),
gaps AS (
    SELECT cust_id, ordr_ym_01, strftime(ordr_ym_01, '%Y-%m') AS ordr_ym,
           lag(ordr_ym_01) OVER (PARTITION BY cust_id ORDER BY ordr_ym_01) AS prior_ordr_ym,
           CAST(datediff('month', lag(ordr_ym_01) OVER (PARTITION BY cust_id ORDER BY ordr_ym_01), ordr_ym_01)
                AS BIGINT) AS ordr_month_diff
      FROM um)"""


MS, ME = MOVEMENT_RANGE
SS, SE = SNAPSHOT_RANGE
FS, FE = FILTER_RANGE

REPURCHASE_BASE = f"""WITH {FX_ORDERS},
{_calendar(SS, SE)},
src AS (
    SELECT cust_id, ordr_key, ordr_de,
           lag(ordr_de) OVER (PARTITION BY cust_id ORDER BY ordr_de, ordr_key) AS prior_purchase
      FROM fx_orders WHERE ordr_de BETWEEN DATE '{SS}' AND DATE '{SE}'),
gaps AS (
    SELECT *, datediff('day', prior_purchase, ordr_de) AS repurchase_cycle FROM src WHERE prior_purchase IS NOT NULL),
win AS (
    SELECT c.snapshot_stdr_de, g.cust_id, g.repurchase_cycle,
           row_number() OVER (PARTITION BY c.snapshot_stdr_de, g.cust_id ORDER BY g.ordr_de, g.ordr_key) AS rn
      FROM cal c JOIN gaps g ON g.ordr_de BETWEEN c.interval_start_de AND c.interval_end_de),
ua AS (
    SELECT snapshot_stdr_de, cust_id, avg(repurchase_cycle) AS user_repurchase_cycle_avg
      FROM win WHERE rn > 1 GROUP BY snapshot_stdr_de, cust_id)"""

SPEND_BASE = f"""WITH {FX_ORDERS},
{_calendar(SS, SE)},
us AS (
    SELECT c.snapshot_stdr_de, o.cust_id, sum(o.gds_ordr_gramt) AS user_gds_ordr_gramt,
           count(*) AS user_purchase_cnt
      FROM cal c JOIN fx_orders o ON o.ordr_de BETWEEN c.interval_start_de AND c.interval_end_de
     WHERE o.ordr_de BETWEEN DATE '{SS}' AND DATE '{SE}'
     GROUP BY c.snapshot_stdr_de, o.cust_id),
q AS (
    SELECT snapshot_stdr_de,
           quantile_disc(user_gds_ordr_gramt, 0.25) AS a1, quantile_disc(user_gds_ordr_gramt, 0.5) AS a2,
           quantile_disc(user_gds_ordr_gramt, 0.75) AS a3,
           quantile_disc(user_purchase_cnt, 0.25) AS c1, quantile_disc(user_purchase_cnt, 0.5) AS c2,
           quantile_disc(user_purchase_cnt, 0.75) AS c3
      FROM us GROUP BY snapshot_stdr_de),
res AS (
    SELECT c.snapshot_stdr_de AS ordr_de, c.interval_start_de, c.interval_end_de,
           CAST(a1 AS DOUBLE) AS all_user_gds_ordr_gramt_q1, CAST(a2 AS DOUBLE) AS all_user_gds_ordr_gramt_q2,
           CAST(a3 AS DOUBLE) AS all_user_gds_ordr_gramt_q3,
           CAST(c1 AS BIGINT) AS all_user_purchase_cnt_q1, CAST(c2 AS BIGINT) AS all_user_purchase_cnt_q2,
           CAST(c3 AS BIGINT) AS all_user_purchase_cnt_q3
      FROM cal c LEFT JOIN q USING (snapshot_stdr_de))"""

RES_COLS = """{d1}, {d2}, {d3}, all_user_gds_ordr_gramt_q1, all_user_gds_ordr_gramt_q2, all_user_gds_ordr_gramt_q3,
       all_user_purchase_cnt_q1, all_user_purchase_cnt_q2, all_user_purchase_cnt_q3""".format(
    d1=_d("ordr_de"), d2=_d("interval_start_de"), d3=_d("interval_end_de"))

MID_CALENDAR = f"""cal AS (
    SELECT CAST(s AS DATE) AS snapshot_stdr_de,
           CAST(s - INTERVAL {QUARTER_DAYS} DAY AS DATE) AS interval_start_de,
           CAST(s - INTERVAL 1 DAY AS DATE) AS interval_end_de
      FROM generate_series(TIMESTAMP '{MID_MONTHS[0]}', TIMESTAMP '{MID_MONTHS[1]}', INTERVAL 1 MONTH) t(s))"""

MID_MEMBERS = f"""WITH {FX_ORDERS}, {MID_CALENDAR}
SELECT {_d('snapshot_stdr_de')}, {_d('interval_start_de')}, {_d('interval_end_de')},
       count(o.ordr_key) AS n_orders, count(DISTINCT o.cust_id) AS n_users
  FROM cal c LEFT JOIN fx_orders o ON o.ordr_de BETWEEN c.interval_start_de AND c.interval_end_de
 GROUP BY snapshot_stdr_de, interval_start_de, interval_end_de"""

ORACLE: dict[str, str] = {
    "read_bounds": f"""WITH {FX_ORDERS}
SELECT min(cust_id) AS min_cust_id, max(cust_id) AS max_cust_id, count(*) AS n_orders
  FROM fx_orders WHERE ordr_de BETWEEN DATE '{MS}' AND DATE '{ME}'""",

    "orders_in_range": f"""WITH {FX_ORDERS}
SELECT cust_id, {_d('ordr_de')}, CAST(gds_ordr_gramt AS DOUBLE) AS gds_ordr_gramt, ordr_key
  FROM fx_orders WHERE ordr_de BETWEEN DATE '{FS}' AND DATE '{FE}'""",

    "user_months": f"""WITH {FX_ORDERS}, {_gaps(MS, ME)}
SELECT cust_id, {_d('ordr_ym_01')}, strftime(ordr_ym_01, '%Y-%m') AS ordr_ym FROM um""",

    "user_month_gap": f"""WITH {FX_ORDERS}, {_gaps(MS, ME)}
SELECT cust_id, {_d('ordr_ym_01')}, ordr_ym, {_d('prior_ordr_ym')}, ordr_month_diff FROM gaps""",

    "user_movement": f"""WITH {FX_ORDERS}, {_gaps(MS, ME)}
SELECT ordr_ym,
       count(*) FILTER (WHERE ordr_month_diff IS NULL) AS new_user,
       count(*) FILTER (WHERE ordr_month_diff >= 3) AS returning_user,
       count(*) FILTER (WHERE ordr_month_diff <= 2) AS existing_user,
       count(*) AS mau
  FROM gaps GROUP BY ordr_ym""",

    "movement_full_outer": f"""WITH {FX_ORDERS}, {_gaps(MS, ME)},
n AS (SELECT ordr_ym, count(*) AS new_user FROM gaps WHERE ordr_month_diff IS NULL GROUP BY ordr_ym),
r AS (SELECT ordr_ym, count(*) AS returning_user FROM gaps WHERE ordr_month_diff >= 3 GROUP BY ordr_ym),
e AS (SELECT ordr_ym, count(*) AS existing_user FROM gaps WHERE ordr_month_diff <= 2 GROUP BY ordr_ym),
j AS (SELECT * FROM n FULL JOIN r USING (ordr_ym) FULL JOIN e USING (ordr_ym))
SELECT ordr_ym, coalesce(new_user, 0) AS new_user, coalesce(returning_user, 0) AS returning_user,
       coalesce(existing_user, 0) AS existing_user,
       coalesce(new_user, 0) + coalesce(returning_user, 0) + coalesce(existing_user, 0) AS mau
  FROM j""",

    "snapshot_calendar": f"""WITH {FX_ORDERS},
b AS (SELECT date_trunc('month', min(ordr_de)) AS lo, date_trunc('month', max(ordr_de)) + INTERVAL 12 MONTH AS hi
        FROM fx_orders)
SELECT strftime(CAST(s AS DATE), '%Y-%m-%d') AS snapshot_stdr_de,
       strftime(CAST(s - INTERVAL 12 MONTH AS DATE), '%Y-%m-%d') AS interval_start_de,
       strftime(CAST(s - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS interval_end_de
  FROM b, generate_series(b.lo, b.hi, INTERVAL 1 MONTH) t(s)""",

    "month_bounds": f"""WITH {FX_ORDERS},
y AS (SELECT DISTINCT year(ordr_de) AS year FROM fx_orders),
m AS (SELECT CAST(y.year AS INTEGER) AS year, CAST(g.month AS INTEGER) AS month,
             make_date(CAST(y.year AS INTEGER), CAST(g.month AS INTEGER), 1) AS first
        FROM y, range(1, 13) g(month))
SELECT year, month, strftime(first, '%Y%m%d') AS first_date, strftime(last_day(first), '%Y%m%d') AS last_date FROM m""",

    "trailing_members": f"""WITH {FX_ORDERS}, {_calendar(SS, SE)},
t AS (SELECT c.snapshot_stdr_de, count(*) AS n_orders, count(DISTINCT o.cust_id) AS n_users
        FROM cal c JOIN fx_orders o ON o.ordr_de BETWEEN c.interval_start_de AND c.interval_end_de
       WHERE o.ordr_de BETWEEN DATE '{SS}' AND DATE '{SE}'
       GROUP BY c.snapshot_stdr_de)
SELECT {_d('snapshot_stdr_de')}, {_d('interval_start_de')}, {_d('interval_end_de')},
       coalesce(n_orders, 0) AS n_orders, coalesce(n_users, 0) AS n_users
  FROM cal LEFT JOIN t USING (snapshot_stdr_de)""",

    "interval_members": MID_MEMBERS,

    "members_mid_month": MID_MEMBERS,

    "user_spend_mid_month": f"""WITH {FX_ORDERS}, {MID_CALENDAR}
SELECT {_d('snapshot_stdr_de')}, o.cust_id, CAST(sum(o.gds_ordr_gramt) AS DOUBLE) AS user_gds_ordr_gramt,
       count(*) AS user_purchase_cnt
  FROM cal c JOIN fx_orders o ON o.ordr_de BETWEEN c.interval_start_de AND c.interval_end_de
 WHERE o.ordr_de BETWEEN DATE '{SS}' AND DATE '{SE}'
 GROUP BY snapshot_stdr_de, o.cust_id""",

    "repurchase_gaps": f"""WITH {FX_ORDERS},
src AS (
    SELECT cust_id, ordr_key, ordr_de,
           lag(ordr_de) OVER (PARTITION BY cust_id ORDER BY ordr_de, ordr_key) AS prior_purchase
      FROM fx_orders WHERE ordr_de BETWEEN DATE '{SS}' AND DATE '{SE}')
SELECT cust_id, ordr_key, {_d('ordr_de')}, {_d('prior_purchase')},
       CAST(datediff('day', prior_purchase, ordr_de) AS INTEGER) AS repurchase_cycle
  FROM src WHERE prior_purchase IS NOT NULL""",

    "user_repurchase": REPURCHASE_BASE + f"""
SELECT {_d('snapshot_stdr_de')}, cust_id, round(user_repurchase_cycle_avg, 6) AS user_repurchase_cycle_avg FROM ua""",

    "repurchase_median": REPURCHASE_BASE + f""",
med AS (SELECT snapshot_stdr_de, CAST(ceil(median(user_repurchase_cycle_avg)) AS BIGINT) AS m
          FROM ua GROUP BY snapshot_stdr_de)
SELECT {_d('snapshot_stdr_de')}, {_d('interval_start_de')}, {_d('interval_end_de')},
       m AS all_repurchase_cycle_median
  FROM cal LEFT JOIN med USING (snapshot_stdr_de)""",

    "user_spend": SPEND_BASE + f"""
SELECT {_d('snapshot_stdr_de')}, cust_id, CAST(user_gds_ordr_gramt AS DOUBLE) AS user_gds_ordr_gramt,
       user_purchase_cnt FROM us""",

    "user_spend_stats": SPEND_BASE + """,
one AS (SELECT CAST(user_gds_ordr_gramt AS DOUBLE) AS a, CAST(user_purchase_cnt AS DOUBLE) AS c
          FROM us WHERE snapshot_stdr_de = (SELECT max(snapshot_stdr_de) FROM us)),
s AS (SELECT CAST(count(a) AS DOUBLE) AS count_a, avg(a) AS mean_a, stddev_samp(a) AS stddev_a, min(a) AS min_a,
             max(a) AS max_a, CAST(count(c) AS DOUBLE) AS count_c, avg(c) AS mean_c, stddev_samp(c) AS stddev_c,
             min(c) AS min_c, max(c) AS max_c FROM one)
SELECT 'count' AS summary, round(count_a, 4) AS user_gds_ordr_gramt, round(count_c, 6) AS user_purchase_cnt FROM s
UNION ALL SELECT 'mean', round(mean_a, 4), round(mean_c, 6) FROM s
UNION ALL SELECT 'stddev', round(stddev_a, 4), round(stddev_c, 6) FROM s
UNION ALL SELECT 'min', round(min_a, 4), round(min_c, 6) FROM s
UNION ALL SELECT 'max', round(max_a, 4), round(max_c, 6) FROM s""",

    "spend_quartiles": SPEND_BASE + f"""
SELECT {RES_COLS} FROM res""",

    "latest_snapshots": SPEND_BASE + f"""
SELECT {RES_COLS} FROM res ORDER BY res.ordr_de DESC LIMIT 10""",
}


# ---------------------------------------------------------------- population fixtures in SQL


_CODES = "[" + ", ".join(f"'{c}'" for _, c in DISTRICTS) + "]"
_TIME_COLS = [f"{k}_t_{h}" for k in KINDS for h in HOURS]
_SA_COLS = [f"{k}_{s}_{a}" for k in KINDS for s in SEXES for a in AGES]
_KEYS = "std_ymd, hcode, x_coord, y_coord"


def _pop_long(x_expr: str, y_expr: str, day: str = "ts") -> str:
    return f"""SELECT event_id, user_id,
           CASE event_type WHEN 'view' THEN 'h' WHEN 'signup' THEN 'h' WHEN 'click' THEN 'w' WHEN 'error' THEN 'w'
                ELSE 'v' END AS kind,
           strftime({day}, '%Y%m%d') AS std_ymd, strftime(ts, '%H') AS tm,
           ({_CODES})[user_id % 10 + 1] || '51000' AS hcode,
           CAST({x_expr} AS DECIMAL(18,6)) AS x_coord, CAST({y_expr} AS DECIMAL(18,6)) AS y_coord,
           CAST(value AS DECIMAL(18,2)) AS v
      FROM events"""


IC_X = "746758.991784 + 25 + 50 * (user_id % 20)"
IC_Y = "1883404.14739 + 25 + 50 * (user_id // 20)"
B_X = "1077058.991787 + 25 + 50 * (user_id % 20) - CASE WHEN user_id % 19 = 0 THEN 2000 ELSE 0 END"
B_Y = "1780604.147390 - 25 - 50 * (user_id // 20) - CASE WHEN user_id % 17 = 0 THEN 50000 ELSE 0 END"


def _pivot(source: str, label: str, names: list[str]) -> str:
    sums = ",\n           ".join(f"sum(CASE WHEN {label} = '{n}' THEN v ELSE 0 END) AS {n}" for n in names)
    return f"SELECT {_KEYS},\n           {sums},\n           'B' AS block_cd\n      FROM {source} GROUP BY {_KEYS}"


POP_FIXTURES = f"""fx_pop_long AS ({_pop_long(IC_X, IC_Y)}),
fx_time_pop AS ({_pivot('fx_pop_long', "kind || '_t_' || tm", _TIME_COLS)}),
fx_sex_age AS ({_pivot("(SELECT * REPLACE (CAST(x_coord + CASE WHEN user_id % 13 = 0 THEN 7 ELSE 0 END AS DECIMAL(18,6)) AS x_coord) "
                       "FROM fx_pop_long)",
                       "kind || '_' || (CASE WHEN event_id % 2 = 0 THEN 'm' ELSE 'w' END) || '_' || "
                       "CAST((event_id % 7 + 1) * 10 AS VARCHAR)", _SA_COLS)}),
fx_ic_grid AS (
    SELECT printf('GRID%06d', user_id + 1) AS grid_id,
           CAST(user_id % 20 AS VARCHAR) || ',' || CAST(user_id // 20 AS VARCHAR) AS mtr_no,
           CAST({IC_X} AS DECIMAL(18,6)) AS cnt_x_crd, CAST({IC_Y} AS DECIMAL(18,6)) AS cnt_y_crd,
           ({_CODES})[user_id % 10 + 1] || '51000' AS admd_cd
      FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id % 7 <> 0)"""

BOUNDED_FIXTURES = f"""fx_b_long AS ({_pop_long(B_X, B_Y, "CAST(ts AS DATE) - to_months(CAST(event_id % 3 AS INTEGER))")}),
fx_bounded_pop AS (SELECT *, substr(std_ymd, 1, 6) AS pt_stdr_ym FROM ({_pivot('fx_b_long', "kind || '_t_' || tm", _TIME_COLS)})),
fx_pcel_grid AS (
    SELECT printf('GRID%06d', row_number() OVER (ORDER BY row_no, clm_no)) AS grid_id, *
      FROM (SELECT CAST(user_id % 20 AS INTEGER) AS row_no, CAST(user_id // 20 AS INTEGER) AS clm_no,
                   CAST(user_id % 20 AS VARCHAR) || ',' || CAST(user_id // 20 AS VARCHAR) AS mtr_no,
                   ({_CODES})[user_id % 10 + 1] || '51000' AS admd_cd,
                   CAST({B_X} AS DECIMAL(18,6)) AS cnt_x_crd, CAST({B_Y} AS DECIMAL(18,6)) AS cnt_y_crd
              FROM (SELECT DISTINCT user_id FROM fx_b_long) u
             WHERE user_id % 3 <> 0 AND user_id % 19 <> 0 AND user_id % 17 <> 0) c),
fx_cctv_cells AS (
    SELECT CAST(s_suppkey % 20 AS VARCHAR) || ',' || CAST(s_suppkey % 5 AS VARCHAR) AS mtr_no, 1.0 AS lo FROM supplier),
cctv_counts AS (SELECT mtr_no, count(lo) AS cctv_co FROM fx_cctv_cells GROUP BY mtr_no)"""

CCTV_POINTS = """fx_cctv_points AS (
    SELECT CAST(35.608 + (s_suppkey % 34) * 0.012 AS DOUBLE) AS la,
           CASE WHEN s_suppkey % 29 = 0 THEN NULL
                ELSE CAST(128.351 + (s_suppkey % 41) * 0.01 + CASE WHEN s_suppkey % 23 = 0 THEN 1 ELSE 0 END AS DOUBLE)
           END AS lo
      FROM supplier),
in_box AS (
    SELECT la, lo FROM fx_cctv_points
     WHERE lo BETWEEN 128.351 AND 128.761 AND la BETWEEN 35.608 AND 36.016 AND la IS NOT NULL AND lo IS NOT NULL)"""


def _ic_idx(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    row = f"CAST(trunc(({p}x_coord - 746758.991784) / 50) AS INTEGER)"
    col = f"CAST(trunc(({p}y_coord - 1883404.14739) / 50) AS INTEGER)"
    return row, col


_ROW, _COL = _ic_idx()
_HOUR_LIST = "[" + ", ".join(f"'{h}'" for h in HOURS) + "]"


def _list(cols: list[str]) -> str:
    return "[" + ", ".join(cols) + "]"


_HOUR_SUMS = [f"h_t_{h} + w_t_{h} + v_t_{h}" for h in HOURS]
_EIGHTHS = ", ".join(f"CAST({c} AS DOUBLE) / 8 AS {c}" for c in _TIME_COLS)

_B_ROW = "CAST(trunc((cnt_x_crd - 1077058.991787) / 50) AS INTEGER)"
_B_COL = "CAST(trunc((1780604.147390 - cnt_y_crd) / 50) AS INTEGER)"

BOUNDED_DAYS = f"""src AS (
    SELECT std_ymd AS stdr_de, hcode AS admd_cd, x_coord AS cnt_x_crd, y_coord AS cnt_y_crd,
           unnest({_HOUR_LIST}) AS stdr_tm, unnest({_list(_HOUR_SUMS)}) AS s
      FROM fx_bounded_pop),
ps AS (
    SELECT stdr_de, admd_cd, cnt_x_crd, cnt_y_crd, stdr_tm, sum(s) AS fpop_co
      FROM src GROUP BY stdr_de, admd_cd, cnt_x_crd, cnt_y_crd, stdr_tm),
idx AS (
    SELECT *, {_B_ROW} AS row_no, {_B_COL} AS clm_no,
           CAST({_B_ROW} AS VARCHAR) || ',' || CAST({_B_COL} AS VARCHAR) AS mtr_no
      FROM ps),
facts AS (
    SELECT i.*, g.grid_id FROM idx i LEFT JOIN fx_pcel_grid g USING (mtr_no)
     WHERE i.row_no >= 0 AND i.clm_no <= 910),
unseen AS (
    SELECT mtr_no, admd_cd, cnt_x_crd, cnt_y_crd, row_no, clm_no FROM (
        SELECT *, row_number() OVER (PARTITION BY mtr_no ORDER BY admd_cd, cnt_x_crd, cnt_y_crd) AS rn
          FROM (SELECT DISTINCT mtr_no, admd_cd, cnt_x_crd, cnt_y_crd, row_no, clm_no FROM facts WHERE grid_id IS NULL) d)
     WHERE rn = 1)"""

_CORNERS = """SELECT *, CAST(cnt_x_crd - 25 AS DECIMAL(18,8)) AS min_x_crd, CAST(cnt_x_crd + 25 AS DECIMAL(18,8)) AS max_x_crd,
       CAST(cnt_y_crd - 25 AS DECIMAL(18,8)) AS min_y_crd, CAST(cnt_y_crd + 25 AS DECIMAL(18,8)) AS max_y_crd FROM {src}"""


def _wgs84(src: str, keep: list[str]) -> str:
    """Corners + the three inverse projections, as nested SELECTs."""
    sql = _CORNERS.format(src=f"({src})")
    cols = keep + ["min_x_crd", "max_x_crd", "min_y_crd", "max_y_crd"]
    for x, y, lo, la in (("cnt_x_crd", "cnt_y_crd", "cnt_lo", "cnt_la"), ("min_x_crd", "min_y_crd", "min_lo", "min_la"),
                         ("max_x_crd", "max_y_crd", "max_lo", "max_la")):
        sql = stages_sql(sql, cols, inverse_redfearn(f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)", lo, la))
        cols = cols + [la, lo]
    return sql


def _r7(c: str) -> str:
    return f"round({c}, 7) AS {c}"


_FEMALE_TERMS = " + ".join(f"{k}_pop * {k}_w_{a}_r" for k in KINDS for a in AGES)


def _ratio_cols() -> str:
    out = []
    for k in KINDS:
        total = " + ".join(f"{k}_{s}_{a}" for s in SEXES for a in AGES)
        for a in AGES:
            out.append(f"CASE WHEN ({total}) = 0 THEN 0.0 ELSE CAST({k}_w_{a} AS DOUBLE) / CAST(({total}) AS DOUBLE) END"
                       f" AS {k}_w_{a}_r")
    return ",\n           ".join(out)


_IN_DISTRICTS = " OR ".join(f"starts_with(hcode, '{c}')" for _, c in DISTRICTS)
_DISTRICT_VALUES = ", ".join(f"('{n}', '{c}')" for n, c in DISTRICTS)
_STACK = (f"unnest({_HOUR_LIST}) AS tm, unnest({_list([f'h_t_{h}' for h in HOURS])}) AS h_pop, "
          f"unnest({_list([f'w_t_{h}' for h in HOURS])}) AS w_pop, unnest({_list([f'v_t_{h}' for h in HOURS])}) AS v_pop")
_NONZERO = " OR ".join(f"CAST(trunc({k}_pop) AS INTEGER) <> 0" for k in KINDS)

ORACLE.update({
    "csv_feed": f"""WITH {POP_FIXTURES}
SELECT std_ymd, hcode, CAST(x_coord AS DOUBLE) AS x_coord, CAST(y_coord AS DOUBLE) AS y_coord, {_EIGHTHS}, block_cd
  FROM fx_time_pop""",

    "district_prefix": f"""WITH {POP_FIXTURES},
d AS (SELECT * FROM (VALUES {_DISTRICT_VALUES}) t(gu_nm, gu_cd))
SELECT std_ymd, hcode, substr(hcode, 1, 5) AS gu_cd, d.gu_nm, CAST(x_coord AS DOUBLE) AS x_coord,
       CAST(y_coord AS DOUBLE) AS y_coord
  FROM fx_time_pop LEFT JOIN d ON d.gu_cd = substr(hcode, 1, 5)
 WHERE {_IN_DISTRICTS}""",

    "melt_hourly": f"""WITH {POP_FIXTURES}
SELECT std_ymd AS stdr_de, concat_ws(',', {_ROW}, {_COL}) AS mtr_no, substr(hcode, 1, 5) AS gu_cd,
       unnest({_HOUR_LIST}) AS stdr_tm, CAST(unnest({_list(_HOUR_SUMS)}) AS DOUBLE) AS value
  FROM fx_time_pop""",

    "unpivot_kinds": f"""WITH {POP_FIXTURES},
s AS (SELECT {_KEYS}, {_STACK} FROM fx_time_pop)
SELECT std_ymd, hcode, CAST(x_coord AS DOUBLE) AS x_coord, CAST(y_coord AS DOUBLE) AS y_coord, tm,
       CAST(h_pop AS DOUBLE) AS h_pop, CAST(w_pop AS DOUBLE) AS w_pop, CAST(v_pop AS DOUBLE) AS v_pop FROM s""",

    "nonzero_population": f"""WITH {POP_FIXTURES},
s AS (SELECT {_KEYS}, {_STACK} FROM fx_time_pop)
SELECT std_ymd, hcode, CAST(x_coord AS DOUBLE) AS x_coord, CAST(y_coord AS DOUBLE) AS y_coord, tm,
       CAST(h_pop AS DOUBLE) AS h_pop, CAST(w_pop AS DOUBLE) AS w_pop, CAST(v_pop AS DOUBLE) AS v_pop
  FROM s WHERE {_NONZERO}""",

    "grid_index": f"""WITH {POP_FIXTURES}
SELECT std_ymd, hcode, CAST(x_coord AS DOUBLE) AS x_coord, CAST(y_coord AS DOUBLE) AS y_coord,
       {_ROW} AS row_id, {_COL} AS col_id, concat_ws(',', {_ROW}, {_COL}) AS mtr_no
  FROM fx_time_pop""",

    "cell_lookup": f"""WITH {POP_FIXTURES},
i AS (SELECT std_ymd, hcode, concat_ws(',', {_ROW}, {_COL}) AS mtr_no FROM fx_time_pop)
SELECT i.mtr_no, i.std_ymd, i.hcode, g.grid_id FROM i LEFT JOIN fx_ic_grid g ON g.mtr_no = i.mtr_no""",

    "cell_lookup_xy": f"""WITH {POP_FIXTURES}
SELECT t.std_ymd, t.hcode, CAST(t.x_coord AS DOUBLE) AS x_coord, CAST(t.y_coord AS DOUBLE) AS y_coord, g.grid_id
  FROM fx_time_pop t JOIN fx_ic_grid g
    ON g.cnt_x_crd = t.x_coord AND g.cnt_y_crd = t.y_coord AND substr(g.admd_cd, 1, 5) = substr(t.hcode, 1, 5)""",

    "grid_population": f"""WITH {POP_FIXTURES},
m AS (SELECT std_ymd AS stdr_de, concat_ws(',', {_ROW}, {_COL}) AS mtr_no, substr(hcode, 1, 5) AS gu_cd,
             unnest({_HOUR_LIST}) AS stdr_tm, unnest({_list(_HOUR_SUMS)}) AS value
        FROM fx_time_pop WHERE std_ymd BETWEEN '20240101' AND '20241231' AND ({_IN_DISTRICTS})),
p AS (SELECT stdr_de, stdr_tm, mtr_no, gu_cd, sum(value) AS fpop_co FROM m GROUP BY stdr_de, stdr_tm, mtr_no, gu_cd)
SELECT p.stdr_de, p.stdr_tm, p.gu_cd, CAST(p.fpop_co AS DOUBLE) AS fpop_co, g.grid_id
  FROM p LEFT JOIN fx_ic_grid g USING (mtr_no)""",

    "sex_age_ratio": f"""WITH {POP_FIXTURES},
r AS (SELECT {_KEYS},
           {_ratio_cols()}
        FROM fx_sex_age)
SELECT std_ymd, hcode, CAST(x_coord AS DOUBLE) AS x_coord, CAST(y_coord AS DOUBLE) AS y_coord,
       {', '.join(f'round({k}_w_{a}_r, 6) AS {k}_w_{a}_r' for k in KINDS for a in AGES)}
  FROM r""",

    "female_population": f"""WITH {POP_FIXTURES},
t AS (SELECT f.*, g.grid_id FROM fx_time_pop f JOIN fx_ic_grid g
        ON g.cnt_x_crd = f.x_coord AND g.cnt_y_crd = f.y_coord AND starts_with(g.admd_cd, substr(f.hcode, 1, 5))
       WHERE {_IN_DISTRICTS.replace('hcode', 'f.hcode')}),
h AS (SELECT {_KEYS}, grid_id, {_STACK} FROM t),
nz AS (SELECT * FROM h WHERE {_NONZERO}),
r AS (SELECT {_KEYS},
           {_ratio_cols()}
        FROM fx_sex_age WHERE {_IN_DISTRICTS}),
m AS (SELECT nz.std_ymd, nz.hcode, nz.tm, nz.grid_id, {_FEMALE_TERMS} AS total
        FROM nz JOIN r USING (std_ymd, hcode, x_coord, y_coord))
SELECT std_ymd AS stdr_de, tm AS stdr_tm, grid_id, round(total, 6) AS pcel_tmzn_fml_co, substr(hcode, 1, 5) AS gu_cd
  FROM m WHERE total <> 0""",

    "grid_bounds": f"""WITH {BOUNDED_FIXTURES},
c AS (SELECT DISTINCT hcode AS admd_cd, x_coord AS cnt_x_crd, y_coord AS cnt_y_crd FROM fx_bounded_pop),
i AS (SELECT *, {_B_ROW} AS row_no, {_B_COL} AS clm_no FROM c)
SELECT admd_cd, CAST(cnt_x_crd AS DOUBLE) AS cnt_x_crd, CAST(cnt_y_crd AS DOUBLE) AS cnt_y_crd, row_no, clm_no,
       CAST(row_no AS VARCHAR) || ',' || CAST(clm_no AS VARCHAR) AS mtr_no
  FROM i WHERE row_no >= 0 AND clm_no <= 910""",

    "grid_population_bounded": f"""WITH {BOUNDED_FIXTURES}, {BOUNDED_DAYS}
SELECT stdr_de, stdr_tm, grid_id, admd_cd, substr(admd_cd, 1, 5) AS gu_cd, CAST(fpop_co AS DOUBLE) AS fpop_co,
       substr(stdr_de, 1, 6) AS pt_stdr_ym
  FROM facts""",

    "unseen_cells": f"""WITH {BOUNDED_FIXTURES}, {BOUNDED_DAYS}
SELECT mtr_no, admd_cd, CAST(cnt_x_crd AS DOUBLE) AS cnt_x_crd, CAST(cnt_y_crd AS DOUBLE) AS cnt_y_crd, row_no, clm_no
  FROM unseen""",

    "register_cells": f"""WITH {BOUNDED_FIXTURES}, {BOUNDED_DAYS},
last AS (SELECT coalesce(max(CAST(regexp_extract(grid_id, '([0-9]+)$', 1) AS BIGINT)), 0) AS n FROM fx_pcel_grid),
ided AS (SELECT u.*, printf('GRID%06d', last.n + row_number() OVER (ORDER BY row_no, clm_no)) AS grid_id
           FROM unseen u, last),
geo AS ({_wgs84('SELECT * FROM ided', ['grid_id', 'row_no', 'clm_no', 'mtr_no', 'admd_cd', 'cnt_x_crd', 'cnt_y_crd'])})
SELECT grid_id, row_no, clm_no, mtr_no, admd_cd, CAST(cnt_x_crd AS DOUBLE) AS cnt_x_crd,
       CAST(cnt_y_crd AS DOUBLE) AS cnt_y_crd, CAST(min_x_crd AS DOUBLE) AS min_x_crd, CAST(min_y_crd AS DOUBLE) AS min_y_crd,
       CAST(max_x_crd AS DOUBLE) AS max_x_crd, CAST(max_y_crd AS DOUBLE) AS max_y_crd,
       {_r7('cnt_lo')}, {_r7('cnt_la')}, {_r7('min_lo')}, {_r7('min_la')}, {_r7('max_lo')}, {_r7('max_la')},
       CAST(coalesce(c.cctv_co, 0) AS BIGINT) AS cctv_co
  FROM geo LEFT JOIN cctv_counts c USING (mtr_no)""",

    "points_in_box": f"""WITH {CCTV_POINTS}
SELECT la, lo FROM in_box""",

    "project_points": f"""WITH {CCTV_POINTS},
p AS ({stages_sql('SELECT * FROM in_box', ['la', 'lo'], forward_redfearn('lo', 'la', 'x_crd', 'y_crd'))}),
i AS (SELECT *, CAST(trunc((x_crd - 1077058.991787) / 50) AS INTEGER) AS row_no,
             CAST(trunc((1780604.147390 - y_crd) / 50) AS INTEGER) AS clm_no FROM p)
SELECT la, lo, round(x_crd, 3) AS x_crd, round(y_crd, 3) AS y_crd, row_no, clm_no,
       CAST(row_no AS VARCHAR) || ',' || CAST(clm_no AS VARCHAR) AS mtr_no FROM i""",

    "cctv_per_cell": f"""WITH {CCTV_POINTS},
p AS ({stages_sql('SELECT * FROM in_box', ['la', 'lo'], forward_redfearn('lo', 'la', 'x_crd', 'y_crd'))})
SELECT CAST(CAST(trunc((x_crd - 1077058.991787) / 50) AS INTEGER) AS VARCHAR) || ',' ||
       CAST(CAST(trunc((1780604.147390 - y_crd) / 50) AS INTEGER) AS VARCHAR) AS mtr_no, count(lo) AS cctv_co
  FROM p GROUP BY 1""",

    "cells_wgs84": f"""WITH {BOUNDED_FIXTURES},
geo AS ({_wgs84('SELECT grid_id, cnt_x_crd, cnt_y_crd FROM fx_pcel_grid', ['grid_id', 'cnt_x_crd', 'cnt_y_crd'])})
SELECT grid_id, {_r7('cnt_lo')}, {_r7('cnt_la')}, {_r7('min_lo')}, {_r7('min_la')}, {_r7('max_lo')}, {_r7('max_la')}
  FROM geo""",

    "cells_with_cctv": f"""WITH {BOUNDED_FIXTURES}, {BOUNDED_DAYS}
SELECT u.mtr_no, CAST(coalesce(c.cctv_co, 0) AS BIGINT) AS cctv_co FROM unseen u LEFT JOIN cctv_counts c USING (mtr_no)""",

    "new_months": """SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS year_month
  FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) > 200006""",
})

ORACLE.update({
    "load_month": f"""WITH {FX_ORDERS}
SELECT cust_id, {_d('ordr_de')}, CAST(gds_ordr_gramt AS DOUBLE) AS gds_ordr_gramt, ordr_key,
       strftime(ordr_de, '%Y%m') AS pt_stdr_ym
  FROM fx_orders""",

    "grid_intake": f"""WITH {BOUNDED_FIXTURES}, {BOUNDED_DAYS},
last AS (SELECT coalesce(max(CAST(regexp_extract(grid_id, '([0-9]+)$', 1) AS BIGINT)), 0) AS n FROM fx_pcel_grid),
ided AS (SELECT u.mtr_no, printf('GRID%06d', last.n + row_number() OVER (ORDER BY row_no, clm_no)) AS grid_id
           FROM unseen u, last)
SELECT f.stdr_de, f.stdr_tm, coalesce(f.grid_id, n.grid_id) AS grid_id, f.admd_cd, substr(f.admd_cd, 1, 5) AS gu_cd,
       CAST(f.fpop_co AS DOUBLE) AS fpop_co, substr(f.stdr_de, 1, 6) AS pt_stdr_ym
  FROM facts f LEFT JOIN ided n USING (mtr_no)""",
})
ORACLE["intake_stream"] = ORACLE["load_month"]

ORACLE["partition_skew"] = """SELECT CAST(o_custkey % 16 AS INTEGER) AS partition_id, count(*) AS n_rows
  FROM orders GROUP BY 1"""

# the CSV feeds carry eighths: shares stay as they are, hours shrink and more of them fall below one
ORACLE["female_population_colocated"] = ORACLE["female_population"]
ORACLE["female_population_csv"] = (
    ORACLE["female_population"]
    .replace("h AS (SELECT", f"t8 AS (SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) / 8 AS {c}' for c in _TIME_COLS)}) FROM t),\nh AS (SELECT")
    .replace("FROM t),\nnz", "FROM t8),\nnz"))

ORACLE.update({
    "heavy_keys": f"""WITH {FX_ORDERS},
p AS (SELECT CAST(cust_id % 16 AS INTEGER) AS partition_id, cust_id, count(*) AS n_rows FROM fx_orders GROUP BY ALL),
t AS (SELECT *, CAST(sum(n_rows) OVER (PARTITION BY partition_id) AS BIGINT) AS partition_rows FROM p)
SELECT partition_id, cust_id, n_rows, partition_rows FROM t WHERE n_rows >= {HEAVY_SHARE} * partition_rows""",

    "load_ledger": f"""WITH {FX_ORDERS},
m AS (SELECT strftime(ordr_de, '%Y%m') AS month, count(*) AS n FROM fx_orders GROUP BY 1)
SELECT month, CASE WHEN month <= '{LOADED_UNTIL}' THEN 'found' ELSE 'loaded' END AS how,
       CASE WHEN month > '{LOADED_UNTIL}' THEN n END AS n_rows FROM m""",

    "feed_reconciled": f"""WITH {POP_FIXTURES}
SELECT std_ymd, hcode, CAST(x_coord AS DOUBLE) AS x_coord, CAST(y_coord AS DOUBLE) AS y_coord, {_EIGHTHS}, block_cd
  FROM fx_time_pop WHERE CAST(floor(x_coord / 50) AS BIGINT) % 10 NOT IN ({SHORT_CELL}, {LONG_CELL})""",

    "feed_quarantine": f"""WITH {POP_FIXTURES}
SELECT std_ymd, CASE CAST(floor(x_coord / 50) AS BIGINT) % 10 WHEN {SHORT_CELL} THEN {len(_TIME_COLS) + 5 - 10} ELSE {len(_TIME_COLS) + 5 + 1} END AS fields,
       count(*) AS n_lines
  FROM fx_time_pop WHERE CAST(floor(x_coord / 50) AS BIGINT) % 10 IN ({SHORT_CELL}, {LONG_CELL}) GROUP BY ALL""",
})
