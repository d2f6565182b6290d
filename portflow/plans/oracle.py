"""Reference SQL (DuckDB dialect) for the registered queries.

Each string runs on the driver tables registered as views.  The model
bindings are restated here as CTEs in plain SQL, so the check compares two
independent formulations of the same semantics: the Spark operators on one
side, set-based SQL on the other.
"""

from __future__ import annotations

from portflow import catalogs
from portflow.sources.testdata import (EVENT_TYPE_TO_LANE, PRIORITY_TO_MODE, Params)

P = Params()
MODE_ID = catalogs.mode_ids()
LANE_ID = catalogs.lane_ids()


def q(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def case(col: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {default} END"


def in_list(vals) -> str:
    return ", ".join(q(v) for v in vals)


def kdate(col: str) -> str:
    """yyyymmdd int -> DATE."""
    return f"CAST(strptime(CAST({col} AS VARCHAR), '%Y%m%d') AS DATE)"


def dkey(expr: str) -> str:
    """DATE/TIMESTAMP -> yyyymmdd int."""
    return f"CAST(year({expr}) * 10000 + month({expr}) * 100 + day({expr}) AS INTEGER)"


def mkey(expr: str) -> str:
    return f"CAST(year({expr}) * 10000 + month({expr}) * 100 + 1 AS INTEGER)"


def shift(col: str, months: int) -> str:
    return mkey(f"({kdate(col)} + INTERVAL ({months}) MONTH)")


def ym(col: str) -> str:
    return f"(substr(CAST({col} AS VARCHAR), 1, 4) || '-' || substr(CAST({col} AS VARCHAR), 5, 2))"


def ymd(col: str) -> str:
    return (f"(substr(CAST({col} AS VARCHAR), 1, 4) || '-' || substr(CAST({col} AS VARCHAR), 5, 2)"
            f" || '-' || substr(CAST({col} AS VARCHAR), 7, 2))")


def mhu(sum_cents: str, n: str) -> str:
    """Exact mean rounded half up to 2 decimals from integer hundredths."""
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST((2 * ({sum_cents}) + {n}) // (2 * {n}) AS DECIMAL(20,0))"
            f" / 100 AS DECIMAL(18,2)) END")


def cents(col: str) -> str:
    return f"CAST({col} * 100 AS BIGINT)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def growth(a: str, b: str, digits: int | None = 2) -> str:
    g = f"CASE WHEN {dbl(b)} <> 0 THEN ({dbl(a)} - {dbl(b)}) / {dbl(b)} * 100 END"
    return f"round({g}, {digits})" if digits is not None else f"({g})"


def pct(a: str, t: str, digits: int = 2) -> str:
    return f"round(CASE WHEN {dbl(t)} <> 0 THEN {dbl(a)} / {dbl(t)} * 100 END, {digits})"


def scaled(x: str, digits: int) -> str:
    return f"round({dbl(x)} / {float(P.unit_scale)!r}, {digits})"


def yr(col: str = "date_id") -> str:
    return f"({col} // 10000)"


def yrange(year: int) -> str:
    return f"BETWEEN {year * 10000 + 101} AND {year * 10000 + 1231}"


# --- model bindings ------------------------------------------------------------

def trade_cte(p: Params = P) -> str:
    mode_id = {k: MODE_ID[v] for k, v in catalogs.TRADE_MODE_CODE_TO_MODE.items()}
    return f"""
SELECT l_suppkey AS port_id,
       {case('l_linenumber', mode_id)} AS mode_id,
       l_partkey AS commodity_id,
       {mkey('l_shipdate')} AS date_id,
       CASE l_linestatus WHEN 'F' THEN 'Import' WHEN 'O' THEN 'Export' END AS direction,
       CASE l_returnflag WHEN 'A' THEN 'Containerized' WHEN 'N' THEN 'Not Containerized' ELSE 'Unknown' END AS container,
       CASE WHEN l_discount = 0 THEN 'N/A' WHEN l_discount < 0.05 THEN 'Domestically Produced Goods'
            ELSE 'Foreign Produced Goods' END AS production_location,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS value_usd,
       CASE WHEN l_tax = 0 AND l_linestatus = 'O' THEN NULL WHEN l_tax = 0 THEN 0
            ELSE CAST(l_quantity AS BIGINT) END AS weight_kg,
       CASE WHEN l_tax <> 0 THEN CAST(floor(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS BIGINT) END AS freight_charge_usd,
       CASE WHEN l_shipdate >= TIMESTAMP '{p.mirror_start}' AND l_suppkey IN ({in_list(p.corridor_ports)}) THEN 'mirror' ELSE 'national' END AS data_source
FROM lineitem"""


def port_cte(p: Params = P) -> str:
    return f"""
SELECT s_suppkey AS port_id, s_name AS port_canonical_name, CAST(s_suppkey % 3000 + 2000 AS INTEGER) AS port_code,
       'Mexico' AS country, r_name AS border, n_name AS state,
       s_suppkey IN ({in_list(p.corridor_ports)}) AS is_in_corridor,
       (s_suppkey % {p.aggregate_mod}) = {p.aggregate_rem} AS is_aggregate
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def crossing_cte(p: Params = P) -> str:
    mode_id = {k: MODE_ID[v] for k, v in PRIORITY_TO_MODE.items()}
    return f"""
SELECT o_custkey % {p.crossing_port_mod} AS port_id,
       {case('o_orderpriority', mode_id)} AS mode_id,
       {mkey('o_orderdate')} AS date_id,
       CAST(floor(o_totalprice / 1000) AS BIGINT) AS crossing_count
FROM orders"""


def wait_events_cte(p: Params = P) -> str:
    lane_id = {k: LANE_ID[v] for k, v in EVENT_TYPE_TO_LANE.items()}
    return f"""
SELECT user_id % {p.wait_port_mod} + 1 AS port_id,
       {case('event_type', lane_id)} AS lane_type_id,
       {dkey('ts')} AS date_id,
       CAST(value AS DECIMAL(6,2)) AS minutes
FROM events"""


def wait_cte(p: Params = P) -> str:
    return f"""
SELECT port_id, lane_type_id, date_id,
       CAST({mhu('SUM(' + cents('minutes') + ')', 'COUNT(*)')} AS DECIMAL(6,2)) AS waiting_avg_minutes
FROM ({wait_events_cte(p)}) e
GROUP BY port_id, lane_type_id, date_id"""


def depe_cte() -> str:
    """lineitem with the raw port-code text (see Model.trade_port_text)."""
    return """
SELECT *, CASE WHEN l_suppkey % 7 = 0
                 THEN lpad(CAST(l_suppkey % 90 + 10 AS VARCHAR), 2, '0') || CASE WHEN l_suppkey % 2 = 0 THEN 'XX' ELSE 'xx' END
               WHEN l_suppkey % 11 = 0 THEN ''
               WHEN l_suppkey % 13 = 0 THEN CAST(l_suppkey % 3000 + 5000 AS VARCHAR)
               ELSE CAST(l_suppkey % 3000 + 2000 AS VARCHAR) END AS depe
FROM lineitem"""


def parse_port_sql(col: str) -> str:
    return (f"CASE WHEN regexp_full_match({col}, '[0-9]{{4}}') THEN CAST({col} AS INTEGER) "
            f"WHEN regexp_full_match({col}, '[0-9]{{2}}[xX][xX]') THEN CAST(substr({col}, 1, 2) AS INTEGER) * 100 + 99 END")


def pct_exact(src: str, keys: str, value: str, qs: dict) -> str:
    """Exact decimal PERCENTILE_CONT per group of ``src`` (see
    aggregates.percentile_exact), rounded half up to 2 decimals."""
    kk = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    sel = []
    for name, qv in qs.items():
        pos = f"(CAST({qv} AS DECIMAL(10,6)) * (n - 1))"
        lo = f"(CAST(floor({pos}) AS BIGINT) + 1)"
        fr = f"({pos} - floor({pos}))"
        lo_v = f"max(CASE WHEN rn = {lo} THEN v END)"
        hi_v = f"max(CASE WHEN rn = {lo} + 1 THEN v END)"
        sel.append(f"CAST(round({lo_v} + (coalesce({hi_v}, {lo_v}) - {lo_v}) * max({fr}), 2) AS DOUBLE) AS {name}")
    return (f"(SELECT {kk}{', '.join(sel)} FROM (SELECT {kk}CAST({value} AS DECIMAL(18,4)) AS v, "
            f"row_number() OVER ({part} ORDER BY {value}) AS rn, count(*) OVER ({part}) AS n FROM {src}) "
            f"{'GROUP BY ' + keys if keys else ''})")


def lanes_cte() -> str:
    rows = ", ".join(f"({i + 1}, {q(n)}, {q(c)}, {str(t).upper()})"
                     for i, (n, c, t) in enumerate(catalogs.LANE_TYPES))
    return f"SELECT * FROM (VALUES {rows}) v(lane_type_id, lane_canonical_name, vehicle_category, is_trusted_traveler)"


def modes_cte() -> str:
    rows = ", ".join(f"({i + 1}, {q(n)}, {q(s)})" for i, (n, s) in enumerate(catalogs.CANONICAL_MODES))
    return f"SELECT * FROM (VALUES {rows}) v(mode_id, mode_canonical_name, source_dataset)"


def with_model(body: str, p: Params = P) -> str:
    return (f"WITH t AS ({trade_cte(p)}),\nport AS ({port_cte(p)}),\nc AS ({crossing_cte(p)}),\n"
            f"w AS ({wait_cte(p)}),\nlanes AS ({lanes_cte()}),\nmodes AS ({modes_cte()}),\ndl AS ({depe_cte()})\n{body}")


def lcy_sql(src: str) -> str:
    """Last complete year of the rows of ``src``."""
    return f"(SELECT max(y) FROM (SELECT {yr()} AS y FROM {src} GROUP BY 1 HAVING count(DISTINCT date_id) = 12))"


# --- marts ---------------------------------------------------------------------

def mart_meta(p: Params = P) -> str:
    return with_model(f"""
SELECT scope, start_id, end_id,
       CASE WHEN scope = 'wait' THEN {ymd('start_id')} ELSE {ym('start_id')} END AS start_label,
       CASE WHEN scope = 'wait' THEN {ymd('end_id')} ELSE {ym('end_id')} END AS end_label
FROM (
  SELECT 'trade_national' AS scope, CAST(min(date_id) AS INTEGER) AS start_id, CAST(max(date_id) AS INTEGER) AS end_id
  FROM t WHERE data_source = 'national'
  UNION ALL SELECT 'trade_all', CAST(min(date_id) AS INTEGER), CAST(max(date_id) AS INTEGER) FROM t
  UNION ALL SELECT 'crossing', CAST(min(date_id) AS INTEGER), CAST(max(date_id) AS INTEGER) FROM c
  UNION ALL SELECT 'wait', CAST(min(date_id) AS INTEGER), CAST(max(date_id) AS INTEGER) FROM w) u""", p)


def _wait_window(p: Params) -> str:
    return (f"wend AS (SELECT max(date_id) AS end_id FROM w),\n"
            f"wwin AS (SELECT end_id, {dkey(kdate('end_id') + f' - INTERVAL {p.wait_window_days} DAY')} AS start_id FROM wend)")


def mart_panorama_kpis(p: Params = P) -> str:
    blo, bhi = p.base_year * 10000 + 101, p.base_year * 10000 + 1231
    return with_model(f""",
nat AS (SELECT t.*, COALESCE(port.is_in_corridor, FALSE) AS corr FROM t LEFT JOIN port USING (port_id)
        WHERE data_source = 'national'),
b AS (SELECT max(date_id) AS end_id FROM nat),
bb AS (SELECT end_id, {shift('end_id', -11)} AS s_id, {shift('end_id', -12)} AS pe_id,
              {shift('end_id', -23)} AS ps_id FROM b),
k AS (SELECT bb.s_id, bb.end_id,
        CAST(COALESCE(SUM(CASE WHEN date_id BETWEEN bb.s_id AND bb.end_id THEN value_usd END), 0) AS DECIMAL(38,2)) AS ttm,
        CAST(COALESCE(SUM(CASE WHEN date_id BETWEEN bb.ps_id AND bb.pe_id THEN value_usd END), 0) AS DECIMAL(38,2)) AS prev,
        CAST(COALESCE(SUM(CASE WHEN date_id BETWEEN {blo} AND {bhi} THEN value_usd END), 0) AS DECIMAL(38,2)) AS base,
        CAST(COALESCE(SUM(CASE WHEN corr AND date_id BETWEEN bb.s_id AND bb.end_id THEN value_usd END), 0) AS DECIMAL(38,2)) AS corr
      FROM nat CROSS JOIN bb GROUP BY bb.s_id, bb.end_id),
cy AS (SELECT {lcy_sql('c')} AS lcy),
cc AS (SELECT CAST((SELECT lcy FROM cy) AS INTEGER) AS crossings_year,
              CAST(COALESCE(SUM(crossing_count), 0) AS BIGINT) AS crossings_corridor
       FROM c JOIN port USING (port_id) WHERE port.is_in_corridor AND {yr('c.date_id')} = (SELECT lcy FROM cy)),
{_wait_window(p)},
wa AS (SELECT {mhu('SUM(' + cents('waiting_avg_minutes') + ')', 'COUNT(*)')} AS wait_focus_avg_min
       FROM w CROSS JOIN wwin
       WHERE port_id = {p.focus_port} AND lane_type_id = {LANE_ID[p.default_lane]}
         AND date_id BETWEEN wwin.start_id AND wwin.end_id)
SELECT {ym('k.s_id')} AS ttm_start, {ym('k.end_id')} AS ttm_end, k.ttm AS ttm_value_usd,
       {growth('k.ttm', 'k.prev')} AS delta_yoy_pct,
       {growth('k.ttm', 'k.base')} AS delta_vs_base_pct,
       {pct('k.corr', 'k.ttm')} AS corridor_share_pct,
       cc.crossings_year, cc.crossings_corridor,
       wa.wait_focus_avg_min, {ymd('wend.end_id')} AS wait_window_end
FROM k, cc, wa, wend""", p)


def mart_value_timeline(p: Params = P) -> str:
    return with_model(f""",
nat AS (SELECT date_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t
        WHERE data_source = 'national' GROUP BY date_id),
spine AS (SELECT CAST(unnest(generate_series(DATE '{p.series_start}',
            (SELECT max({kdate('date_id')}) FROM nat), INTERVAL 1 MONTH)) AS DATE) AS month_date)
SELECT s.month_date, n.value_usd FROM spine s LEFT JOIN nat n ON {kdate('n.date_id')} = s.month_date""", p)


def mart_crossings_timeline(p: Params = P) -> str:
    return with_model(f"""
SELECT {kdate('date_id')} AS month_date, CAST(SUM(crossing_count) AS BIGINT) AS crossings
FROM c JOIN port USING (port_id)
WHERE port.border = {q(p.crossing_border)} AND NOT port.is_aggregate
GROUP BY date_id""", p)


def mart_top_ports(p: Params = P) -> str:
    return with_model(f""",
nat AS (SELECT * FROM t WHERE data_source = 'national'),
lcy AS (SELECT {lcy_sql('nat')} AS y)
SELECT CAST(lcy.y AS INTEGER) AS year, port.port_canonical_name AS port, port.state,
       {scaled('SUM(nat.value_usd)', 2)} AS value_m
FROM nat JOIN port USING (port_id) JOIN lcy ON {yr('nat.date_id')} = lcy.y
WHERE NOT port.is_aggregate
GROUP BY lcy.y, port.port_canonical_name, port.state
ORDER BY value_m DESC, port LIMIT {p.top_k}""", p)


def mart_focus_kpis(p: Params = P) -> str:
    f = p.focus_port
    truck = MODE_ID[p.truck_mode]
    return with_model(f""",
tm AS (SELECT t.*, COALESCE(port.is_in_corridor, FALSE) AS corr FROM t LEFT JOIN port USING (port_id)),
bb AS (SELECT end_id, {shift('end_id', -11)} AS s_id, {shift('end_id', -12)} AS pe_id, {shift('end_id', -23)} AS ps_id
       FROM (SELECT max(date_id) AS end_id FROM tm)),
la AS (SELECT {lcy_sql('tm')} AS y),
ln AS (SELECT {lcy_sql("(SELECT * FROM tm WHERE data_source = 'national')")} AS y),
k AS (SELECT bb.s_id, bb.end_id, la.y AS corridor_year, ln.y AS national_year,
  CAST(COALESCE(SUM(CASE WHEN port_id = {f} AND date_id BETWEEN bb.s_id AND bb.end_id THEN value_usd END), 0) AS DECIMAL(38,2)) AS ttm,
  CAST(COALESCE(SUM(CASE WHEN port_id = {f} AND date_id BETWEEN bb.ps_id AND bb.pe_id THEN value_usd END), 0) AS DECIMAL(38,2)) AS prev,
  COALESCE(SUM(CASE WHEN port_id = {f} AND {yr()} = la.y THEN value_usd END), 0) AS focus_y,
  COALESCE(SUM(CASE WHEN corr AND {yr()} = la.y THEN value_usd END), 0) AS corr_y,
  COALESCE(SUM(CASE WHEN port_id = {f} AND data_source = 'national' AND {yr()} = ln.y THEN value_usd END), 0) AS focus_nat_y,
  COALESCE(SUM(CASE WHEN data_source = 'national' AND {yr()} = ln.y THEN value_usd END), 0) AS nat_y,
  COALESCE(SUM(CASE WHEN port_id = {f} AND {yr()} = {p.current_year} THEN value_usd END), 0) AS val_cur,
  COALESCE(SUM(CASE WHEN port_id = {f} AND {yr()} = {p.base_year} THEN value_usd END), 0) AS val_base
  FROM tm, bb, la, ln GROUP BY bb.s_id, bb.end_id, la.y, ln.y),
cy AS (SELECT {lcy_sql('c')} AS y),
tr AS (SELECT cy.y AS trucks_year,
  COALESCE(SUM(CASE WHEN {yr()} = cy.y THEN crossing_count END), 0) AS trucks,
  COALESCE(SUM(CASE WHEN {yr()} = {p.current_year} THEN crossing_count END), 0) AS trk_cur,
  COALESCE(SUM(CASE WHEN {yr()} = {p.base_year} THEN crossing_count END), 0) AS trk_base
  FROM cy LEFT JOIN c ON c.port_id = {f} AND c.mode_id = {truck} GROUP BY cy.y),
u AS (SELECT k.*, tr.*,
  CASE WHEN {dbl('trk_cur')} <> 0 THEN {dbl('val_cur')} / {dbl('trk_cur')} END AS upt,
  CASE WHEN {dbl('trk_base')} <> 0 THEN {dbl('val_base')} / {dbl('trk_base')} END AS upt_base FROM k, tr)
SELECT {ym('s_id')} AS ttm_start, {ym('end_id')} AS ttm_end, ttm AS ttm_value_usd,
       {growth('ttm', 'prev')} AS delta_yoy_pct,
       CAST(corridor_year AS INTEGER) AS corridor_year, {pct('focus_y', 'corr_y')} AS share_corridor_pct,
       CAST(national_year AS INTEGER) AS national_year, {pct('focus_nat_y', 'nat_y')} AS share_national_pct,
       CAST(trucks_year AS INTEGER) AS trucks_year, CAST(trucks AS BIGINT) AS trucks,
       round(upt, 0) AS usd_per_truck,
       round(CASE WHEN upt_base IS NOT NULL AND upt_base <> 0 THEN (upt / upt_base - 1) * 100 END, 2) AS usd_per_truck_delta_pct
FROM u""", p)


def mart_focus_monthly(p: Params = P) -> str:
    return with_model(f""",
f AS (SELECT date_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd, min(data_source) AS data_source
      FROM t WHERE port_id IN ({in_list(p.focus_ports)}) GROUP BY date_id),
spine AS (SELECT CAST(unnest(generate_series(DATE '{p.series_start}',
            (SELECT max({kdate('date_id')}) FROM f), INTERVAL 1 MONTH)) AS DATE) AS month_date)
SELECT s.month_date, f.value_usd, f.data_source FROM spine s LEFT JOIN f ON {kdate('f.date_id')} = s.month_date""", p)


def mart_focus_yearly(p: Params = P) -> str:
    return with_model(f"""
SELECT CAST({yr()} AS INTEGER) AS year, count(DISTINCT date_id) AS months_loaded,
       {scaled('SUM(value_usd)', 3)} AS value_m, count(DISTINCT date_id) = 12 AS complete,
       CAST({lcy_sql('t')} AS INTEGER) AS last_complete_year
FROM t WHERE port_id IN ({in_list(p.focus_ports)}) GROUP BY 1""", p)


def mart_sector_mix(p: Params = P) -> str:
    return with_model(f""",
lcy AS (SELECT {lcy_sql('t')} AS y),
f AS (SELECT p_type AS sector, SUM(value_usd) AS v FROM t JOIN part ON t.commodity_id = part.p_partkey
      WHERE port_id IN ({in_list(p.focus_ports)}) AND {yr()} = (SELECT y FROM lcy) GROUP BY 1)
SELECT CAST((SELECT y FROM lcy) AS INTEGER) AS year, sector, {scaled('v', 3)} AS value_m,
       round(CASE WHEN CAST(SUM(v) OVER () AS DOUBLE) <> 0 THEN {dbl('v')} / CAST(SUM(v) OVER () AS DOUBLE) * 100 END, 2) AS pct
FROM f""", p)


def mart_sector_history(p: Params = P, sector_col: str = "p_type") -> str:
    return with_model(f""",
lcy AS (SELECT {lcy_sql('t')} AS y),
h AS (SELECT {yr()} AS year, {sector_col} AS sector, SUM(value_usd) AS v
      FROM t JOIN part ON t.commodity_id = part.p_partkey
      WHERE port_id IN ({in_list(p.focus_ports)}) AND {yr()} >= {p.history_start_year} AND {yr()} <= (SELECT y FROM lcy)
      GROUP BY 1, 2),
grid AS (SELECT y.year, s.sector FROM (SELECT DISTINCT year FROM h) y CROSS JOIN (SELECT DISTINCT sector FROM h) s),
g AS (SELECT grid.year, grid.sector, COALESCE(h.v, 0) AS v FROM grid LEFT JOIN h USING (year, sector))
SELECT CAST(year AS INTEGER) AS year, sector, {scaled('v', 3)} AS value_m,
       round({dbl('v')} / CASE WHEN CAST(SUM(v) OVER (PARTITION BY year) AS DOUBLE) = 0 THEN 1.0
                                ELSE CAST(SUM(v) OVER (PARTITION BY year) AS DOUBLE) END * 100, 2) AS pct
FROM g""", p)


def mart_density_ratio(p: Params = P) -> str:
    f = p.focus_port
    truck = MODE_ID[p.truck_mode]
    return with_model(f""",
v AS (SELECT COALESCE(SUM(CASE WHEN date_id {yrange(p.base_year)} THEN value_usd END), 0) AS vb,
             COALESCE(SUM(CASE WHEN date_id BETWEEN {p.current_year * 10000 + 101} AND {p.current_year * 10000 + 1101}
                               THEN value_usd END), 0) AS vc
      FROM t WHERE port_id = {f} AND data_source = 'national'),
tr AS (SELECT CAST(COALESCE(SUM(CASE WHEN date_id {yrange(p.base_year)} THEN crossing_count END), 0) AS BIGINT) AS tb,
              CAST(COALESCE(SUM(CASE WHEN date_id {yrange(p.current_year)} THEN crossing_count END), 0) AS BIGINT) AS tc
       FROM c WHERE port_id = {f} AND mode_id = {truck}),
u AS (SELECT vb, tb, tc, {dbl('vc')} * 12 / 11 AS va FROM v, tr),
g AS (SELECT *, {growth('va', 'vb', None)} AS vg, {growth('tc', 'tb', None)} AS tg FROM u)
SELECT {scaled('vb', 2)} AS value_base_m, {scaled('va', 2)} AS value_cur_annualised_m,
       round(vg, 2) AS value_growth_pct, tb AS trucks_base, tc AS trucks_cur, round(tg, 2) AS trucks_growth_pct,
       round(CASE WHEN tg IS NOT NULL AND tg <> 0 THEN vg / tg END, 2) AS ratio_value_to_volume
FROM g""", p)


def mart_asymmetry(p: Params = P) -> str:
    f = p.focus_port
    return with_model(f""",
lcy AS (SELECT {lcy_sql('t')} AS y),
y AS (SELECT port_id, port.port_canonical_name, SUM(value_usd) AS v FROM t JOIN port USING (port_id)
      WHERE port.is_in_corridor AND {yr()} = (SELECT y FROM lcy) GROUP BY 1, 2)
SELECT CAST((SELECT y FROM lcy) AS INTEGER) AS year, port_canonical_name AS port, {scaled('v', 3)} AS value_m,
       round(CASE WHEN CAST(SUM(v) OVER () AS DOUBLE) <> 0 THEN {dbl('v')} / CAST(SUM(v) OVER () AS DOUBLE) * 100 END, 2) AS pct_corridor,
       round(CASE WHEN port_id <> {f} AND {dbl('v')} <> 0
             THEN CAST(COALESCE(MAX(CASE WHEN port_id = {f} THEN v END) OVER (), 0) AS DOUBLE) / {dbl('v')} END, 1) AS ratio_focus_to_port
FROM y""", p)


def mart_wait_kpis(p: Params = P) -> str:
    rows = ", ".join(f"({a}, {q(b)}, {LANE_ID[b]})" for a, b in p.wait_kpis)
    return with_model(f""",
{_wait_window(p)},
req AS (SELECT * FROM (VALUES {rows}) v(port_id, lane, lane_type_id)),
a AS (SELECT port_id, lane_type_id, SUM({cents('waiting_avg_minutes')}) AS sc, COUNT(*) AS n
      FROM w CROSS JOIN wwin WHERE date_id BETWEEN wwin.start_id AND wwin.end_id GROUP BY 1, 2)
SELECT CAST(req.port_id AS BIGINT) AS port_id, req.lane, {mhu('a.sc', 'a.n')} AS avg_min, {ymd('wend.end_id')} AS window_end
FROM req LEFT JOIN a ON a.port_id = req.port_id AND a.lane_type_id = req.lane_type_id CROSS JOIN wend""", p)


def _corridor_waits(p: Params) -> str:
    return (f"cw AS (SELECT w.*, lanes.lane_canonical_name AS lane, {kdate('w.date_id')} AS d FROM w "
            f"JOIN lanes USING (lane_type_id) WHERE w.port_id IN ({in_list(p.corridor_ports)}))")


def mart_wait_heatmap(p: Params = P) -> str:
    return with_model(f""",
{_corridor_waits(p)}
SELECT port_id, lane, CAST(weekofyear(d) AS INTEGER) AS iso_week, CAST(isodow(d) AS INTEGER) AS iso_dow,
       {mhu('SUM(' + cents('waiting_avg_minutes') + ')', 'COUNT(*)')} AS avg_min, COUNT(*) AS n_days
FROM cw GROUP BY 1, 2, 3, 4""", p)


def mart_lane_savings(p: Params = P) -> str:
    s, fa = LANE_ID[p.standard_lane], LANE_ID[p.fast_lane]
    lo, hi = p.wait_year * 10000 + 101, p.wait_year * 10000 + 1231
    parts = []
    for tag, lid in (("std", s), ("fast", fa)):
        on = f"lane_type_id = {lid}"
        parts += [f"max(CASE WHEN {on} THEN {c} END) AS {tag}_{c}" for c in ("avg", "p50", "p95", "max")]
        parts.append(f"COALESCE(max(CASE WHEN {on} THEN n_days END), 0) AS {tag}_n_days")
    sav = ", ".join(
        f"round(CASE WHEN fast_{st} <> 0 AND std_{st} <> 0 THEN (fast_{st} - std_{st}) / std_{st} * 100 END, 2) AS {st}_saving_pct"
        for st in ("avg", "p50", "p95", "max"))
    return with_model(f""",
x AS (SELECT lane_type_id, waiting_avg_minutes FROM w
      WHERE date_id BETWEEN {lo} AND {hi} AND port_id = {p.focus_port} AND lane_type_id IN ({s}, {fa})),
pl AS (SELECT a.lane_type_id, a.n_days, a.max, CAST(a.avg AS DOUBLE) AS avg, pc.p50, pc.p95 FROM
        (SELECT lane_type_id, COUNT(*) AS n_days, CAST(MAX(waiting_avg_minutes) AS DOUBLE) AS max,
                {mhu('SUM(' + cents('waiting_avg_minutes') + ')', 'COUNT(*)')} AS avg FROM x GROUP BY 1) a
        JOIN {pct_exact('x', 'lane_type_id', 'waiting_avg_minutes', {'p50': 0.5, 'p95': 0.95})} pc USING (lane_type_id)),
s AS (SELECT {', '.join(parts)} FROM pl)
SELECT *, {sav} FROM s""", p)


def mart_wait_trend(p: Params = P) -> str:
    return with_model(f""",
{_corridor_waits(p)}
SELECT port_id, lane, strftime(d, '%Y-%m') AS year_month,
       {mhu('SUM(' + cents('waiting_avg_minutes') + ')', 'COUNT(*)')} AS avg_min, COUNT(*) AS n_days
FROM cw GROUP BY 1, 2, 3""", p)


def mart_recovery_kpis(p: Params = P) -> str:
    f = p.focus_port
    truck = MODE_ID[p.truck_mode]
    return with_model(f""",
fm AS (SELECT date_id, SUM(value_usd) AS v FROM t WHERE port_id = {f} GROUP BY date_id),
v AS (SELECT COALESCE(SUM(CASE WHEN {yr()} = {p.current_year} THEN v END), 0) AS vc,
             COALESCE(SUM(CASE WHEN {yr()} = {p.base_year} THEN v END), 0) AS vb,
             MIN(CASE WHEN {yr()} = {p.shock_year} THEN v END) AS min_shock FROM fm),
tr AS (SELECT COALESCE(SUM(CASE WHEN {yr()} = {p.current_year} THEN crossing_count END), 0) AS tc,
              COALESCE(SUM(CASE WHEN {yr()} = {p.base_year} THEN crossing_count END), 0) AS tb
       FROM c WHERE port_id = {f} AND mode_id = {truck}),
r AS (SELECT date_id, v, row_number() OVER (ORDER BY date_id) AS rn FROM fm
      WHERE date_id BETWEEN {p.shock_year * 10000 + 101} AND {p.recovery_end_year * 10000 + 1231}),
mn AS (SELECT rn AS min_rn FROM r ORDER BY v, rn LIMIT 1),
rec AS (SELECT MIN(r.rn) - (SELECT min_rn FROM mn) AS recovery_rows FROM r, v
        WHERE r.rn > (SELECT min_rn FROM mn) AND {dbl('r.v')} >= {dbl('v.vb')} / 12),
g AS (SELECT v.*, tr.*, rec.recovery_rows, {dbl('vb')} / 12 AS base_avg,
             {growth('vc', 'vb', None)} AS vg, {growth('tc', 'tb', None)} AS tg FROM v, tr, rec)
SELECT round(vg, 2) AS value_growth_pct, round(tg, 2) AS trucks_growth_pct,
       round(CASE WHEN tg IS NOT NULL AND tg <> 0 THEN vg / tg END, 2) AS ratio_density,
       round(CASE WHEN base_avg <> 0 THEN ({dbl('COALESCE(min_shock, 0)')} - base_avg) / base_avg * 100 END, 2) AS drop_pct,
       CAST(CASE WHEN base_avg <> 0 THEN recovery_rows END AS INTEGER) AS recovery_months
FROM g""", p)


def _value_trucks(p: Params) -> str:
    f = p.focus_port
    truck = MODE_ID[p.truck_mode]
    lo, hi = p.dual_start_year * 10000 + 101, p.dual_end_year * 10000 + 1231
    return (f"fv AS (SELECT date_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t "
            f"WHERE port_id = {f} AND date_id BETWEEN {lo} AND {hi} GROUP BY date_id),\n"
            f"ft AS (SELECT date_id, CAST(SUM(crossing_count) AS BIGINT) AS trucks FROM c "
            f"WHERE port_id = {f} AND mode_id = {truck} AND date_id BETWEEN {lo} AND {hi} GROUP BY date_id)")


def mart_dual_series(p: Params = P) -> str:
    return with_model(f""",
{_value_trucks(p)}
SELECT {kdate('COALESCE(fv.date_id, ft.date_id)')} AS month_date, fv.value_usd, ft.trucks
FROM fv FULL OUTER JOIN ft ON fv.date_id = ft.date_id""", p)


def mart_density_trend(p: Params = P) -> str:
    return with_model(f""",
{_value_trucks(p)},
j AS (SELECT fv.date_id, round({dbl('value_usd')} / {dbl('trucks')}, 2) AS upt
      FROM fv JOIN ft USING (date_id) WHERE trucks <> 0),
s AS (SELECT date_id, upt, CAST(row_number() OVER (ORDER BY date_id) - 1 AS INTEGER) AS idx FROM j),
g AS (SELECT count(upt) AS n, var_pop(CAST(idx AS DOUBLE)) AS vx, var_pop(upt) AS vy,
             regr_slope(upt, CAST(idx AS DOUBLE)) AS sl, regr_r2(upt, CAST(idx AS DOUBLE)) AS r2 FROM s)
SELECT {kdate('date_id')} AS month_date, idx, upt AS usd_per_truck,
       round(CASE WHEN n < 2 THEN NULL WHEN vx = 0 THEN 0.0 ELSE sl END * 12, 2) AS slope_per_year,
       round(CASE WHEN n < 2 THEN NULL WHEN vy = 0 OR vx = 0 THEN 0.0 ELSE r2 END, 3) AS r_squared
FROM s, g""", p)


# --- nested results as text: arrays joined, values with two decimals -----------------

def _two(x: str) -> str:
    return f"COALESCE(CAST(CAST({x} AS DECIMAL(10,2)) AS VARCHAR), 'null')"


def heatmap_matrix(p: Params = P) -> str:
    slots = " || ',' || ".join(_two(f"max(CASE WHEN iso_dow = {i} THEN avg_min END)") for i in range(1, 8))
    return f"""SELECT port_id, lane, iso_week, {slots} AS week_values, CAST(port_id AS VARCHAR) || '|' || lane AS series_key
FROM ({mart_wait_heatmap(p)}) GROUP BY port_id, lane, iso_week"""


def series_map(p: Params = P) -> str:
    point = f"year_month || ':' || {_two('avg_min')} || ':' || n_days"
    return f"""SELECT CAST(port_id AS VARCHAR) || '|' || lane AS series_key, string_agg({point}, ',' ORDER BY year_month) AS series
FROM ({mart_wait_trend(p)}) GROUP BY port_id, lane"""


def combos_default(p: Params = P) -> str:
    return with_model(f""",
{_corridor_waits(p)},
combos AS (SELECT DISTINCT port_id, lane FROM cw),
best AS (SELECT port_id, lane FROM combos ORDER BY (port_id = {p.focus_port} AND lane = {q(p.default_lane)}) DESC, port_id, lane LIMIT 1)
SELECT port_id, lane, (SELECT port_id FROM best) AS default_port_id, (SELECT lane FROM best) AS default_lane FROM combos""", p)
