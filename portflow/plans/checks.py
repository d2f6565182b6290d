"""

Each key exercises one operator of the library on the model bound to the
driver tables (``Model``); the SQL restates the same semantics for DuckDB.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portflow import catalogs
from portflow.functions import codes, dates, metrics
from portflow.operators import aggregates as agg
from portflow.operators import conform, dims, joins, links, profile, quality, rules, series, windows
from portflow.plans import constraints, marts
from portflow.plans import oracle as O
from portflow.plans.registry import register
from portflow.session import staged
from portflow.sinks import with_audit
from portflow.sources.testdata import PRIORITY_TO_MODE, Model, model

P = O.P
DEC = "decimal(38,2)"
NAT = catalogs.SOURCE_NATIONAL


def key(name: str, sql: str | None = None):
    """Register ``fn(model) -> DataFrame`` under ``name``; ``sql`` is a query
    body over the model CTEs (t, port, c, w, lanes, modes, dl) or the raw
    tables, or extra CTEs starting with a comma."""
    def deco(fn: Callable[[Model], DataFrame]):
        register(name, lambda spark, d: fn(model(spark, d)), None if sql is None else O.with_model(sql))
        return fn
    return deco


def _yr(c="date_id"):
    return dates.key_year(c)


# ===========================================================================
# F aggregations
# ===========================================================================

@key("agg_sum1", "SELECT date_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t GROUP BY date_id")
def agg_sum1(m):
    return agg.sum_by(m.trade(), ["date_id"], "value_usd", "value_usd")


@key("agg_sum2", "SELECT date_id, data_source, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t GROUP BY 1, 2")
def agg_sum2(m):
    return agg.sum_by(m.trade(), ["date_id", "data_source"], "value_usd", "value_usd")


@key("agg_global_sum", f"""
SELECT CAST(COALESCE(SUM(CASE WHEN date_id {O.yrange(P.current_year)} THEN value_usd END), 0) AS DECIMAL(38,2)) AS total_current,
       CAST(COALESCE(SUM(CASE WHEN date_id {O.yrange(P.gap_year)} THEN value_usd END), 0) AS DECIMAL(38,2)) AS total_gap_year
FROM t WHERE port_id = {P.focus_port}""")
def agg_global_sum(m):
    p = m.p
    t = m.trade().where(F.col("port_id") == p.focus_port)
    lo, hi = dates.year_range(p.current_year)
    glo, ghi = dates.year_range(p.gap_year)
    return agg.fused(t, {"total_current": (F.col("date_id").between(lo, hi), F.col("value_usd")),
                         "total_gap_year": (F.col("date_id").between(glo, ghi), F.col("value_usd"))}, dtype=DEC)


@key("agg_coverage", """
SELECT data_source, CAST(min(date_id) AS INTEGER) AS first_id, CAST(max(date_id) AS INTEGER) AS last_id, count(*) AS n
FROM t GROUP BY data_source""")
def agg_coverage(m):
    return m.trade().groupBy("data_source").agg(F.min("date_id").alias("first_id"), F.max("date_id").alias("last_id"),
                                                F.count(F.lit(1)).alias("n"))


@key("agg_count", "SELECT port_id, lane_type_id, count(*) AS n FROM w GROUP BY 1, 2")
def agg_count(m):
    return m.wait().groupBy("port_id", "lane_type_id").agg(F.count(F.lit(1)).alias("n"))


@key("last_complete_year", f"""
SELECT 'national' AS scope, CAST({O.lcy_sql("(SELECT * FROM t WHERE data_source = 'national')")} AS INTEGER) AS year
UNION ALL SELECT 'mixed', CAST({O.lcy_sql('t')} AS INTEGER)
UNION ALL SELECT 'crossing', CAST({O.lcy_sql('c')} AS INTEGER)""")
def last_complete_year(m):
    t = marts.trade_monthly(m)   # one row per month: one scan of the fact for both bounds
    return (agg.last_complete_year(t.where(F.col("has_nat").isNotNull())).select(F.lit("national").alias("scope"), "year")
            .unionByName(agg.last_complete_year(t).select(F.lit("mixed").alias("scope"), "year"))
            .unionByName(agg.last_complete_year(m.crossing()).select(F.lit("crossing").alias("scope"), "year")))


@key("year_completeness", f"""
SELECT CAST({O.yr()} AS INTEGER) AS year, count(DISTINCT date_id) AS months, count(DISTINCT date_id) = 12 AS complete
FROM t WHERE port_id = {P.focus_port} GROUP BY 1""")
def year_completeness(m):
    return agg.year_months(m.trade().where(F.col("port_id") == m.p.focus_port)) \
        .select(F.col("year").cast("int").alias("year"), "months", "complete")


@key("agg_avg", f"""
SELECT port_id, lane_type_id, {O.mhu('SUM(' + O.cents('waiting_avg_minutes') + ')', 'COUNT(*)')} AS avg_min
FROM w GROUP BY 1, 2""")
def agg_avg(m):
    return agg.dedup_mean(m.wait(), ["port_id", "lane_type_id"], "waiting_avg_minutes", "avg_min")


@key("agg_percentile_cont", f"""
SELECT pc.*, mx.max_min FROM {O.pct_exact('w', 'port_id, lane_type_id', 'waiting_avg_minutes', {'p50': 0.5, 'p95': 0.95})} pc
JOIN (SELECT port_id, lane_type_id, CAST(max(waiting_avg_minutes) AS DOUBLE) AS max_min FROM w GROUP BY 1, 2) mx
USING (port_id, lane_type_id)""")
def agg_percentile_cont(m):
    w = m.wait()
    keys = ["port_id", "lane_type_id"]
    pc = agg.percentile_exact(w, keys, "waiting_avg_minutes", [0.5, 0.95], ["p50", "p95"])
    mx = w.groupBy(*keys).agg(F.max("waiting_avg_minutes").cast("double").alias("max_min"))
    return pc.join(mx, keys)


@key("agg_min_of_sum", f"""
SELECT port_id, CAST(min(v) AS DECIMAL(38,2)) AS min_monthly FROM (
  SELECT port_id, date_id, SUM(value_usd) AS v FROM t WHERE port_id IN ({O.in_list(P.corridor_ports)}) GROUP BY 1, 2)
GROUP BY port_id""")
def agg_min_of_sum(m):
    t = m.trade().where(F.col("port_id").isin(*m.p.corridor_ports))
    monthly = t.groupBy("port_id", "date_id").agg(F.sum("value_usd").alias("v"))
    return monthly.groupBy("port_id").agg(F.min("v").cast(DEC).alias("min_monthly"))


_TPK = "port_id, mode_id, commodity_id, date_id, direction, container, production_location"


@key("dedup_sum_nullsafe", f"""
SELECT {_TPK}, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd, SUM(weight_kg) AS weight_kg, count(*) AS n_rows
FROM t GROUP BY {_TPK}""")
def dedup_sum_nullsafe(m):
    from portflow.schemas import FACT_TRADE_PK
    d = agg.dedup_sum(m.trade(), FACT_TRADE_PK, ["value_usd", "weight_kg"], keep={"n_rows": F.count(F.lit(1))})
    return d.withColumn("value_usd", F.col("value_usd").cast(DEC))


@key("dedup_sum", "SELECT port_id, mode_id, date_id, SUM(crossing_count) AS crossing_count FROM c GROUP BY 1, 2, 3")
def dedup_sum(m):
    return agg.dedup_sum(m.crossing(), ["port_id", "mode_id", "date_id"], ["crossing_count"])


@key("dedup_mean", "SELECT port_id, lane_type_id, date_id, waiting_avg_minutes FROM w")
def dedup_mean(m):
    return m.wait()


@key("dup_groups", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_groups(m):
    return agg.dup_groups(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@key("value_counts", """
SELECT production_location, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, production_location LIMIT 5""")
def value_counts(m):
    return agg.value_counts(m.trade(), "production_location", top=5)


@key("agg_fused_conditional", f"""
SELECT CAST(COALESCE(SUM(CASE WHEN data_source = 'national' THEN value_usd END), 0) AS DECIMAL(38,2)) AS national,
       CAST(COALESCE(SUM(CASE WHEN data_source = 'mirror' THEN value_usd END), 0) AS DECIMAL(38,2)) AS mirror,
       CAST(COALESCE(SUM(CASE WHEN port_id IN ({O.in_list(P.corridor_ports)}) THEN value_usd END), 0) AS DECIMAL(38,2)) AS corridor,
       CAST(COALESCE(SUM(CASE WHEN port_id = {P.focus_port} AND date_id {O.yrange(P.base_year)} THEN value_usd END), 0) AS DECIMAL(38,2)) AS focus_base,
       CAST(COALESCE(SUM(CASE WHEN direction = 'Export' THEN value_usd END), 0) AS DECIMAL(38,2)) AS exports
FROM t""")
def agg_fused_conditional(m):
    p = m.p
    lo, hi = dates.year_range(p.base_year)
    c, v = F.col, F.col("value_usd")
    return agg.fused(m.trade(), {
        "national": (c("data_source") == NAT, v),
        "mirror": (c("data_source") == catalogs.SOURCE_MIRROR, v),
        "corridor": (c("port_id").isin(*p.corridor_ports), v),
        "focus_base": ((c("port_id") == p.focus_port) & c("date_id").between(lo, hi), v),
        "exports": (c("direction") == "Export", v)}, dtype=DEC)


@key("agg_regression", """
SELECT round(CASE WHEN n < 2 THEN NULL WHEN vx = 0 THEN 0.0 ELSE sl END, 2) AS slope,
       round(CASE WHEN n < 2 THEN NULL WHEN vx = 0 THEN my ELSE ic END, 2) AS intercept,
       round(CASE WHEN n < 2 THEN NULL WHEN vx = 0 OR vy = 0 THEN 0.0 ELSE r2 END, 6) AS r_squared, n
FROM (SELECT count(y) AS n, var_pop(x) AS vx, var_pop(y) AS vy, avg(y) AS my, regr_slope(y, x) AS sl,
             regr_intercept(y, x) AS ic, regr_r2(y, x) AS r2
      FROM (SELECT CAST(row_number() OVER (ORDER BY date_id) - 1 AS DOUBLE) AS x, round(CAST(v AS DOUBLE) / 1000000.0, 2) AS y
            FROM (SELECT date_id, SUM(value_usd) AS v FROM t WHERE data_source = 'national' GROUP BY 1)))""")
def agg_regression(m):
    s = m.trade().where(F.col("data_source") == NAT).groupBy("date_id").agg(F.sum("value_usd").alias("v"))
    s = windows.series_index(s, "date_id", "idx").select(
        F.col("idx").cast("double").alias("x"), metrics.scaled("v", 1e6, 2).alias("y"))
    r = agg.regression(s, "x", "y")
    return r.select(F.round("slope", 2).alias("slope"), F.round("intercept", 2).alias("intercept"),
                    F.round("r_squared", 6).alias("r_squared"), "n")


@key("agg_first_last", """
SELECT port_id, lane_type_id, CAST(min(date_id) AS INTEGER) AS first_date, CAST(max(date_id) AS INTEGER) AS last_date,
       count(waiting_avg_minutes) AS n_obs, count(DISTINCT date_id) AS n_dates
FROM w GROUP BY 1, 2""")
def agg_first_last(m):
    return agg.first_last(m.wait(), ["port_id", "lane_type_id"], "date_id", "waiting_avg_minutes")


# ===========================================================================
# H sort / top-k, I set operations
# ===========================================================================

@key("topk", f"""
SELECT commodity_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t
WHERE data_source = 'national' AND date_id {O.yrange(P.base_year)}
GROUP BY 1 ORDER BY value_usd DESC, commodity_id LIMIT {P.top_k}""")
def topk(m):
    lo, hi = dates.year_range(m.p.base_year)
    t = m.trade().where((F.col("data_source") == NAT) & F.col("date_id").between(lo, hi))
    s = agg.sum_by(t, ["commodity_id"], "value_usd", "value_usd")
    return s.orderBy(F.desc("value_usd"), F.asc("commodity_id")).limit(m.p.top_k)


@key("sort_multi", f"""
SELECT port_id, CAST({O.yr()} AS INTEGER) AS year, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t
WHERE port_id IN ({O.in_list(P.corridor_ports)}) GROUP BY 1, 2 ORDER BY port_id, value_usd DESC""")
def sort_multi(m):
    t = m.trade().where(F.col("port_id").isin(*m.p.corridor_ports))
    return (t.groupBy("port_id", _yr().alias("year")).agg(F.sum("value_usd").cast(DEC).alias("value_usd"))
             .orderBy(F.asc("port_id"), F.desc("value_usd")))


@key("sorted_distinct", f"""
SELECT string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS sectors, count(DISTINCT p_type) AS n
FROM t JOIN part ON t.commodity_id = part.p_partkey WHERE port_id = {P.focus_port}""")
def sorted_distinct(m):
    t = m.trade().where(F.col("port_id") == m.p.focus_port).join(
        m.dim_commodity().select("commodity_id", "sector_grouping"), "commodity_id")
    return t.agg(F.array_join(F.array_sort(F.collect_set("sector_grouping")), ",").alias("sectors"),
                 F.countDistinct("sector_grouping").alias("n"))


@key("union_by_name", """
SELECT data_source, count(*) AS n_rows, count(*) - count(weight_kg) AS null_weight FROM (
  SELECT data_source, weight_kg FROM t WHERE data_source = 'national'
  UNION ALL SELECT data_source, NULL AS weight_kg FROM t WHERE data_source = 'mirror') GROUP BY 1""")
def union_by_name(m):
    t = m.trade()
    nat = t.where(F.col("data_source") == NAT).select("weight_kg", "data_source")
    mir = t.where(F.col("data_source") == catalogs.SOURCE_MIRROR).select("data_source")   # feed without weight
    u = nat.unionByName(mir, allowMissingColumns=True)
    return u.groupBy("data_source").agg(F.count(F.lit(1)).alias("n_rows"),
                                        (F.count(F.lit(1)) - F.count("weight_kg")).alias("null_weight"))


@key("union_counts", """
SELECT 'fact_trade' AS table_name, count(*) AS n FROM t
UNION ALL SELECT 'fact_crossing', count(*) FROM c
UNION ALL SELECT 'fact_wait', count(*) FROM w
UNION ALL SELECT 'dim_port', count(*) FROM port""")
def union_counts(m):
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
    return (cnt(m.trade(), "fact_trade").union(cnt(m.crossing(), "fact_crossing"))
            .union(cnt(m.wait(), "fact_wait")).union(cnt(m.dim_port(), "dim_port")))


@key("set_difference", f"""
SELECT code FROM (SELECT {O.parse_port_sql('depe')} AS code FROM dl) WHERE code IS NOT NULL
EXCEPT SELECT port_code FROM port""")
def set_difference(m):
    feed = m.trade_port_text().select(codes.parse_port_code("depe").alias("code")).where("code IS NOT NULL")
    return feed.subtract(m.port_codes().select(F.col("port_code").alias("code")))


@key("set_intersect", f"""
SELECT code FROM (SELECT {O.parse_port_sql('depe')} AS code FROM dl) WHERE code IS NOT NULL
INTERSECT SELECT port_code FROM port""")
def set_intersect(m):
    feed = m.trade_port_text().select(codes.parse_port_code("depe").alias("code")).where("code IS NOT NULL")
    return feed.intersect(m.port_codes().select(F.col("port_code").alias("code")))


@key("union_distinct", """
SELECT DISTINCT port_id FROM (SELECT port_id FROM t UNION ALL SELECT port_id FROM c)""")
def union_distinct(m):
    return m.trade().select("port_id").union(m.crossing().select("port_id")).distinct()


# ===========================================================================
# J scalar functions
# ===========================================================================

@key("fn_extract", f"""
SELECT DISTINCT date_id, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dd,
       CAST(isodow(d) AS INTEGER) AS iso_dow, CAST(weekofyear(d) AS INTEGER) AS iso_week
FROM (SELECT date_id, {O.kdate('date_id')} AS d FROM w)""")
def fn_extract(m):
    d = dates.key_to_date("date_id")
    return m.wait().select("date_id").distinct().select(
        "date_id", F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("dd"),
        dates.iso_dow(d).alias("iso_dow"), dates.iso_week(d).alias("iso_week"))


@key("fn_date_format", f"""
SELECT DISTINCT date_id, monthname(d) AS month_name, dayname(d) AS day_name, strftime(d, '%Y-%m') AS year_month
FROM (SELECT date_id, {O.kdate('date_id')} AS d FROM c)""")
def fn_date_format(m):
    d = dates.key_to_date("date_id")
    return m.crossing().select("date_id").distinct().select(
        "date_id", dates.month_name(d).alias("month_name"), dates.day_name(d).alias("day_name"),
        dates.year_month_str(d).alias("year_month"))


@key("fn_datekey_roundtrip", f"""
SELECT DISTINCT date_id, {O.kdate('date_id')} AS d, {O.dkey(O.kdate('date_id'))} AS back FROM t""")
def fn_datekey_roundtrip(m):
    return m.trade().select("date_id").distinct().select(
        "date_id", dates.key_to_date("date_id").alias("d"), dates.date_key(dates.key_to_date("date_id")).alias("back"))


@key("fn_shift_months", f"""
SELECT DISTINCT date_id, {O.shift('date_id', 1)} AS next_m, {O.shift('date_id', -11)} AS ttm_start,
       {O.shift('date_id', -23)} AS prev_ttm_start FROM t""")
def fn_shift_months(m):
    return m.trade().select("date_id").distinct().select(
        "date_id", dates.shift_month_key("date_id", 1).alias("next_m"),
        dates.shift_month_key("date_id", -11).alias("ttm_start"),
        dates.shift_month_key("date_id", -23).alias("prev_ttm_start"))


@key("fn_date_sub", f"""
SELECT DISTINCT date_id, {O.dkey(O.kdate('date_id') + ' - INTERVAL 30 DAY')} AS minus_30 FROM w""")
def fn_date_sub(m):
    return m.wait().select("date_id").distinct().select(
        "date_id", dates.date_key(F.date_sub(dates.key_to_date("date_id"), 30)).alias("minus_30"))


@key("fn_null", """
SELECT direction, SUM(COALESCE(weight_kg, 0)) AS weight_or_zero, count(NULLIF(weight_kg, 0)) AS nonzero_weights,
       count(*) - count(weight_kg) AS null_weights
FROM t GROUP BY direction""")
def fn_null(m):
    wk = F.col("weight_kg")
    return m.trade().groupBy("direction").agg(
        F.sum(F.coalesce(wk, F.lit(0))).alias("weight_or_zero"),
        F.count(F.nullif(wk, F.lit(0))).alias("nonzero_weights"),
        (F.count(F.lit(1)) - F.count(wk)).alias("null_weights"))


@key("fn_round_scale", f"""
SELECT port_id, round(CAST(SUM(value_usd) AS DOUBLE) / 1000000.0, 2) AS value_m,
       round(CAST(SUM(value_usd) AS DOUBLE) / 1e9, 3) AS value_bn,
       round(SUM(value_usd), 0) AS value_rounded
FROM t WHERE port_id IN ({O.in_list(P.corridor_ports)}) GROUP BY port_id""")
def fn_round_scale(m):
    t = m.trade().where(F.col("port_id").isin(*m.p.corridor_ports))
    s = t.groupBy("port_id").agg(F.sum("value_usd").alias("v"))
    return s.select("port_id", metrics.scaled("v", 1e6, 2).alias("value_m"), metrics.scaled("v", 1e9, 3).alias("value_bn"),
                    F.round("v", 0).cast("decimal(38,0)").alias("value_rounded"))


@key("fn_cast", """
SELECT event_type, SUM(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS k_sum,
       count(TRY_CAST(event_type AS INTEGER)) AS numeric_types, SUM(CAST(round(value) AS INTEGER)) AS value_int,
       CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS value_dec
FROM events GROUP BY event_type""")
def fn_cast(m):
    e = m.table("events")
    return e.groupBy("event_type").agg(
        F.sum(F.get_json_object("props", "$.k").try_cast("int")).alias("k_sum"),
        F.count(F.col("event_type").try_cast("int")).alias("numeric_types"),
        # ``::int`` rounds half away from zero (a plain Spark cast truncates)
        F.sum(F.round("value", 0).cast("int")).alias("value_int"),
        F.sum(F.col("value").cast("decimal(10,2)")).cast(DEC).alias("value_dec"))


@key("fn_regex", """
SELECT lang, count(*) FILTER (WHERE regexp_matches(text, '(?i)licen[cs]e')) AS n_license,
       SUM(len(regexp_extract_all(text, '[0-9]+'))) AS n_numbers,
       count(*) FILTER (WHERE regexp_extract(text, '([0-9]{4})', 1) <> '') AS n_with_4digits,
       count(*) FILTER (WHERE contains(upper(text), 'THE')) AS n_the
FROM documents GROUP BY lang""")
def fn_regex(m):
    t = F.col("text")
    return m.table("documents").groupBy("lang").agg(
        F.count_if(t.rlike("(?i)licen[cs]e")).alias("n_license"),
        F.sum(F.size(F.regexp_extract_all(t, F.lit("[0-9]+"), 0))).alias("n_numbers"),
        F.count_if(F.regexp_extract(t, "([0-9]{4})", 1) != "").alias("n_with_4digits"),
        F.count_if(F.upper(t).contains("THE")).alias("n_the"))


@key("fn_string_parts", """
SELECT page_id, regexp_extract(url, '^https?://[^/]+(/[^?#]*)?', 1) AS path,
       lpad(CAST(page_id AS VARCHAR), 8, '0') AS padded_id,
       split_part(regexp_extract(url, '^https?://([^/?#]+)', 1), '.', 1) AS host_head,
       list_last(string_split(regexp_extract(url, '^https?://[^/]+(/[^?#]*)?', 1), '/')) AS last_segment
FROM pages""")
def fn_string_parts(m):
    u = F.col("url")
    path = F.regexp_extract(u, r"^https?://[^/]+(/[^?#]*)?", 1)
    host = F.regexp_extract(u, r"^https?://([^/?#]+)", 1)
    return m.table("pages").select(
        "page_id", path.alias("path"), F.lpad(F.col("page_id").cast("string"), 8, "0").alias("padded_id"),
        F.split_part(host, F.lit("."), F.lit(1)).alias("host_head"),
        F.element_at(F.split(path, "/"), -1).alias("last_segment"))


@key("fn_divmod", f"""
SELECT DISTINCT port_code, port_code // 100 AS district, port_code % 100 AS rem
FROM (SELECT {O.parse_port_sql('depe')} AS port_code FROM dl) WHERE port_code IS NOT NULL""")
def fn_divmod(m):
    c = m.trade_port_text().select(codes.parse_port_code("depe").alias("port_code")).where("port_code IS NOT NULL")
    return c.distinct().select("port_code", codes.district_of("port_code").alias("district"),
                               F.pmod("port_code", F.lit(100)).alias("rem"))


@key("fn_growth", f"""
SELECT CAST(year AS INTEGER) AS year, v AS value_usd,
       {O.growth('v', 'lag(v) OVER (ORDER BY year)')} AS growth_pct
FROM (SELECT {O.yr()} AS year, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS v FROM t WHERE data_source = 'national' GROUP BY 1)""")
def fn_growth(m):
    y = m.trade().where(F.col("data_source") == NAT).groupBy(_yr().alias("year")) \
        .agg(F.sum("value_usd").cast(DEC).alias("value_usd"))
    prev = F.lag("value_usd").over(Window.orderBy("year"))   # one row per year: bounded
    return y.select(F.col("year").cast("int").alias("year"), "value_usd", metrics.growth_pct("value_usd", prev).alias("growth_pct"))


@key("fn_json", """
SELECT event_type, SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_sum,
       count(json_extract_string(props, '$.missing')) AS n_missing_key
FROM events GROUP BY event_type""")
def fn_json(m):
    e = m.table("events")
    return e.groupBy("event_type").agg(
        F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k_sum"),
        F.count(F.get_json_object("props", "$.missing")).alias("n_missing_key"))


@key("fn_predicates", """
SELECT count(*) FILTER (WHERE regexp_full_match(depe, '[0-9]+')) AS n_digits,
       count(depe) AS n_not_null, count(*) FILTER (WHERE depe = '') AS n_empty
FROM dl""")
def fn_predicates(m):
    d = F.col("depe")
    return m.trade_port_text().agg(F.count_if(codes.is_digits(d)).alias("n_digits"),
                                   F.count(d).alias("n_not_null"), F.count_if(d == "").alias("n_empty"))


# ===========================================================================
# C conforming
# ===========================================================================

@key("filter_eq", f"""
SELECT port_id, count(*) AS n, SUM(crossing_count) AS crossings FROM c WHERE mode_id = {O.MODE_ID['Truck']} GROUP BY 1""")
def filter_eq(m):
    c = conform.filter_eq(m.crossing(), "mode_id", catalogs.mode_ids()["Truck"])
    return c.groupBy("port_id").agg(F.count(F.lit(1)).alias("n"), F.sum("crossing_count").alias("crossings"))


@key("filter_exclude_nullsafe", """
SELECT direction, count(*) AS n FROM t WHERE weight_kg IS DISTINCT FROM 0 GROUP BY 1""")
def filter_exclude_nullsafe(m):
    return conform.exclude_value(m.trade(), "weight_kg", 0).groupBy("direction").agg(F.count(F.lit(1)).alias("n"))


@key("filter_between", """
SELECT date_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t
WHERE data_source = 'national' AND date_id BETWEEN 19980101 AND 19981231 GROUP BY 1""")
def filter_between(m):
    lo, hi = dates.year_range(1998)
    t = m.trade().where((F.col("data_source") == NAT) & F.col("date_id").between(lo, hi))
    return agg.sum_by(t, ["date_id"], "value_usd", "value_usd")


@key("filter_in", f"""
SELECT port_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t
WHERE port_id IN ({O.in_list(P.corridor_ports)}) GROUP BY 1""")
def filter_in(m):
    return agg.sum_by(m.trade().where(F.col("port_id").isin(*m.p.corridor_ports)), ["port_id"], "value_usd", "value_usd")


@key("filter_dim_flag", """
SELECT port_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t JOIN port USING (port_id)
WHERE NOT port.is_aggregate AND data_source = 'national' GROUP BY 1""")
def filter_dim_flag(m):
    ports = m.port_flags.where(~F.col("is_aggregate")).select("port_id")
    t = m.trade().where(F.col("data_source") == NAT).join(ports, "port_id")
    return agg.sum_by(t, ["port_id"], "value_usd", "value_usd")


def _month_text(m):
    """orders with a 'Mon yyyy' period text; every 17th order carries junk."""
    o = m.table("orders")
    txt = F.when(F.pmod("o_orderkey", F.lit(17)) == 0, F.concat(F.lit("?? "), F.year("o_orderdate").cast("string"))) \
        .otherwise(F.date_format("o_orderdate", "MMM yyyy"))
    return o.select("o_orderkey", txt.alias("period_text"))


@key("parse_month_tolerant", """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, count(*) AS n FROM (
  SELECT CAST(try_strptime(CASE WHEN o_orderkey % 17 = 0 THEN '?? ' || CAST(year(o_orderdate) AS VARCHAR)
                               ELSE strftime(o_orderdate, '%b %Y') END, '%b %Y') AS DATE) AS d FROM orders)
GROUP BY 1, 2""")
def parse_month_tolerant(m):
    d = dates.parse_month_year("period_text")
    return _month_text(m).select(d.alias("d")).groupBy(F.year("d").alias("year"), F.month("d").alias("month")) \
        .agg(F.count(F.lit(1)).alias("n"))


@key("parse_iso_tolerant", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, count(*) AS n
FROM (SELECT TRY_CAST(CASE WHEN event_id % 19 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS TIMESTAMP) AS ts
      FROM events) GROUP BY 1, 2, 3""")
def parse_iso_tolerant(m):
    e = m.table("events")
    txt = F.when(F.pmod("event_id", F.lit(19)) == 0, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    ts = dates.parse_iso_timestamp(txt)
    return e.select(ts.alias("ts")).groupBy(F.year("ts").alias("year"), F.month("ts").alias("month"),
                                            F.dayofmonth("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@key("date_key", "SELECT DISTINCT date_id FROM c")
def date_key(m):
    return m.crossing().select("date_id").distinct()


@key("parse_port_code", f"SELECT DISTINCT depe, {O.parse_port_sql('depe')} AS port_code FROM dl")
def parse_port_code(m):
    return m.trade_port_text().select("depe", codes.parse_port_code("depe").alias("port_code")).distinct()


@key("map_code_label", f"""
SELECT l_linenumber AS mode_code, {O.case('l_linenumber', catalogs.TRADE_MODE_CODE_TO_MODE)} AS mode_name, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def map_code_label(m):
    li = m.table("lineitem")
    return li.groupBy(F.col("l_linenumber").alias("mode_code"),
                      codes.map_values("l_linenumber", catalogs.TRADE_MODE_CODE_TO_MODE).alias("mode_name")) \
        .agg(F.count(F.lit(1)).alias("n"))


_PRIORITY_TO_MEASURE = {"1-URGENT": "Trucks", "2-HIGH": "Personal Vehicles", "3-MEDIUM": "Pedestrians",
                        "4-NOT SPECIFIED": "Buses", "5-LOW": "Trains"}


@key("map_label_canonical", f"""
SELECT measure, {O.case('measure', catalogs.CROSSING_MEASURE_TO_MODE)} AS mode_name, count(*) AS n
FROM (SELECT {O.case('o_orderpriority', _PRIORITY_TO_MEASURE)} AS measure FROM orders) GROUP BY 1, 2""")
def map_label_canonical(m):
    o = m.table("orders").select(codes.map_values("o_orderpriority", _PRIORITY_TO_MEASURE).alias("measure"))
    return o.groupBy("measure", codes.map_values("measure", catalogs.CROSSING_MEASURE_TO_MODE).alias("mode_name")) \
        .agg(F.count(F.lit(1)).alias("n"))


@key("default_sentinel", """
SELECT COALESCE(CASE l_returnflag WHEN 'A' THEN 'Containerized' WHEN 'N' THEN 'Not Containerized' END, 'Unknown') AS container,
       COALESCE(CASE WHEN l_discount = 0 THEN NULL WHEN l_discount < 0.05 THEN 'Domestically Produced Goods'
                     ELSE 'Foreign Produced Goods' END, 'N/A') AS production_location, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def default_sentinel(m):
    li = m.table("lineitem")
    cont = codes.map_values(codes.map_values("l_returnflag", {"A": "1", "N": "0"}), catalogs.CONTAINER_CODE_TO_LABEL, "Unknown")
    flag = F.when(F.col("l_discount") == 0, F.lit(None).cast("double")).when(F.col("l_discount") < 0.05, 1.0).otherwise(2.0)
    loc = codes.map_values(flag, catalogs.ORIGIN_FLAG_TO_LOCATION, "N/A")
    return li.groupBy(cont.alias("container"), loc.alias("production_location")).agg(F.count(F.lit(1)).alias("n"))


@key("normalize_text", """
SELECT doc_id, md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS norm_md5,
       length(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS norm_len
FROM documents""")
def normalize_text(m):
    n = codes.normalize_text("text")
    return m.table("documents").select("doc_id", F.md5(n).alias("norm_md5"), F.length(n).alias("norm_len"))


@key("conditional_null", """
SELECT direction, count(*) - count(weight_kg) AS nulled, count(*) FILTER (WHERE weight_kg = 0) AS zeros, count(*) AS n
FROM t GROUP BY 1""")
def conditional_null(m):
    f = m.trade_feed()
    direction = codes.map_values("trade_type", catalogs.TRADE_TYPE_TO_DIRECTION)
    w = conform.nullify_when("weight_raw", (direction == "Export") & (F.col("weight_raw") == 0))
    x = f.select(direction.alias("direction"), w.alias("weight_kg"))
    return x.groupBy("direction").agg((F.count(F.lit(1)) - F.count("weight_kg")).alias("nulled"),
                                      F.count_if(F.col("weight_kg") == 0).alias("zeros"), F.count(F.lit(1)).alias("n"))


@key("cast_strict_vs_try", """
SELECT event_type, SUM(CAST(CAST(value AS VARCHAR) AS DOUBLE)) IS NOT NULL AS strict_ok,
       count(TRY_CAST(props AS BIGINT)) AS try_props, count(*) AS n
FROM events GROUP BY 1""")
def cast_strict_vs_try(m):
    e = m.table("events")
    return e.groupBy("event_type").agg(
        F.sum(F.col("value").cast("string").cast("double")).isNotNull().alias("strict_ok"),
        F.count(conform.try_long("props")).alias("try_props"), F.count(F.lit(1)).alias("n"))


@key("round_ingest", """
SELECT user_id % 3 + 1 AS port_id, event_type, CAST(SUM(CAST(round_even(value, 2) AS DECIMAL(6,2))) AS DECIMAL(38,2)) AS total
FROM events GROUP BY 1, 2""")
def round_ingest(m):
    e = m.table("events")
    return e.groupBy((F.pmod("user_id", F.lit(3)) + 1).alias("port_id"), "event_type") \
        .agg(F.sum(conform.round_ingest("value")).cast(DEC).alias("total"))


@key("rename", """
SELECT CAST(SUM(l_extendedprice) AS DECIMAL(38,2)) AS value_usd, SUM(l_quantity) AS weight_kg FROM (
  SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem)""")
def rename(m):
    li = m.table("lineitem").select(F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
                                    F.col("l_quantity").cast("long").alias("l_quantity"))
    r = conform.rename(li, {"l_extendedprice": "value_usd", "l_quantity": "weight_kg"})
    return r.agg(F.sum("value_usd").cast(DEC).alias("value_usd"), F.sum("weight_kg").alias("weight_kg"))


@key("tag_source", "SELECT 'national' AS data_source, count(*) AS n FROM orders")
def tag_source(m):
    return conform.tag(m.table("orders"), "data_source", NAT).groupBy("data_source").agg(F.count(F.lit(1)).alias("n"))


def _national_conform(m):
    """Raw-text national rows conformed: port code -> port id via the port
    dimension (left lookup), plus the reject reasons of each row."""
    li = m.trade_port_text()
    code = codes.parse_port_code("depe")
    ports = m.port_by_code().select(F.col("port_code").alias("_code"), "port_id")
    x = joins.lookup_join(li.select("*", code.alias("_code")), ports, "_code", "left", dim_small=None)
    mode = codes.map_values("l_linenumber", catalogs.TRADE_MODE_CODE_TO_MODE)
    return conform.with_reject_reasons(x.withColumn("mode_name", mode),
                                       {"port_unmapped": F.col("port_id"), "mode_unmapped": F.col("mode_name")})


_CONFORM_SQL = f""",
cf AS (SELECT dl.*, port.port_id, {O.case('l_linenumber', catalogs.TRADE_MODE_CODE_TO_MODE)} AS mode_name
       FROM dl LEFT JOIN (SELECT port_code, min(port_id) AS port_id FROM port GROUP BY 1) port ON port.port_code = {O.parse_port_sql('dl.depe')})"""


@key("reject_split", _CONFORM_SQL + """
SELECT count(*) FILTER (WHERE port_id IS NOT NULL AND mode_name IS NOT NULL) AS accepted,
       count(*) FILTER (WHERE port_id IS NULL OR mode_name IS NULL) AS rejected, count(*) AS total FROM cf""")
def reject_split(m):
    x = _national_conform(m)
    return x.agg(F.count_if(F.size("reject_reasons") == 0).alias("accepted"),
                  F.count_if(F.size("reject_reasons") > 0).alias("rejected"), F.count(F.lit(1)).alias("total"))


@key("reject_reasons", _CONFORM_SQL + """
SELECT 'port_unmapped' AS reason, count(*) AS n FROM cf WHERE port_id IS NULL
UNION ALL SELECT 'mode_unmapped', count(*) FROM cf WHERE mode_name IS NULL""")
def reject_reasons(m):
    _, rej = conform.reject_split(_national_conform(m).drop("reject_reasons"),
                                  {"port_unmapped": F.col("port_id"), "mode_unmapped": F.col("mode_name")})
    counts = conform.reject_counts(rej)
    reasons = m.spark.createDataFrame([("port_unmapped",), ("mode_unmapped",)], "reason string")
    # counts has one row per reason: a proven bound
    return reasons.join(F.broadcast(counts), "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))


@key("unmapped_codes", f"""
SELECT DISTINCT depe AS code FROM dl WHERE depe IS NOT NULL
  AND ({O.parse_port_sql('depe')} IS NULL OR {O.parse_port_sql('depe')} NOT IN (SELECT port_code FROM port))""")
def unmapped_codes(m):
    li = m.trade_port_text()
    known = (li.select("depe").distinct()
               .join(m.port_codes().select(F.col("port_code").alias("_c")), codes.parse_port_code("depe") == F.col("_c"))
               .select("depe"))
    return conform.unmapped_codes(li, "depe", known, "depe")


@key("derive_district", f"""
SELECT DISTINCT port_code, port_code // 100 AS district,
       COALESCE({O.case('port_code // 100', catalogs.DISTRICT_TO_STATE)}, 'Other') AS state,
       port_code IN (SELECT port_code FROM port WHERE is_in_corridor) AS is_in_corridor
FROM (SELECT {O.parse_port_sql('depe')} AS port_code FROM dl) WHERE port_code IS NOT NULL""")
def derive_district(m):
    c = m.trade_port_text().select(codes.parse_port_code("depe").alias("port_code")).where("port_code IS NOT NULL").distinct()
    corr = m.port_by_code().where("is_in_corridor").select("port_code", F.lit(True).alias("_corr"))
    d = codes.district_of("port_code")
    return c.join(F.broadcast(corr), "port_code", "left").select(
        "port_code", d.alias("district"), codes.state_of_district(d).alias("state"),
        F.coalesce("_corr", F.lit(False)).alias("is_in_corridor"))


@key("synthetic_names", f"""
SELECT DISTINCT port_code,
       CASE WHEN port_code % 100 = 99 THEN 'District ' || lpad(CAST(port_code // 100 AS VARCHAR), 2, '0') || 'XX residual'
            ELSE 'District ' || CAST(port_code // 100 AS VARCHAR) || ' aggregate (' || CAST(port_code AS VARCHAR) || ')' END AS name
FROM (SELECT {O.parse_port_sql('depe')} AS port_code FROM dl)
WHERE port_code IS NOT NULL AND port_code NOT IN (SELECT port_code FROM port)""")
def synthetic_names(m):
    new = dims.discover_port_members(m.trade_port_text(), "depe", m.port_codes())
    return new.select("port_code", F.col("port_canonical_name").alias("name"))


# ===========================================================================
# D joins
# ===========================================================================

@key("join_lookup_left", _CONFORM_SQL + """
SELECT port_id IS NOT NULL AS matched, count(*) AS n FROM cf GROUP BY 1""")
def join_lookup_left(m):
    x = _national_conform(m)
    return x.groupBy(F.col("port_id").isNotNull().alias("matched")).agg(F.count(F.lit(1)).alias("n"))


def _mangled_names(m):
    """lineitem rows carrying the part name as free text: every 3rd row upper
    case with trailing punctuation, every 5th with doubled spaces."""
    li = m.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = m.table("part").select("p_partkey", "p_name")
    x = li.join(part, li.l_partkey == part.p_partkey)
    txt = (F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.concat(F.upper("p_name"), F.lit(".")))
            .when(F.pmod("l_orderkey", F.lit(5)) == 0, F.regexp_replace("p_name", " ", "  "))
            .otherwise(F.col("p_name")))
    return x.select("l_partkey", txt.alias("commodity_text"))


@key("join_normalized_text", """,
x AS (SELECT l_partkey, CASE WHEN l_orderkey % 3 = 0 THEN upper(p_name) || '.'
                             WHEN l_orderkey % 5 = 0 THEN replace(p_name, ' ', '  ') ELSE p_name END AS commodity_text
      FROM lineitem JOIN part ON l_partkey = p_partkey),
cat AS (SELECT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS norm, min(p_partkey) AS code
        FROM part GROUP BY 1)
SELECT count(*) AS n_rows, count(cat.code) AS n_matched, count(*) FILTER (WHERE cat.code = x.l_partkey) AS n_same_key
FROM x LEFT JOIN cat ON cat.norm = trim(regexp_replace(lower(x.commodity_text), '[^a-z0-9]+', ' ', 'g'))""")
def join_normalized_text(m):
    x = _mangled_names(m).withColumn("norm", codes.normalize_text("commodity_text"))
    cat = m.table("part").groupBy(codes.normalize_text("p_name").alias("norm")).agg(F.min("p_partkey").alias("code"))
    j = x.join(cat, "norm", "left")
    return j.agg(F.count(F.lit(1)).alias("n_rows"), F.count("code").alias("n_matched"),
                 F.count_if(F.col("code") == F.col("l_partkey")).alias("n_same_key"))


@key("join_star1", """
SELECT port.state, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t JOIN port USING (port_id) GROUP BY 1""")
def join_star1(m):
    t = joins.star_join(m.trade(), [(m.dim_port().select("port_id", "state"), "port_id", None)])
    return agg.sum_by(t, ["state"], "value_usd", "value_usd")


@key("join_star2", """
SELECT port.state, part.p_type AS sector, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd
FROM t JOIN port USING (port_id) JOIN part ON t.commodity_id = part.p_partkey GROUP BY 1, 2""")
def join_star2(m):
    t = joins.star_join(m.trade(), [(m.dim_port().select("port_id", "state"), "port_id", None),
                                    (m.dim_commodity().select("commodity_id", F.col("sector_grouping").alias("sector")),
                                     "commodity_id", None)])
    return agg.sum_by(t, ["state", "sector"], "value_usd", "value_usd")


@key("join_star3", """
SELECT port.border, part.p_type AS sector, modes.mode_canonical_name AS mode, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd
FROM t JOIN port USING (port_id) JOIN part ON t.commodity_id = part.p_partkey JOIN modes USING (mode_id) GROUP BY 1, 2, 3""")
def join_star3(m):
    t = joins.star_join(m.trade(), [
        (m.dim_port().select("port_id", "border"), "port_id", None),
        (m.dim_commodity().select("commodity_id", F.col("sector_grouping").alias("sector")), "commodity_id", None),
        (m.dim_mode().select("mode_id", F.col("mode_canonical_name").alias("mode")), "mode_id", True)])
    return agg.sum_by(t, ["border", "sector", "mode"], "value_usd", "value_usd")


_VT_ALL = f""",
fv AS (SELECT date_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t WHERE port_id = {P.focus_port} GROUP BY 1),
ft AS (SELECT date_id, CAST(SUM(crossing_count) AS BIGINT) AS trucks FROM c
       WHERE port_id = {P.focus_port} AND mode_id = {O.MODE_ID['Truck']} GROUP BY 1)"""


def _vt_all(m):
    p = m.p
    v = agg.sum_by(m.trade().where(F.col("port_id") == p.focus_port), ["date_id"], "value_usd", "value_usd")
    t = m.crossing().where((F.col("port_id") == p.focus_port) & (F.col("mode_id") == catalogs.mode_ids()["Truck"]))
    return v, agg.sum_by(t, ["date_id"], "crossing_count", "trucks", "long")


@key("join_agg_agg_inner", _VT_ALL + "\nSELECT date_id, value_usd, trucks FROM fv JOIN ft USING (date_id)")
def join_agg_agg_inner(m):
    v, t = _vt_all(m)
    return v.join(t, "date_id")


@key("join_series_full_outer", _VT_ALL + """
SELECT COALESCE(fv.date_id, ft.date_id) AS date_id, value_usd, trucks FROM fv FULL OUTER JOIN ft ON fv.date_id = ft.date_id""")
def join_series_full_outer(m):
    v, t = _vt_all(m)
    return joins.full_outer_series(v, t, "date_id")


@key("anti_orphans", f"""
SELECT DISTINCT {O.parse_port_sql('depe')} AS port_code FROM dl
WHERE {O.parse_port_sql('depe')} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM port WHERE port.port_code = {O.parse_port_sql('dl.depe')})""")
def anti_orphans(m):
    c = m.trade_port_text().select(codes.parse_port_code("depe").alias("port_code")).where("port_code IS NOT NULL").distinct()
    return joins.anti_orphans(c, m.port_codes(), "port_code")


@key("semi_catalog_match", f"""
SELECT p_type AS sector,
       count(*) FILTER (WHERE EXISTS (SELECT 1 FROM t WHERE t.commodity_id = part.p_partkey AND t.port_id = {P.focus_port})) AS n_matched,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.commodity_id = part.p_partkey AND t.port_id = {P.focus_port})) AS n_unmatched
FROM part GROUP BY 1""")
def semi_catalog_match(m):
    cat = m.dim_commodity()
    used = m.trade().where(F.col("port_id") == m.p.focus_port).select("commodity_id")
    hit = joins.semi_match(cat, used, "commodity_id").groupBy("sector_grouping").agg(F.count(F.lit(1)).alias("n_matched"))
    miss = cat.join(used, "commodity_id", "left_anti").groupBy("sector_grouping").agg(F.count(F.lit(1)).alias("n_unmatched"))
    sectors = cat.select("sector_grouping").distinct()
    return (sectors.join(hit, "sector_grouping", "left").join(miss, "sector_grouping", "left")
            .select(F.col("sector_grouping").alias("sector"), F.coalesce("n_matched", F.lit(0)).alias("n_matched"),
                    F.coalesce("n_unmatched", F.lit(0)).alias("n_unmatched")))


@key("join_gapfill", f""",
cm AS (SELECT date_id, SUM(crossing_count) AS crossings FROM c WHERE port_id = 9 GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(DATE '{P.series_start}', (SELECT max({O.kdate('date_id')}) FROM c),
          INTERVAL 1 MONTH)) AS DATE) AS month_date)
SELECT s.month_date, cm.crossings FROM spine s LEFT JOIN cm ON {O.kdate('cm.date_id')} = s.month_date""")
def join_gapfill(m):
    c = m.crossing()
    cm = (c.where(F.col("port_id") == 9).groupBy("date_id").agg(F.sum("crossing_count").alias("crossings"))
           .select(dates.key_to_date("date_id").alias("month_date"), "crossings"))
    bounds = c.agg(F.max(dates.key_to_date("date_id")).alias("end")).withColumn("start", F.lit(m.p.series_start).cast("date"))
    return series.gapfill(series.month_spine(bounds, "start", "end"), cm, "month_date")


@key("ratio_to_focus", f"""
SELECT port_id, v AS value_usd,
       round(CASE WHEN port_id <> {P.focus_port} AND CAST(v AS DOUBLE) <> 0
             THEN CAST(max(CASE WHEN port_id = {P.focus_port} THEN v END) OVER () AS DOUBLE) / CAST(v AS DOUBLE) END, 1) AS ratio_to_ref
FROM (SELECT port_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS v FROM t JOIN port USING (port_id)
      WHERE port.is_in_corridor GROUP BY 1)""")
def ratio_to_focus(m):
    corr = m.port_flags.where("is_in_corridor").select("port_id")
    s = agg.sum_by(m.trade().join(corr, "port_id"), ["port_id"], "value_usd", "value_usd")
    return joins.ratio_to_reference(s, "port_id", "value_usd", m.p.focus_port)


@key("cross_scalars", """
SELECT CAST((SELECT SUM(value_usd) FROM t) AS DECIMAL(38,2)) AS total_value,
       (SELECT SUM(crossing_count) FROM c) AS total_crossings,
       round(CAST((SELECT SUM(value_usd) FROM t) AS DOUBLE) / CAST((SELECT SUM(crossing_count) FROM c) AS DOUBLE), 2) AS value_per_crossing""")
def cross_scalars(m):
    a = m.trade().agg(F.sum("value_usd").cast(DEC).alias("total_value"))
    b = m.crossing().agg(F.sum("crossing_count").alias("total_crossings"))
    j = marts._one_row(a, b)
    return j.select("total_value", "total_crossings",
                    F.round(metrics.safe_div("total_value", "total_crossings"), 2).alias("value_per_crossing"))


@key("join_calendar", f""",
cal AS (SELECT {O.dkey('d')} AS date_id, year(d) AS year, monthname(d) AS month_name
        FROM (SELECT CAST(unnest(generate_series((SELECT min({O.kdate('date_id')}) FROM t),
                                                 (SELECT max({O.kdate('date_id')}) FROM t), INTERVAL 1 DAY)) AS DATE) AS d))
SELECT cal.year, cal.month_name, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd
FROM t JOIN cal USING (date_id) GROUP BY 1, 2""")
def join_calendar(m):
    # the fact is reduced to its months once; bounds and sums both come from them
    months = m.bounded_frame("trade_months", lambda x: agg.sum_by(x.trade(), ["date_id"], "value_usd", "value_usd"))
    bounds = months.agg(F.min(dates.key_to_date("date_id")).alias("s"), F.max(dates.key_to_date("date_id")).alias("e"))
    cal = dims.calendar_attributes(series.day_spine(bounds, "s", "e"), "full_date").select("date_id", "year", "month_name")
    # the calendar is bounded by the fact's date range (days), so it is broadcast
    j = months.join(F.broadcast(cal), "date_id")
    return agg.sum_by(j, ["year", "month_name"], "value_usd", "value_usd")


# ===========================================================================
# E dimension building
# ===========================================================================

_CAL_SQL = f""",
days AS (SELECT CAST(unnest(generate_series((SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem),
                                            (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem), INTERVAL 1 DAY)) AS DATE) AS d)"""


def _calendar(m):
    li = m.table("lineitem")
    bounds = li.agg(F.min(F.to_date("l_shipdate")).alias("s"), F.max(F.to_date("l_shipdate")).alias("e"))
    return dims.calendar_attributes(series.day_spine(bounds, "s", "e"), "full_date")


@key("calendar_daily", _CAL_SQL + f"""
SELECT strftime(d, '%Y-%m') AS year_month, count(*) AS n_days, count(*) FILTER (WHERE isodow(d) >= 6) AS n_weekend
FROM days GROUP BY 1""")
def calendar_daily(m):
    c = _calendar(m)
    return c.groupBy("year_month").agg(F.count(F.lit(1)).alias("n_days"), F.count_if("is_weekend").alias("n_weekend"))


@key("dim_date", _CAL_SQL + f"""
SELECT {O.dkey('d')} AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
       dayname(d) AS day_of_week_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year, strftime(d, '%Y-%m') AS year_month,
       isodow(d) >= 6 AS is_weekend
FROM days""")
def dim_date(m):
    return _calendar(m)


@key("latest_per_key", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) AS rn
  FROM orders) WHERE rn = 1""")
def latest_per_key(m):
    return dims.latest_per_key(m.table("orders"), "o_custkey", "o_orderdate", ["o_orderkey", "o_totalprice"]) \
        .select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")


@key("surrogate_ids", """
SELECT sector, CAST(row_number() OVER (ORDER BY sector) + 100 AS INTEGER) AS id FROM (SELECT DISTINCT p_type AS sector FROM part)""")
def surrogate_ids(m):
    members = m.table("part").select(F.col("p_type").alias("sector")).distinct()
    return dims.surrogate_ids(members, "sector", "id", start_after=100)


@key("insert_if_absent", f"""
SELECT port_code, arg_min(port_canonical_name, port_id) AS port_canonical_name, arg_min(is_aggregate, port_id) AS is_aggregate FROM port GROUP BY 1
UNION ALL
SELECT DISTINCT code, CASE WHEN code % 100 = 99 THEN 'District ' || lpad(CAST(code // 100 AS VARCHAR), 2, '0') || 'XX residual'
            ELSE 'District ' || CAST(code // 100 AS VARCHAR) || ' aggregate (' || CAST(code AS VARCHAR) || ')' END, TRUE
FROM (SELECT {O.parse_port_sql('depe')} AS code FROM dl) WHERE code IS NOT NULL AND code NOT IN (SELECT port_code FROM port)""")
def insert_if_absent(m):
    existing = m.port_by_code().select("port_code", "port_canonical_name", "is_aggregate")
    new = dims.discover_port_members(m.trade_port_text(), "depe", m.port_codes())
    return dims.insert_if_absent(new.select("port_code", "port_canonical_name", "is_aggregate"), existing, "port_code")


@key("discover_members", f"""
SELECT DISTINCT code AS port_code,
       COALESCE({O.case('code // 100', catalogs.DISTRICT_TO_STATE)}, 'Other') AS state, TRUE AS is_aggregate, FALSE AS is_in_corridor
FROM (SELECT {O.parse_port_sql('depe')} AS code FROM dl) WHERE code IS NOT NULL AND code NOT IN (SELECT port_code FROM port)""")
def discover_members(m):
    new = dims.discover_port_members(m.trade_port_text(), "depe", m.port_codes())
    return new.select("port_code", "state", "is_aggregate", "is_in_corridor")


@key("sector_distribution", "SELECT p_type AS sector_grouping, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC")
def sector_distribution(m):
    return agg.value_counts(m.dim_commodity(), "sector_grouping").orderBy(F.desc("n"))


@key("mode_provenance", f"""
SELECT COALESCE(a.member, b.member) AS member,
       CASE WHEN a.member IS NOT NULL AND b.member IS NOT NULL THEN 'both' WHEN a.member IS NOT NULL THEN 'transborder'
            ELSE 'border_crossing' END AS source_dataset
FROM (SELECT DISTINCT {O.case('l_linenumber', catalogs.TRADE_MODE_CODE_TO_MODE)} AS member FROM lineitem) a
FULL OUTER JOIN (SELECT DISTINCT {O.case('o_orderpriority', PRIORITY_TO_MODE)} AS member FROM orders) b
ON a.member = b.member""")
def mode_provenance(m):
    a = m.table("lineitem").select(codes.map_values("l_linenumber", catalogs.TRADE_MODE_CODE_TO_MODE).alias("member"))
    b = m.table("orders").select(codes.map_values("o_orderpriority", PRIORITY_TO_MODE).alias("member"))
    return dims.member_provenance(a, "member", "transborder", b, "member", "border_crossing")


# ===========================================================================
# G windows
# ===========================================================================

@key("share_total", """
SELECT port_id, round(CAST(v AS DOUBLE) / CAST(SUM(v) OVER () AS DOUBLE) * 100, 2) AS pct FROM (
  SELECT port_id, SUM(value_usd) AS v FROM t WHERE data_source = 'national' GROUP BY 1)""")
def share_total(m):
    s = m.trade().where(F.col("data_source") == NAT).groupBy("port_id").agg(F.sum("value_usd").alias("v"))
    return windows.share_of_total(s, "v", "pct").select("port_id", "pct")


@key("share_partition", f"""
SELECT CAST(year AS INTEGER) AS year, container, round(CAST(v AS DOUBLE) / CAST(SUM(v) OVER (PARTITION BY year) AS DOUBLE) * 100, 2) AS pct
FROM (SELECT {O.yr()} AS year, container, SUM(value_usd) AS v FROM t WHERE data_source = 'national' GROUP BY 1, 2)""")
def share_partition(m):
    s = m.trade().where(F.col("data_source") == NAT).groupBy(_yr().alias("year"), "container").agg(F.sum("value_usd").alias("v"))
    return windows.share_of_total(s, "v", "pct", partition=["year"]).select(F.col("year").cast("int").alias("year"), "container", "pct")


@key("ttm_vs_prev", f""",
nat AS (SELECT * FROM t WHERE data_source = 'national'),
bb AS (SELECT end_id, {O.shift('end_id', -11)} AS s_id, {O.shift('end_id', -12)} AS pe_id, {O.shift('end_id', -23)} AS ps_id
       FROM (SELECT max(date_id) AS end_id FROM nat))
SELECT bb.end_id, CAST(SUM(CASE WHEN date_id BETWEEN s_id AND end_id THEN value_usd END) AS DECIMAL(38,2)) AS ttm,
       CAST(SUM(CASE WHEN date_id BETWEEN ps_id AND pe_id THEN value_usd END) AS DECIMAL(38,2)) AS prev_ttm
FROM nat, bb GROUP BY bb.end_id""")
def ttm_vs_prev(m):
    nat = agg.sum_by(m.trade().where(F.col("data_source") == NAT), ["date_id"], "value_usd", "v")
    end = F.max("date_id").over(Window.partitionBy())          # month rows: bounded
    x = nat.withColumn("end_id", end)
    d = F.col("date_id")
    ttm = d.between(dates.shift_month_key("end_id", -11), F.col("end_id"))
    prev = d.between(dates.shift_month_key("end_id", -23), dates.shift_month_key("end_id", -12))
    return x.agg(F.max("end_id").alias("end_id"), F.sum(F.when(ttm, F.col("v"))).cast(DEC).alias("ttm"),
                 F.sum(F.when(prev, F.col("v"))).cast(DEC).alias("prev_ttm"))


@key("ttm_rolling", f"""
SELECT port_id, date_id, CAST(SUM(v) OVER (PARTITION BY port_id ORDER BY mi RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS ttm
FROM (SELECT port_id, date_id, ({O.yr()}) * 12 + ((date_id // 100) % 100) - 1 AS mi, SUM(value_usd) AS v
      FROM t WHERE port_id IN ({O.in_list(P.corridor_ports)}) GROUP BY 1, 2)""")
def ttm_rolling(m):
    s = m.trade().where(F.col("port_id").isin(*m.p.corridor_ports)).groupBy("port_id", "date_id") \
        .agg(F.sum("value_usd").alias("v")).withColumn("month_date", dates.key_to_date("date_id"))
    r = windows.trailing_months_sum(s, "month_date", "v", "ttm", 12, partition=["port_id"])
    return r.select("port_id", "date_id", F.col("ttm").cast(DEC).alias("ttm"))


@key("trailing_days_avg", f""",
{O._wait_window(P)}
SELECT port_id, lane_type_id, {O.mhu('SUM(' + O.cents('waiting_avg_minutes') + ')', 'COUNT(*)')} AS avg_min, COUNT(*) AS n_days
FROM w, wwin WHERE date_id BETWEEN wwin.start_id AND wwin.end_id GROUP BY 1, 2""")
def trailing_days_avg(m):
    w = m.wait()
    days = w.select("date_id").distinct()
    end = F.max("date_id").over(Window.partitionBy())           # distinct days: bounded
    win = days.withColumn("_s", dates.date_key(F.date_sub(dates.key_to_date(end), m.p.wait_window_days))) \
        .withColumn("_e", end).where(F.col("date_id").between(F.col("_s"), F.col("_e"))).select("date_id")
    x = w.join(F.broadcast(win), "date_id")
    return x.groupBy("port_id", "lane_type_id").agg(F.sum(metrics.cents("waiting_avg_minutes")).alias("_c"),
                                                    F.count(F.lit(1)).alias("n_days")) \
        .select("port_id", "lane_type_id", metrics.mean_half_up("_c", "n_days").alias("avg_min"), "n_days")


@key("recovery_length", f""",
fm AS (SELECT port_id, date_id, SUM(value_usd) AS v FROM t WHERE port_id IN ({O.in_list(P.corridor_ports)}) GROUP BY 1, 2),
th AS (SELECT port_id, CAST(SUM(CASE WHEN {O.yr()} = {P.base_year} THEN v END) AS DOUBLE) / 12 AS thr FROM fm GROUP BY 1),
r AS (SELECT fm.port_id, v, thr, row_number() OVER (PARTITION BY fm.port_id ORDER BY date_id) AS rn FROM fm JOIN th USING (port_id)
      WHERE date_id BETWEEN {P.shock_year * 10000 + 101} AND {P.recovery_end_year * 10000 + 1231}),
mn AS (SELECT port_id, arg_min(rn, (v, rn)) AS min_rn FROM r GROUP BY 1)
SELECT mn.port_id, mn.min_rn AS min_row, MIN(CASE WHEN r.rn > mn.min_rn AND CAST(r.v AS DOUBLE) >= r.thr THEN r.rn END) - mn.min_rn AS recovery_rows
FROM mn JOIN r USING (port_id) GROUP BY mn.port_id, mn.min_rn""")
def recovery_length(m):
    p = m.p
    fm = m.trade().where(F.col("port_id").isin(*p.corridor_ports)).groupBy("port_id", "date_id").agg(F.sum("value_usd").alias("v"))
    thr = F.sum(F.when(_yr() == p.base_year, F.col("v"))).over(Window.partitionBy("port_id")).cast("double") / 12
    lo, _ = dates.year_range(p.shock_year)
    _, hi = dates.year_range(p.recovery_end_year)
    x = fm.withColumn("thr", thr).where(F.col("date_id").between(lo, hi))
    r = windows.argmin_then_recovery(x, "date_id", "v", F.col("thr"), partition=["port_id"])
    return r.select("port_id", F.col("min_row").cast("long").alias("min_row"), F.col("recovery_rows").cast("long").alias("recovery_rows"))


@key("series_index", f"""
SELECT port_id, date_id, CAST(row_number() OVER (PARTITION BY port_id ORDER BY date_id) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT port_id, date_id FROM t WHERE port_id IN ({O.in_list(P.corridor_ports)}) AND data_source = 'national')""")
def series_index(m):
    s = m.trade().where(F.col("port_id").isin(*m.p.corridor_ports) & (F.col("data_source") == NAT)) \
        .select("port_id", "date_id").distinct()
    return windows.series_index(s, "date_id", "idx", partition=["port_id"])


@key("dup_mark", """
SELECT is_dup, count(*) AS n FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_dup FROM lineitem) GROUP BY 1""")
def dup_mark(m):
    x = windows.dup_mark(m.table("lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], max_rows=m.max_broadcast_rows)
    return x.groupBy("is_dup").agg(F.count(F.lit(1)).alias("n"))


# ===========================================================================
# K series shaping
# ===========================================================================

@key("gapfill_null", f""",
g AS (SELECT * FROM t WHERE date_id NOT {O.yrange(P.gap_year)}),
f AS (SELECT date_id, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM g
      WHERE port_id = {P.focus_port} AND data_source = 'national' GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(DATE '{P.series_start}', (SELECT max({O.kdate('date_id')}) FROM g),
          INTERVAL 1 MONTH)) AS DATE) AS month_date)
SELECT s.month_date, f.value_usd FROM spine s LEFT JOIN f ON {O.kdate('f.date_id')} = s.month_date""")
def gapfill_null(m):
    t = m.trade_with_gap()
    # the spine ends at the last month of the whole fact: one scan carries both
    x = t.groupBy("date_id").agg(F.sum(F.when((F.col("port_id") == m.p.focus_port) & (F.col("data_source") == NAT),
                                              F.col("value_usd"))).cast(DEC).alias("value_usd"))
    x = x.withColumn("month_date", dates.key_to_date("date_id"))
    return series.gapfill_months(x, "month_date", ["value_usd"], m.p.series_start)


register("pivot_zero_fill", lambda spark, d: marts.mart_sector_history(model(spark, d), "brand"),
         O.mart_sector_history(P, "p_brand"))


@key("heatmap_long", f"""
SELECT port_id, lane_type_id, CAST(weekofyear(d) AS INTEGER) AS iso_week, CAST(isodow(d) AS INTEGER) AS iso_dow,
       {O.mhu('SUM(' + O.cents('waiting_avg_minutes') + ')', 'COUNT(*)')} AS avg_min, COUNT(*) AS n_days
FROM (SELECT *, {O.kdate('date_id')} AS d FROM w) GROUP BY 1, 2, 3, 4""")
def heatmap_long(m):
    w = m.wait().withColumn("full_date", dates.key_to_date("date_id"))
    return series.heatmap_long(w, ["port_id", "lane_type_id"], "full_date",
                               F.sum(metrics.cents("waiting_avg_minutes")).alias("_c"), "n_days") \
        .select("port_id", "lane_type_id", F.col("iso_week").cast("int").alias("iso_week"),
                F.col("iso_dow").cast("int").alias("iso_dow"), metrics.mean_half_up("_c", "n_days").alias("avg_min"), "n_days")


# FIXED VALUES: timeline annotations (period, label) shown with the national series.
ANNOTATIONS = [("1997-01-01", "Gap: year missing from the national feed"),
               ("1998-01-01", "Shock year"),
               ("2000-11-01", "Last national month")]


@key("annotations", f""",
f AS (SELECT {O.kdate('date_id')} AS month_date, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd FROM t
      WHERE data_source = 'national' GROUP BY date_id),
a AS (SELECT CAST(d AS DATE) AS month_date, label FROM (VALUES {', '.join(f"('{d}', {O.q(l)})" for d, l in ANNOTATIONS)}) v(d, label))
SELECT a.month_date, a.label, f.value_usd FROM a LEFT JOIN f USING (month_date)""")
def annotations(m):
    f = agg.sum_by(m.trade().where(F.col("data_source") == NAT), ["date_id"], "value_usd", "value_usd") \
        .select(dates.key_to_date("date_id").alias("month_date"), "value_usd")
    a = m.spark.createDataFrame(ANNOTATIONS, "d string, label string").select(F.col("d").cast("date").alias("month_date"), "label")
    return a.join(f, "month_date", "left").select("month_date", "label", "value_usd")


# ===========================================================================
# A scans on tables, B sink-side summaries
# ===========================================================================

@key("scan_filter", f"""
SELECT * FROM t WHERE data_source = 'national' AND port_id = {P.focus_port} AND date_id {O.yrange(P.base_year)}""")
def scan_filter(m):
    lo, hi = dates.year_range(m.p.base_year)
    return m.trade().where((F.col("data_source") == NAT) & (F.col("port_id") == m.p.focus_port)
                           & F.col("date_id").between(lo, hi))


@key("literal_catalog", """
SELECT modes.mode_id, modes.mode_canonical_name, modes.source_dataset, count(t.mode_id) AS n_rows
FROM modes LEFT JOIN t USING (mode_id) GROUP BY 1, 2, 3""")
def literal_catalog(m):
    modes = m.dim_mode()
    used = m.trade().groupBy("mode_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return F.broadcast(modes).join(used, "mode_id", "left").select(
        "mode_id", "mode_canonical_name", "source_dataset", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@key("source_group_count", """
SELECT port.port_code, port.port_canonical_name, count(*) AS n FROM t JOIN port USING (port_id) GROUP BY 1, 2""")
def source_group_count(m):
    t = m.trade().join(m.dim_port().select("port_id", "port_code", "port_canonical_name"), "port_id")
    return t.groupBy("port_code", "port_canonical_name").agg(F.count(F.lit(1)).alias("n"))


@key("load_summary", _CONFORM_SQL + f""",
acc AS (SELECT * FROM cf WHERE port_id IS NOT NULL AND mode_name IS NOT NULL)
SELECT (SELECT count(*) FROM lineitem) AS raw_rows,
       (SELECT count(*) FROM cf) AS in_scope_rows,
       (SELECT count(*) FROM cf WHERE port_id IS NULL OR mode_name IS NULL) AS rejected_rows,
       (SELECT count(*) FROM (SELECT DISTINCT port_id, l_partkey, l_linenumber, {O.mkey('l_shipdate')} AS m FROM acc)) AS inserted_rows,
       (SELECT count(DISTINCT {O.mkey('l_shipdate')}) FROM acc) AS months""")
def load_summary(m):
    x = _national_conform(m)
    ok = F.size("reject_reasons") == 0
    mk = dates.month_key("l_shipdate")
    s = x.agg(F.count(F.lit(1)).alias("in_scope_rows"), F.count_if(~ok).alias("rejected_rows"),
              F.count_distinct(F.when(ok, mk)).alias("months"))
    ins = (x.where(ok).select("port_id", "l_partkey", "l_linenumber", mk.alias("m")).distinct()
             .agg(F.count(F.lit(1)).alias("inserted_rows")))
    raw = m.table("lineitem").agg(F.count(F.lit(1)).alias("raw_rows"))
    return marts._one_row(raw, s, ins).select("raw_rows", "in_scope_rows", "rejected_rows", "inserted_rows", "months")


@key("audit_column", "SELECT port_id, mode_id, date_id, crossing_count, TRUE AS stamped, TRUE AS one_load FROM c")
def audit_column(m):
    """B6: the load stamp; one statement has one, the same in every row."""
    x = with_audit(m.crossing())
    now = F.current_timestamp()
    return x.select("port_id", "mode_id", "date_id", "crossing_count", F.col("loaded_at").isNotNull().alias("stamped"), (F.col("loaded_at") == now).alias("one_load"))


# ===========================================================================
# M data quality
# ===========================================================================

@key("dq_pk", f"""
SELECT 'fact_trade' AS "check", count(*) AS dup_groups, COALESCE(SUM(n), 0) AS dup_rows
FROM (SELECT count(*) AS n FROM t GROUP BY {_TPK} HAVING count(*) > 1)
UNION ALL SELECT 'fact_crossing', count(*), COALESCE(SUM(n), 0) FROM (SELECT count(*) AS n FROM c GROUP BY port_id, mode_id, date_id HAVING count(*) > 1)
UNION ALL SELECT 'fact_wait', count(*), COALESCE(SUM(n), 0) FROM (SELECT count(*) AS n FROM w GROUP BY port_id, lane_type_id, date_id HAVING count(*) > 1)
UNION ALL SELECT 'dim_port', count(*), COALESCE(SUM(n), 0) FROM (SELECT count(*) AS n FROM port GROUP BY port_id HAVING count(*) > 1)""")
def dq_pk(m):
    from portflow.schemas import FACT_CROSSING_PK, FACT_TRADE_PK, FACT_WAIT_PK
    return (quality.pk_violations(m.trade(), FACT_TRADE_PK, "fact_trade")
            .unionByName(quality.pk_violations(m.crossing(), FACT_CROSSING_PK, "fact_crossing"))
            .unionByName(quality.pk_violations(m.wait(), FACT_WAIT_PK, "fact_wait"))
            .unionByName(quality.pk_violations(m.dim_port(), ["port_id"], "dim_port")))


@key("dq_unique", _CAL_SQL + f"""
SELECT 'dim_port.port_code' AS "check", count(*) AS dup_groups, COALESCE(SUM(n), 0) AS dup_rows
FROM (SELECT count(*) AS n FROM port GROUP BY port_code HAVING count(*) > 1)
UNION ALL SELECT 'dim_port.port_canonical_name', count(*), COALESCE(SUM(n), 0) FROM (SELECT count(*) AS n FROM port GROUP BY port_canonical_name HAVING count(*) > 1)
UNION ALL SELECT 'dim_mode.mode_canonical_name', count(*), COALESCE(SUM(n), 0) FROM (SELECT count(*) AS n FROM modes GROUP BY mode_canonical_name HAVING count(*) > 1)
UNION ALL SELECT 'dim_lane.lane_canonical_name', count(*), COALESCE(SUM(n), 0) FROM (SELECT count(*) AS n FROM lanes GROUP BY lane_canonical_name HAVING count(*) > 1)
UNION ALL SELECT 'dim_date.full_date', count(*), COALESCE(SUM(n), 0) FROM (SELECT count(*) AS n FROM days GROUP BY d HAVING count(*) > 1)
UNION ALL SELECT 'dim_commodity.hs2_code', count(*), COALESCE(SUM(n), 0)
FROM (SELECT count(*) AS n FROM (VALUES {', '.join(f'({c[0]})' for c in catalogs.HS2_CHAPTERS)}) v(hs2_code) GROUP BY hs2_code HAVING count(*) > 1)""")
def dq_unique(m):
    """M2: natural keys of the dimensions.  Suppliers beyond 3,000 share port codes, and that shows here."""
    from portflow.plans.jobs import commodity_dimension
    port = m.dim_port()
    return (quality.pk_violations(port, ["port_code"], "dim_port.port_code")
            .unionByName(quality.pk_violations(port, ["port_canonical_name"], "dim_port.port_canonical_name"))
            .unionByName(quality.pk_violations(m.dim_mode(), ["mode_canonical_name"], "dim_mode.mode_canonical_name"))
            .unionByName(quality.pk_violations(m.dim_lane(), ["lane_canonical_name"], "dim_lane.lane_canonical_name"))
            .unionByName(quality.pk_violations(_calendar(m), ["full_date"], "dim_date.full_date"))
            .unionByName(quality.pk_violations(commodity_dimension(m.spark), ["hs2_code"], "dim_commodity.hs2_code")))


_STAR = constraints.star_schema(P.borders)
#: the star schema's tables in SQL, named as the rules name them
_STAR_SQL = f""",
dim_port AS (SELECT * FROM port), dim_mode AS (SELECT * FROM modes), dim_lane AS (SELECT * FROM lanes), members AS (SELECT p_partkey AS commodity_id FROM part),
dim_commodity AS (SELECT row_number() OVER (ORDER BY hs2_code) AS commodity_id, *, trim(regexp_split_to_array(hs2_description_full, '[;,]')[1]) AS hs2_description_short
  FROM (VALUES {', '.join(f"({code}, {O.q(text)}, {O.q(sector)})" for code, text, sector in catalogs.HS2_CHAPTERS)}) v(hs2_code, hs2_description_full, sector_grouping)),
dim_date AS (SELECT {O.dkey('d')} AS date_id, d AS full_date, year(d) AS year, month(d) AS month, monthname(d) AS month_name, day(d) AS day, isodow(d) AS day_of_week,
  dayname(d) AS day_of_week_name, weekofyear(d) AS week_of_year, strftime(d, '%Y-%m') AS year_month
  FROM (SELECT CAST(unnest(generate_series(DATE '{P.calendar_start}', DATE '{P.calendar_end}', INTERVAL 1 DAY)) AS DATE) AS d)),
fact_trade AS (SELECT *, now() AS loaded_at FROM t), fact_crossing AS (SELECT *, now() AS loaded_at FROM c), fact_wait AS (SELECT *, now() AS loaded_at FROM w)
"""


def _rules_sql(*kinds: str) -> str:
    """One counting SELECT per rule of these kinds."""
    found = []
    for table, r in _STAR.items():
        wrong = [("not_null", c, f"{c} IS NULL") for c in r.not_null] + [("max_len", c, f"length({c}) > {n}") for c, n in r.max_len.items()]
        wrong += [("check", name, f"NOT ({sql})") for name, sql in r.checks.items()]
        wrong += [("foreign", c, f"{c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {dim})") for c, (dim, k) in r.foreign.items()]
        found += [f"""SELECT '{table}' AS "table", '{kind}' AS kind, '{rule}' AS rule, count(*) AS violations FROM {table} WHERE {sql}""" for kind, rule, sql in wrong if kind in kinds]
        found += [f"""SELECT '{table}', 'unique', '{','.join(u)}', CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {table}
            WHERE {' AND '.join(f'{c} IS NOT NULL' for c in u)} GROUP BY {', '.join(u)} HAVING count(*) > 1)""" for u in r.unique if "unique" in kinds]
    return _STAR_SQL + "\nUNION ALL ".join(found)


def _rules(m, *kinds):
    return rules.schema_violations(_STAR, constraints.model_frames(m), kinds, m.max_broadcast_rows)


@key("dq_fk", _rules_sql("foreign"))
def dq_fk(m):
    """M3: all ten foreign keys, one scan per fact."""
    return _rules(m, "foreign")


@key("dq_check", _rules_sql("check"))
def dq_check(m):
    """M4: every CHECK of dimensions and facts, one scan per table."""
    return _rules(m, "check")


@key("dq_not_null", _rules_sql("not_null", "max_len"))
def dq_not_null(m):
    """M5: every NOT NULL and length, one scan per table."""
    return _rules(m, "not_null", "max_len")


@key("dq_schema", _rules_sql(*rules.KINDS))
def dq_schema(m):
    """M2-M5 together: row rules and foreign keys of a fact in one aggregate over one scan."""
    return _rules(m, *rules.KINDS)


@key("dq_weight", """
SELECT count(*) AS n_rows, count(weight_kg) AS with_weight, count(*) FILTER (WHERE weight_kg > 0) AS positive, count(*) FILTER (WHERE NOT (weight_kg > 0)) AS zero_or_less FROM t""")
def dq_weight(m):
    """Three-valued logic of a CHECK: a NULL weight neither passes nor fails a comparison."""
    w = F.col("weight_kg")
    return m.trade().agg(F.count("*").alias("n_rows"), F.count(w).alias("with_weight"), F.count_if(w > 0).alias("positive"), F.count_if(~(w > 0)).alias("zero_or_less"))


@key("dq_count_bands", f""",
counts AS (SELECT 'corridor_ports' AS "check", (SELECT count(*) FROM port WHERE is_in_corridor) AS n
  UNION ALL SELECT 'commodity_chapters', (SELECT count(DISTINCT p_type) FROM part)
  UNION ALL SELECT 'calendar_days', (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem)
  UNION ALL SELECT 'modes', (SELECT count(*) FROM modes)
  UNION ALL SELECT 'lane_types', (SELECT count(*) FROM lanes)),
bands AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {lo}, {hi})" for n, lo, hi in catalogs.DIM_COUNT_BANDS)}) v("check", low, high))
SELECT "check", n, low, high, n BETWEEN low AND high AS ok FROM counts JOIN bands USING ("check")""")
def dq_count_bands(m):
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
    counts = (cnt(m.dim_port().where("is_in_corridor"), "corridor_ports")
              .unionByName(m.table("part").agg(F.countDistinct("p_type").alias("n")).select(F.lit("commodity_chapters").alias("check"), "n"))
              .unionByName(m.table("lineitem").agg(F.countDistinct(F.to_date("l_shipdate")).alias("n"))
                           .select(F.lit("calendar_days").alias("check"), "n"))
              .unionByName(cnt(m.dim_mode(), "modes")).unionByName(cnt(m.dim_lane(), "lane_types")))
    bands = m.spark.createDataFrame(catalogs.DIM_COUNT_BANDS, "check string, low int, high int")
    return quality.count_bands(counts, F.broadcast(bands))


@key("dq_source_overlap", f"""
SELECT count(*) AS overlapping_keys FROM (SELECT {_TPK} FROM t GROUP BY {_TPK} HAVING count(DISTINCT data_source) > 1)""")
def dq_source_overlap(m):
    from portflow.schemas import FACT_TRADE_PK
    return quality.source_overlap(m.trade(), FACT_TRADE_PK, "data_source")


@key("dq_v1_v2", """
SELECT data_source, count(*) AS n_rows, CAST(min(date_id) AS INTEGER) AS first_id, CAST(max(date_id) AS INTEGER) AS last_id
FROM t GROUP BY 1""")
def dq_v1_v2(m):
    return m.trade().groupBy("data_source").agg(F.count(F.lit(1)).alias("n_rows"), F.min("date_id").alias("first_id"),
                                                F.max("date_id").alias("last_id"))


_CELL_MODE, _CELL_DIRECTION, _CELL_MONTH = P.check_cell


@key("dq_v3_cell", f"""
SELECT CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd, count(*) AS n, CAST(NULL AS DOUBLE) AS expected, CAST(NULL AS BOOLEAN) AS as_expected FROM t
WHERE port_id = {P.focus_port} AND mode_id = {O.MODE_ID[_CELL_MODE]} AND direction = '{_CELL_DIRECTION}' AND date_id = {_CELL_MONTH}
  AND data_source = 'national'""")
def dq_v3_cell(m):
    """M10: one cell of the fact against its known value (``Params.check_cell_value``; NULL where none is known)."""
    c, (mode, direction, month) = F.col, m.p.check_cell
    t = m.trade().where((c("port_id") == m.p.focus_port) & (c("mode_id") == catalogs.mode_ids()[mode])
                        & (c("direction") == direction) & (c("date_id") == month) & (c("data_source") == NAT))
    value = F.sum("value_usd").cast(DEC)
    expected = F.lit(m.p.check_cell_value).cast("double")
    return t.agg(value.alias("value_usd"), F.count(F.lit(1)).alias("n"), expected.alias("expected"), (value.cast("double") == expected).alias("as_expected"))


@key("dq_v4_v7", f"""
SELECT 'v4_corridor_ttm' AS "check", CAST(port_id AS VARCHAR) AS item, count(*) AS n, CAST(SUM(value_usd) AS DECIMAL(38,2)) AS value_usd
FROM t WHERE port_id IN ({O.in_list(P.corridor_ports)}) AND date_id BETWEEN {P.check_window[0]} AND {P.check_window[1]} GROUP BY port_id
UNION ALL SELECT 'v5_national_year', '{P.check_year}', count(*), CAST(SUM(value_usd) AS DECIMAL(38,2)) FROM t
  WHERE data_source = 'national' AND date_id {O.yrange(P.check_year)}
UNION ALL SELECT * FROM (SELECT 'v6_top_ports', CAST(port_id AS VARCHAR), count(*), CAST(SUM(value_usd) AS DECIMAL(38,2)) AS v FROM t JOIN port USING (port_id)
  WHERE NOT is_aggregate AND data_source = 'national' AND date_id {O.yrange(P.check_year)} GROUP BY port_id ORDER BY v DESC, port_id LIMIT {P.check_top})
UNION ALL SELECT 'v7_mirror_months', CAST(date_id AS VARCHAR), count(*), CAST(SUM(value_usd) AS DECIMAL(38,2)) FROM t
  WHERE port_id = {P.focus_port} AND data_source = 'mirror' GROUP BY date_id""")
def dq_v4_v7(m):
    """M11: the four checks from one scan: the fact is reduced to port, month and source, and written."""
    p, c = m.p, F.col
    t = staged(m.trade().groupBy("port_id", "date_id", "data_source").agg(F.count(F.lit(1)).alias("n"), F.sum("value_usd").alias("value_usd")), "port_months")

    def g(df, name, *item):
        return df.groupBy(*item).agg(F.sum("n").alias("n"), F.sum("value_usd").cast(DEC).alias("value_usd")) \
            .select(F.lit(name).alias("check"), *([c(item[0]).cast("string").alias("item")] if item else [F.lit(str(p.check_year)).alias("item")]), F.coalesce("n", F.lit(0)).alias("n"), "value_usd")
    lo, hi = dates.year_range(p.check_year)
    year = t.where((c("data_source") == NAT) & c("date_id").between(lo, hi))
    v4 = g(t.where(c("port_id").isin(*p.corridor_ports) & c("date_id").between(*p.check_window)), "v4_corridor_ttm", "port_id")
    v6 = g(year.join(m.port_flags.where(~c("is_aggregate")).select("port_id"), "port_id"), "v6_top_ports", "port_id") \
        .orderBy(F.desc("value_usd"), c("item").cast("long")).limit(p.check_top)
    v7 = g(t.where((c("port_id") == p.focus_port) & (c("data_source") == catalogs.SOURCE_MIRROR)), "v7_mirror_months", "date_id")
    return v4.unionByName(g(year, "v5_national_year")).unionByName(v6).unionByName(v7)


def _national_months_with_gap(m):
    """Months of the national feed as a feed with a missing year would give them: one row per month, one scan of the fact."""
    lo, hi = dates.year_range(m.p.gap_year)
    return marts.trade_monthly(m).where(F.col("has_nat").isNotNull() & ~F.col("date_id").between(lo, hi)).select("date_id")


@key("dq_month_gaps", f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS period, 'missing' AS status FROM
  (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2000-11-01', INTERVAL 1 MONTH)) AS DATE) AS d)
WHERE CAST(strftime(d, '%Y%m%d') AS INTEGER) NOT IN (SELECT date_id FROM t WHERE data_source = 'national' AND date_id NOT {O.yrange(P.gap_year)})
UNION ALL SELECT DISTINCT date_id, 'unexpected' FROM t WHERE data_source = 'national'
  AND date_id NOT {O.yrange(P.gap_year)} AND date_id NOT BETWEEN 19950101 AND 20001101""")
def dq_month_gaps(m):
    nat = _national_months_with_gap(m)
    spine = series.month_spine(m.spark.range(1).select(F.lit("1995-01-01").cast("date").alias("s"),
                                                       F.lit("2000-11-01").cast("date").alias("e")), "s", "e")
    spine = spine.select(dates.date_key("month_date").alias("period"))
    return quality.month_gaps(nat, "date_id", spine, "period")


@key("dq_coverage_pct", f"""
SELECT y.year, 12 AS expected, COALESCE(a.ok, 0) AS ok,
       CASE WHEN 12 = 0 THEN 0.0 ELSE round(CAST(COALESCE(a.ok, 0) AS DOUBLE) * 100 / 12, 1) END AS coverage_pct
FROM (SELECT CAST(unnest(generate_series(min(date_id // 10000), max(date_id // 10000))) AS INTEGER) AS year FROM t) y
LEFT JOIN (SELECT CAST(date_id // 10000 AS INTEGER) AS year, count(DISTINCT date_id) AS ok FROM t WHERE data_source = 'national' AND date_id NOT {O.yrange(P.gap_year)} GROUP BY 1) a
USING (year)""")
def dq_coverage_pct(m):
    t = marts.trade_monthly(m)
    years = t.agg(F.min(_yr()).alias("a"), F.max(_yr()).alias("b")).select(F.explode(F.sequence(F.col("a").cast("int"), F.col("b").cast("int"))).alias("year"))
    expected = years.withColumn("expected", F.lit(12))
    actual = _national_months_with_gap(m).groupBy(_yr().cast("int").alias("year")).agg(F.countDistinct("date_id").alias("ok"))
    return quality.coverage_pct(expected, actual, "year", "expected", "ok")


# ===========================================================================
# N profiling
# ===========================================================================

_PROFILE_COLS = ["port_id", "date_id", "direction", "container", "production_location", "value_usd", "weight_kg", "data_source"]
_TYPES = {"port_id": "bigint", "date_id": "int", "direction": "string", "container": "string",
          "production_location": "string", "value_usd": "decimal(18,2)", "weight_kg": "bigint", "data_source": "string"}


@key("profile_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_TYPES[c]}' AS type, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) END, 2) AS null_pct, "
    f"min(CAST({c} AS VARCHAR)) AS example FROM t" for c in _PROFILE_COLS))
def profile_columns(m):
    return profile.profile_columns(m.trade().select(*_PROFILE_COLS))


@key("profile_distinct", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM t" for c in _PROFILE_COLS))
def profile_distinct(m):
    return profile.profile_distinct(m.trade(), _PROFILE_COLS)


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TEXT_COLS = ["text", "source", "lang"]


def _describe_sql(table: str, cols: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({v}) AS count, round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std, "
        f"CAST(min({v}) AS DOUBLE) AS min, round(quantile_cont(CAST({v} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({v} AS DOUBLE), 0.5), 6) AS p50, "
        f"round(quantile_cont(CAST({v} AS DOUBLE), 0.75), 6) AS p75, CAST(max({v}) AS DOUBLE) AS max FROM {table}" for c, v in cols.items())


@key("profile_lengths", _describe_sql("documents", {c: f"length({c})" for c in _TEXT_COLS}))
def profile_lengths(m):
    """N4 for text: how long the texts of each column are."""
    return _described(profile.describe(m.table("documents"), _TEXT_COLS))


@key("profile_describe", _describe_sql("lineitem", {c: c for c in _DESC_COLS}))
def profile_describe(m):
    return _described(profile.describe(m.table("lineitem"), _DESC_COLS))


def _described(d):
    return d.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


_KEYWORDS = ["port", "date", "source"]


@key("profile_by_name", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM t" for c in ("port_id", "date_id", "data_source")))
def profile_by_name(m):
    t = m.trade()
    return profile.profile_distinct(t, profile.columns_by_keyword(t, _KEYWORDS))


# ===========================================================================
# O link discovery and manifest reconciliation
# ===========================================================================

_LINKS_SQL = """,
pl AS (SELECT page_id, CASE WHEN starts_with(l, '/') AND NOT starts_with(l, '//')
                            THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || l ELSE l END AS link
       FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS l FROM pages))"""


@key("extract_links", _LINKS_SQL + "\nSELECT link, count(*) AS n_refs FROM pl GROUP BY 1")
def extract_links(m):
    return links.link_counts(links.extract_links(m.table("pages")))


_MANIFEST_PRIORITY = ["not_archived", "corrupt", "failed"]


def _manifest(m):
    """Links as a download manifest: the citing page decides the category
    (page_id mod 3) and the year (2000 + page_id mod 12)."""
    pg = m.table("pages")
    host = F.regexp_extract(F.col("url"), r"^(https?://[^/?#]+)", 1)
    x = pg.select("page_id", host.alias("_host"), F.explode(F.regexp_extract_all("html", F.lit(links.HREF), 1)).alias("_l"))
    link = F.when(F.col("_l").startswith("/") & ~F.col("_l").startswith("//"), F.concat("_host", "_l")).otherwise(F.col("_l"))
    cat = codes.map_values(F.pmod("page_id", F.lit(3)), {0: "not_archived", 1: "corrupt", 2: "failed"})
    return x.select(link.alias("url"), cat.alias("category"), (F.pmod("page_id", F.lit(12)) + 2000).cast("int").alias("year"))


@key("manifest_retry", _LINKS_SQL + """,
mf AS (SELECT link AS url, CASE page_id % 3 WHEN 0 THEN 'not_archived' WHEN 1 THEN 'corrupt' ELSE 'failed' END AS category,
              CAST(page_id % 12 + 2000 AS INTEGER) AS year, page_id % 3 AS prio FROM pl),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY prio, year) AS rn FROM mf)
SELECT url, category, year FROM r WHERE rn = 1 AND year >= 2006 ORDER BY year, url""")
def manifest_retry(m):
    return links.reconcile_manifest(_manifest(m), _MANIFEST_PRIORITY, 2006)


@key("outcome_stats", """
SELECT CASE WHEN contains(html, '</html>') THEN 'ok' ELSE 'corrupt' END AS status,
       CASE page_id % 3 WHEN 0 THEN 'not_archived' WHEN 1 THEN 'corrupt' ELSE 'failed' END AS category, count(*) AS n
FROM pages GROUP BY 1, 2""")
def outcome_stats(m):
    pg = m.table("pages")
    x = pg.select(F.when(F.col("html").contains("</html>"), "ok").otherwise("corrupt").alias("status"),
                  codes.map_values(F.pmod("page_id", F.lit(3)), {0: "not_archived", 1: "corrupt", 2: "failed"}).alias("category"))
    return links.outcome_stats(x)
