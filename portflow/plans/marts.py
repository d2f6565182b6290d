"""The eighteen result marts as Spark plans.

Shape of every mart:

1. Reduce the fact to the *calendar grain* (month or day, optionally per
   port/lane) with conditional partial sums — a distributed, map-side
   combined aggregation, and the only step that touches fact rows.
2. Derive bounds (last month, last complete year, trailing windows) with
   window functions over that calendar-grain frame.  Its size is bounded by
   the calendar (hundreds of months, a few thousand days), never by the data,
   so an unpartitioned window there is cheap.
3. Finish with one fused conditional aggregate.

Window bounds reach fact rows only through equi-joins on the key of a
bounded frame (e.g. the N+1 days of a trailing window), so no non-equi or
cross join is planned.  Year filters are written as key ranges and reach the
Parquet scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portflow import catalogs
from portflow.functions import dates, metrics
from portflow.functions.dates import key_to_date, key_year, shift_month_key, year_range
from portflow.operators import aggregates as agg
from portflow.operators import series, windows
from portflow.operators.joins import bounded_broadcast, cross_scalars
from portflow.sources.testdata import Model

NAT = catalogs.SOURCE_NATIONAL
DEC = "decimal(38,2)"


def _all():
    """Unpartitioned window: used only on calendar-grain frames (bounded)."""
    return Window.partitionBy()


def _ym(col):
    """yyyymmdd key -> 'yyyy-MM'."""
    s = F.col(col).cast("string") if isinstance(col, str) else col.cast("string")
    return F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2))


def _ymd(col):
    s = F.col(col).cast("string") if isinstance(col, str) else col.cast("string")
    return F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2), F.lit("-"), F.substring(s, 7, 2))


def _one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates without a join (``joins.cross_scalars``)."""
    return cross_scalars(*frames)


# ---------------------------------------------------------------------------
# calendar-grain reductions
# ---------------------------------------------------------------------------

def trade_monthly(m: Model) -> DataFrame:
    """Monthly trade reduction, shared by the marts of one model (persisted:
    one row per month)."""
    return m.bounded_frame("trade_monthly", _trade_monthly)


def _trade_monthly(m: Model) -> DataFrame:
    """Trade value per month with the partial sums every mart needs.

    One scan of the fact.  Fact rows are first reduced to (month, source,
    port class) with a single DECIMAL sum — one BigDecimal add per row,
    map-side combined — and the conditional columns are folded from that
    small frame (months x 2 sources x 3 classes rows).
    """
    p = m.p
    t = m.trade().select("port_id", "date_id", "data_source", "value_usd")
    flags = m.port_flags.select("port_id", "is_in_corridor")
    if not m.port_is_small:
        # large dimension: shrink the fact to (port, month, source) first, so
        # the shuffle join sees one row per port-month instead of raw rows
        t = t.groupBy("port_id", "date_id", "data_source").agg(F.sum("value_usd").alias("value_usd"))
    t = t.join(flags, "port_id", "left")
    small = (t.groupBy("date_id", "data_source",
                       F.col("port_id").isin(*p.focus_ports).alias("is_focus"),
                       F.coalesce(F.col("is_in_corridor"), F.lit(False)).alias("is_corr"))
              .agg(F.sum("value_usd").alias("v")))
    nat = F.col("data_source") == NAT
    focus, corr, v = F.col("is_focus"), F.col("is_corr"), F.col("v")

    def s(pred):
        return F.sum(F.when(pred, v)).cast(DEC)

    return (small.groupBy("date_id").agg(
        F.sum(v).cast(DEC).alias("all_v"),
        s(nat).alias("nat_v"),
        s(focus).alias("focus_v"),
        s(focus & nat).alias("focus_nat_v"),
        s(corr).alias("corr_v"),
        s(corr & nat).alias("corr_nat_v"),
        F.max(F.when(nat, F.lit(1))).alias("has_nat"),
        F.max(F.when(focus, F.lit(1))).alias("has_focus"),
        F.min(F.when(focus, F.col("data_source"))).alias("focus_source")))


def crossing_monthly(m: Model) -> DataFrame:
    """Monthly crossing reduction, shared by the marts of one model."""
    return m.bounded_frame("crossing_monthly", _crossing_monthly)


def _crossing_monthly(m: Model) -> DataFrame:
    """Crossings per month: total rows present, corridor sum, focus trucks."""
    p = m.p
    truck = catalogs.mode_ids()[p.truck_mode]
    c = m.crossing()
    if not m.port_is_small:
        c = c.groupBy("port_id", "mode_id", "date_id").agg(F.sum("crossing_count").alias("crossing_count"))
    c = c.join(m.port_flags.select("port_id", "is_in_corridor"), "port_id", "left")
    corr = F.coalesce(F.col("is_in_corridor"), F.lit(False))
    focus_truck = F.col("port_id").isin(*p.focus_ports) & (F.col("mode_id") == truck)
    return (c.groupBy("date_id").agg(
        F.sum(F.when(corr, F.col("crossing_count"))).alias("corr_c"),
        F.sum(F.when(focus_truck, F.col("crossing_count"))).alias("focus_trucks"),
        F.max(F.when(focus_truck, F.lit(1))).alias("has_focus_trucks")))


def _with_year_flags(monthly: DataFrame, present=None) -> DataFrame:
    """Add year and last-complete-year (12 distinct months present)."""
    x = monthly.withColumn("year", key_year("date_id"))
    pres = F.lit(1) if present is None else present
    n = F.count(F.when(pres.isNotNull(), F.lit(1))).over(Window.partitionBy("year"))
    x = x.withColumn("_months", n)
    return x.withColumn("lcy", F.max(F.when(F.col("_months") == 12, F.col("year"))).over(_all()))


def _year_bounds(m: Model, national_only: bool = False) -> DataFrame:
    """(year, lcy) per year with data, from the persisted monthly frame: the
    last complete year costs no extra scan of the fact."""
    tm = trade_monthly(m).select("date_id", "has_nat")
    if national_only:
        tm = tm.where(F.col("has_nat").isNotNull())
    return _with_year_flags(tm).select("year", "lcy")


def _last_year(m: Model, national_only: bool = False) -> DataFrame:
    """(year): the last complete year as one row; NULL if there is none."""
    return _year_bounds(m, national_only).agg(F.max("lcy").cast("int").alias("year"))


# ---------------------------------------------------------------------------
# L1 meta
# ---------------------------------------------------------------------------

def mart_meta(m: Model) -> DataFrame:
    """Coverage (first/last period) per source, one row each."""
    t = (m.trade().select("date_id", "data_source")
         .rollup("data_source").agg(F.min("date_id").alias("start_id"), F.max("date_id").alias("end_id"))
         .where(F.col("data_source").isNull() | (F.col("data_source") == NAT))
         .select(F.when(F.col("data_source").isNull(), F.lit("trade_all"))
                  .otherwise(F.lit("trade_national")).alias("scope"), "start_id", "end_id"))
    c = m.crossing().agg(F.min("date_id").alias("start_id"), F.max("date_id").alias("end_id")) \
        .select(F.lit("crossing").alias("scope"), "start_id", "end_id")
    w = m.wait().agg(F.min("date_id").alias("start_id"), F.max("date_id").alias("end_id")) \
        .select(F.lit("wait").alias("scope"), "start_id", "end_id")
    u = t.unionByName(c).unionByName(w)
    daily = F.col("scope") == "wait"
    return u.select("scope", F.col("start_id").cast("int").alias("start_id"),
                    F.col("end_id").cast("int").alias("end_id"),
                    F.when(daily, _ymd("start_id")).otherwise(_ym("start_id")).alias("start_label"),
                    F.when(daily, _ymd("end_id")).otherwise(_ym("end_id")).alias("end_label"))


# ---------------------------------------------------------------------------
# L2 panorama KPIs
# ---------------------------------------------------------------------------

def _wait_window_avg(m: Model, combos: list[tuple[int, str]]) -> tuple[DataFrame, DataFrame]:
    """Trailing-window average per requested (port, lane); NULL when no data.

    The window end is the last day of the whole wait fact; the window's days
    (N + 1 of them) join the fact by key.  Returns (averages, one-row end)."""
    p = m.p
    lanes = catalogs.lane_ids()
    w = m.wait()
    # days with wait data: bounded by the calendar, persisted per model
    days = m.bounded_frame("wait_days", lambda mm: mm.wait().select("date_id").distinct())
    end = F.max("date_id").over(_all())
    start = dates.date_key(F.date_sub(key_to_date(end), p.wait_window_days))
    win = (days.withColumn("end_id", end).withColumn("start_id", start)
               .where(F.col("date_id").between(F.col("start_id"), F.col("end_id"))))
    req = m.spark.createDataFrame([(int(a), b, lanes[b], i) for i, (a, b) in enumerate(combos)],
                                  "port_id long, lane string, lane_type_id int, ord int")
    hit = (w.join(F.broadcast(req.select("port_id", "lane_type_id")), ["port_id", "lane_type_id"])
            .join(F.broadcast(win.select("date_id")), "date_id")
            .groupBy("port_id", "lane_type_id")
            .agg(F.sum(metrics.cents("waiting_avg_minutes")).alias("_c"), F.count(F.lit(1)).alias("_n")))
    end_row = win.agg(F.max("end_id").alias("end_id"))
    # ``hit`` has at most one row per requested combo: a proven bound
    out = (req.join(F.broadcast(hit), ["port_id", "lane_type_id"], "left")
              .select("ord", "port_id", "lane", metrics.mean_half_up("_c", "_n").alias("avg_min")))
    return out, end_row


def _attach_scalar(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to a few rows (no join): stack
    both and spread the scalar with a window over the (bounded) rows."""
    u = rows.withColumn("_row", F.lit(True)).unionByName(one_row, allowMissingColumns=True)
    for c in one_row.columns:
        u = u.withColumn(c, F.max(c).over(_all()))
    return u.where(F.col("_row")).drop("_row")


def mart_panorama_kpis(m: Model) -> DataFrame:
    p = m.p
    tm = trade_monthly(m).where(F.col("has_nat").isNotNull())
    end = F.max("date_id").over(_all())
    x = (tm.withColumn("end_id", end)
           .withColumn("s_id", shift_month_key(F.col("end_id"), -11))
           .withColumn("pe_id", shift_month_key(F.col("end_id"), -12))
           .withColumn("ps_id", shift_month_key(F.col("end_id"), -23)))
    d = F.col("date_id")
    in_ttm = d.between(F.col("s_id"), F.col("end_id"))
    lo, hi = year_range(p.base_year)
    k = x.agg(
        F.max("s_id").alias("s_id"), F.max("end_id").alias("end_id"),
        F.coalesce(F.sum(F.when(in_ttm, F.col("nat_v"))), F.lit(0)).cast(DEC).alias("ttm"),
        F.coalesce(F.sum(F.when(d.between(F.col("ps_id"), F.col("pe_id")), F.col("nat_v"))), F.lit(0)).cast(DEC).alias("prev"),
        F.coalesce(F.sum(F.when(d.between(lo, hi), F.col("nat_v"))), F.lit(0)).cast(DEC).alias("base"),
        F.coalesce(F.sum(F.when(in_ttm, F.col("corr_nat_v"))), F.lit(0)).cast(DEC).alias("corr"))
    kpi = k.select(
        _ym("s_id").alias("ttm_start"), _ym("end_id").alias("ttm_end"),
        F.col("ttm").alias("ttm_value_usd"),
        metrics.growth_pct("ttm", "prev").alias("delta_yoy_pct"),
        metrics.growth_pct("ttm", "base").alias("delta_vs_base_pct"),
        metrics.pct_of("corr", "ttm").alias("corridor_share_pct"))

    cm = _with_year_flags(crossing_monthly(m))
    cross = cm.agg(F.max("lcy").alias("crossings_year"),
                   F.coalesce(F.sum(F.when(F.col("year") == F.col("lcy"), F.col("corr_c"))), F.lit(0))
                    .cast("long").alias("crossings_corridor"))

    wa, wend = _wait_window_avg(m, [(p.focus_port, p.default_lane)])
    wait = _one_row(wa.agg(F.max("avg_min").alias("wait_focus_avg_min")),
                    wend.select(_ymd("end_id").alias("wait_window_end")))
    return _one_row(kpi, cross.select(F.col("crossings_year").cast("int").alias("crossings_year"),
                                      "crossings_corridor"), wait)


# ---------------------------------------------------------------------------
# L3 / L4 timelines
# ---------------------------------------------------------------------------

def mart_value_timeline(m: Model) -> DataFrame:
    """National value per month from the series start to the last national
    month; months without data stay NULL."""
    p = m.p
    nat = (m.trade().where(F.col("data_source") == NAT)
           .groupBy("date_id").agg(F.sum("value_usd").cast(DEC).alias("value_usd"))
           .withColumn("month_date", key_to_date("date_id")))
    return series.gapfill_months(nat, "month_date", ["value_usd"], p.series_start)


def mart_crossings_timeline(m: Model) -> DataFrame:
    p = m.p
    ports = m.port_flags.where((F.col("border") == p.crossing_border) & ~F.col("is_aggregate")).select("port_id")
    return (m.crossing().join(ports, "port_id")
             .groupBy("date_id").agg(F.sum("crossing_count").cast("long").alias("crossings"))
             .select(key_to_date("date_id").alias("month_date"), "crossings"))


# ---------------------------------------------------------------------------
# L5 top ports
# ---------------------------------------------------------------------------

def mart_top_ports(m: Model) -> DataFrame:
    """Top-k physical ports by national value in the last complete national year."""
    p = m.p
    # first phase: the year, from the persisted monthly frame; second phase: a scan of that year alone
    year = _last_year(m, national_only=True)
    nat = m.trade_in_year(year).where(F.col("data_source") == NAT)
    per_port = nat.groupBy("port_id").agg(F.sum("value_usd").cast(DEC).alias("v"))
    ports = m.port_flags.where(~F.col("is_aggregate"))
    ranked = (per_port.join(ports, "port_id")
              .select(year.scalar().cast("long").alias("year"), F.col("port_canonical_name").alias("port"), "state",
                      metrics.scaled("v", p.unit_scale, 2).alias("value_m")))
    return ranked.orderBy(F.desc("value_m"), F.asc("port")).limit(p.top_k)


# ---------------------------------------------------------------------------
# L6 focus KPIs
# ---------------------------------------------------------------------------

def mart_focus_kpis(m: Model) -> DataFrame:
    p = m.p
    tm = trade_monthly(m)
    x = _with_year_flags(tm)                                    # lcy over all rows (mixed)
    x = x.withColumn("nat_lcy", F.max(F.when(
        F.count(F.col("has_nat")).over(Window.partitionBy("year")) == 12, F.col("year"))).over(_all()))
    end = F.max("date_id").over(_all())
    x = (x.withColumn("end_id", end)
          .withColumn("s_id", shift_month_key(F.col("end_id"), -11))
          .withColumn("pe_id", shift_month_key(F.col("end_id"), -12))
          .withColumn("ps_id", shift_month_key(F.col("end_id"), -23)))
    d, y = F.col("date_id"), F.col("year")

    def z(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast(DEC)

    k = x.agg(
        F.max("s_id").alias("s_id"), F.max("end_id").alias("end_id"),
        z(F.when(d.between(F.col("s_id"), F.col("end_id")), F.col("focus_v"))).alias("ttm"),
        z(F.when(d.between(F.col("ps_id"), F.col("pe_id")), F.col("focus_v"))).alias("prev"),
        F.max("lcy").alias("corridor_year"),
        z(F.when(y == F.col("lcy"), F.col("focus_v"))).alias("focus_y"),
        z(F.when(y == F.col("lcy"), F.col("corr_v"))).alias("corr_y"),
        F.max("nat_lcy").alias("national_year"),
        z(F.when(y == F.col("nat_lcy"), F.col("focus_nat_v"))).alias("focus_nat_y"),
        z(F.when(y == F.col("nat_lcy"), F.col("nat_v"))).alias("nat_y"),
        z(F.when(y == p.current_year, F.col("focus_v"))).alias("val_cur"),
        z(F.when(y == p.base_year, F.col("focus_v"))).alias("val_base"))
    cm = _with_year_flags(crossing_monthly(m))
    c = cm.agg(F.max("lcy").alias("trucks_year"),
               F.coalesce(F.sum(F.when(F.col("year") == F.col("lcy"), F.col("focus_trucks"))), F.lit(0)).alias("trucks"),
               F.coalesce(F.sum(F.when(F.col("year") == p.current_year, F.col("focus_trucks"))), F.lit(0)).alias("trk_cur"),
               F.coalesce(F.sum(F.when(F.col("year") == p.base_year, F.col("focus_trucks"))), F.lit(0)).alias("trk_base"))
    j = _one_row(k, c)
    upt = metrics.safe_div("val_cur", "trk_cur")
    upt_base = metrics.safe_div("val_base", "trk_base")
    return j.select(
        _ym("s_id").alias("ttm_start"), _ym("end_id").alias("ttm_end"),
        F.col("ttm").alias("ttm_value_usd"),
        metrics.growth_pct("ttm", "prev").alias("delta_yoy_pct"),
        F.col("corridor_year").cast("int").alias("corridor_year"),
        metrics.pct_of("focus_y", "corr_y").alias("share_corridor_pct"),
        F.col("national_year").cast("int").alias("national_year"),
        metrics.pct_of("focus_nat_y", "nat_y").alias("share_national_pct"),
        F.col("trucks_year").cast("int").alias("trucks_year"),
        F.col("trucks").cast("long").alias("trucks"),
        F.round(upt, 0).alias("usd_per_truck"),
        F.round(F.when(metrics.truthy(upt_base), (upt / upt_base - 1) * 100), 2).alias("usd_per_truck_delta_pct"))


# ---------------------------------------------------------------------------
# L7 / L8 focus series
# ---------------------------------------------------------------------------

def mart_focus_monthly(m: Model) -> DataFrame:
    """Focus-port value per month (all sources), gap-filled, with the source
    label of the month (the smaller tag when a month has both)."""
    p = m.p
    f = (m.trade().where(F.col("port_id").isin(*p.focus_ports))
         .groupBy("date_id").agg(F.sum("value_usd").cast(DEC).alias("value_usd"),
                                 F.min("data_source").alias("data_source"))
         .withColumn("month_date", key_to_date("date_id")))
    return series.gapfill_months(f, "month_date", ["value_usd", "data_source"], p.series_start)


def mart_focus_yearly(m: Model) -> DataFrame:
    p = m.p
    x = _with_year_flags(trade_monthly(m))
    return (x.groupBy("year").agg(
                F.count("has_focus").alias("months_loaded"),
                F.sum("focus_v").cast(DEC).alias("v"),
                F.max("lcy").alias("last_complete_year"))
             .where(F.col("months_loaded") > 0)
             .select(F.col("year").cast("int").alias("year"), "months_loaded",
                     metrics.scaled("v", p.unit_scale, 3).alias("value_m"),
                     (F.col("months_loaded") == 12).alias("complete"),
                     F.col("last_complete_year").cast("int").alias("last_complete_year")))


# ---------------------------------------------------------------------------
# L9 sector mix
# ---------------------------------------------------------------------------

def _focus_year_sector(m: Model, sector_col: str = "sector_grouping") -> DataFrame:
    """Focus value per (year, sector) for years up to the last complete year,
    joined to the per-year completeness frame by key."""
    p = m.p
    years = _year_bounds(m).distinct()
    f = m.trade().where(F.col("port_id").isin(*p.focus_ports)).select("commodity_id", "date_id", "value_usd")
    fm = f.groupBy("commodity_id", "date_id").agg(F.sum("value_usd").alias("v"))
    com = bounded_broadcast(m.dim_commodity().select("commodity_id", F.col(sector_col).alias("sector")),
                            m.max_broadcast_rows, cache_key=m._key("part") + (sector_col,))
    return (fm.join(com, "commodity_id")
              .withColumn("year", key_year("date_id"))
              .groupBy("year", "sector").agg(F.sum("v").cast(DEC).alias("v"))
              .join(F.broadcast(years), "year"))


def mart_sector_mix(m: Model) -> DataFrame:
    """Focus port value by sector in the last complete (mixed) year, with share."""
    p = m.p
    year = _last_year(m)
    f = m.trade_in_year(year).where(F.col("port_id").isin(*p.focus_ports)).groupBy("commodity_id").agg(F.sum("value_usd").alias("v"))
    com = bounded_broadcast(m.dim_commodity().select("commodity_id", F.col("sector_grouping").alias("sector")),
                            m.max_broadcast_rows, cache_key=m._key("part") + ("sector_grouping",))
    cur = f.join(com, "commodity_id").groupBy("sector").agg(F.sum("v").cast(DEC).alias("v")).withColumn("year", year.scalar())
    cur = windows.share_of_total(cur, "v", "pct")
    return cur.select(F.col("year").cast("int").alias("year"), "sector",
                      metrics.scaled("v", p.unit_scale, 3).alias("value_m"), "pct")


def mart_sector_history(m: Model, sector_col: str = "sector_grouping") -> DataFrame:
    """Year x sector grid from the history start to the last complete year,
    zero-filled; share within the year (a zero year divides by 1)."""
    p = m.p
    h = (_focus_year_sector(m, sector_col)
         .where((F.col("year") >= p.history_start_year) & (F.col("year") <= F.col("lcy")))
         .select("year", "sector", "v"))
    g = series.grid_zero_fill(h, "year", "sector", "v")
    g = windows.share_of_total(g, "v", "pct", partition=["year"], zero_total_as_one=True)
    return g.select(F.col("year").cast("int").alias("year"), "sector",
                    metrics.scaled("v", p.unit_scale, 3).alias("value_m"), "pct")


# ---------------------------------------------------------------------------
# L10 density ratio, L11 asymmetry
# ---------------------------------------------------------------------------

def mart_density_ratio(m: Model) -> DataFrame:
    """Value growth (current year Jan..Nov annualised x12/11, national) vs
    truck growth (full years) for the focus port."""
    p = m.p
    d = F.col("date_id")
    blo, bhi = year_range(p.base_year)
    clo = p.current_year * 10000 + 101
    chi = p.current_year * 10000 + 1101
    v = trade_monthly(m).agg(
        F.coalesce(F.sum(F.when(d.between(blo, bhi), F.col("focus_nat_v"))), F.lit(0)).cast(DEC).alias("vb"),
        F.coalesce(F.sum(F.when(d.between(clo, chi), F.col("focus_nat_v"))), F.lit(0)).cast(DEC).alias("vc"))
    clo2, chi2 = year_range(p.current_year)
    t = crossing_monthly(m).agg(
        F.coalesce(F.sum(F.when(d.between(blo, bhi), F.col("focus_trucks"))), F.lit(0)).cast("long").alias("tb"),
        F.coalesce(F.sum(F.when(d.between(clo2, chi2), F.col("focus_trucks"))), F.lit(0)).cast("long").alias("tc"))
    j = _one_row(v, t).withColumn("va", F.col("vc").cast("double") * 12 / 11)
    vg = metrics.growth_pct("va", "vb", None)
    tg = metrics.growth_pct("tc", "tb", None)
    return j.select(
        metrics.scaled("vb", p.unit_scale, 2).alias("value_base_m"),
        metrics.scaled("va", p.unit_scale, 2).alias("value_cur_annualised_m"),
        F.round(vg, 2).alias("value_growth_pct"),
        F.col("tb").alias("trucks_base"), F.col("tc").alias("trucks_cur"),
        F.round(tg, 2).alias("trucks_growth_pct"),
        F.round(F.when(metrics.truthy(tg), vg / tg), 2).alias("ratio_value_to_volume"))


def mart_asymmetry(m: Model) -> DataFrame:
    """Corridor ports in the last complete (mixed) year: value, share of the
    corridor, and how many times the focus port's value each one is."""
    p = m.p
    year = _last_year(m)
    per_port = m.trade_in_year(year).groupBy("port_id").agg(F.sum("value_usd").alias("v"))
    corr = m.port_flags.where("is_in_corridor").select("port_id", "port_canonical_name")
    y = per_port.join(corr, "port_id").select("port_id", "port_canonical_name", F.col("v").cast(DEC).alias("v"), year.scalar().alias("year"))
    y = windows.share_of_total(y, "v", "pct_corridor")
    focus_v = F.max(F.when(F.col("port_id") == p.focus_port, F.col("v"))).over(_all())
    vv = F.col("v").cast("double")
    y = y.withColumn("ratio_focus_to_port", F.round(F.when(
        (F.col("port_id") != p.focus_port) & (vv != 0), F.coalesce(focus_v, F.lit(0)).cast("double") / vv), 1))
    return y.select(F.col("year").cast("int").alias("year"), F.col("port_canonical_name").alias("port"),
                    metrics.scaled("v", p.unit_scale, 3).alias("value_m"), "pct_corridor", "ratio_focus_to_port")


# ---------------------------------------------------------------------------
# L12 - L15 waits
# ---------------------------------------------------------------------------

def mart_wait_kpis(m: Model) -> DataFrame:
    p = m.p
    wa, wend = _wait_window_avg(m, list(p.wait_kpis))
    e = wend.select(_ymd("end_id").alias("window_end"))
    return _attach_scalar(wa, e).select("port_id", "lane", "avg_min", "window_end")


def _corridor_waits(m: Model) -> DataFrame:
    p = m.p
    lanes = m.dim_lane().select("lane_type_id", F.col("lane_canonical_name").alias("lane"))
    return (m.wait().where(F.col("port_id").isin(*p.corridor_ports))
             .join(F.broadcast(lanes), "lane_type_id")
             .withColumn("full_date", key_to_date("date_id")))


def mart_wait_heatmap(m: Model) -> DataFrame:
    """Average wait per ISO week x ISO weekday, all years pooled, per port x lane."""
    w = _corridor_waits(m)
    return (series.heatmap_long(w, ["port_id", "lane"], "full_date",
                                F.sum(metrics.cents("waiting_avg_minutes")).alias("_c"), "n_days")
            .select("port_id", "lane", F.col("iso_week").cast("int").alias("iso_week"),
                    F.col("iso_dow").cast("int").alias("iso_dow"),
                    metrics.mean_half_up("_c", "n_days").alias("avg_min"), "n_days"))


def heatmap_matrix(m: Model) -> DataFrame:
    cells = mart_wait_heatmap(m)
    return series.heatmap_matrix(cells, ["port_id", "lane"], "avg_min") \
        .withColumn("series_key", F.concat_ws("|", F.col("port_id").cast("string"), "lane"))


def combos_default(m: Model) -> DataFrame:
    p = m.p
    return series.combos_with_default(_corridor_waits(m), "port_id", "lane", p.focus_port, p.default_lane)


def mart_lane_savings(m: Model) -> DataFrame:
    """Fast vs standard lane at the focus port in one year: avg/p50/p95/max/n
    per lane and the saving % computed from the rounded statistics."""
    p = m.p
    lanes = catalogs.lane_ids()
    lo, hi = year_range(p.wait_year)
    w = (m.wait().where(F.col("date_id").between(lo, hi))
         .where(F.col("port_id") == p.focus_port)
         .where(F.col("lane_type_id").isin(lanes[p.standard_lane], lanes[p.fast_lane])))
    v = F.col("waiting_avg_minutes")
    per_lane = (w.groupBy("lane_type_id")
                 .agg(F.sum(metrics.cents(v)).alias("_c"), F.count(F.lit(1)).alias("n_days"),
                      F.max(v).cast("double").alias("max"))
                 .join(agg.percentile_exact(w, ["lane_type_id"], "waiting_avg_minutes", [0.5, 0.95],
                                            ["p50", "p95"]), "lane_type_id")
                 .withColumn("avg", metrics.mean_half_up("_c", "n_days").cast("double")))
    out = []
    for tag, lane in (("std", p.standard_lane), ("fast", p.fast_lane)):
        on = F.col("lane_type_id") == lanes[lane]
        out += [F.max(F.when(on, F.col(c))).alias(f"{tag}_{c}") for c in ("avg", "p50", "p95", "max")]
        out.append(F.coalesce(F.max(F.when(on, F.col("n_days"))), F.lit(0)).alias(f"{tag}_n_days"))
    s = per_lane.agg(*out)

    def sav(stat):
        a, b = F.col(f"fast_{stat}"), F.col(f"std_{stat}")
        return F.round(F.when(metrics.truthy(a) & metrics.truthy(b), (a - b) / b * 100), 2)

    cols = []
    for tag in ("std", "fast"):
        cols += [f"{tag}_avg", f"{tag}_p50", f"{tag}_p95", f"{tag}_max", f"{tag}_n_days"]
    return s.select(*cols, *[sav(st).alias(f"{st}_saving_pct") for st in ("avg", "p50", "p95", "max")])


def mart_wait_trend(m: Model) -> DataFrame:
    w = _corridor_waits(m)
    return (w.groupBy("port_id", "lane", F.date_format("full_date", "yyyy-MM").alias("year_month"))
             .agg(F.sum(metrics.cents("waiting_avg_minutes")).alias("_c"), F.count(F.lit(1)).alias("n_days"))
             .select("port_id", "lane", "year_month", metrics.mean_half_up("_c", "n_days").alias("avg_min"), "n_days"))


def series_map(m: Model) -> DataFrame:
    t = mart_wait_trend(m)
    return series.series_map(t, ["port_id", "lane"], "year_month", ["avg_min", "n_days"])


# ---------------------------------------------------------------------------
# L16 - L18 recovery
# ---------------------------------------------------------------------------

def mart_recovery_kpis(m: Model) -> DataFrame:
    """Growth current vs base year (value and trucks), worst shock-year month
    vs the base-year monthly average, and the recovery length in rows.

    All value scalars come from windows over one monthly frame (one scan of
    the fact); the recovery search is restricted to [shock, end] by a
    predicate, not by filtering rows away."""
    p = m.p
    tm = trade_monthly(m).where(F.col("has_focus").isNotNull()).select("date_id", "focus_v")
    y = key_year("date_id")
    lo, _ = year_range(p.shock_year)
    _, hi = year_range(p.recovery_end_year)
    fv = F.col("focus_v")

    def tot(pred):
        return F.sum(F.when(pred, fv)).over(_all())

    x = (tm.withColumn("vc", F.coalesce(tot(y == p.current_year), F.lit(0)).cast(DEC))
           .withColumn("vb", F.coalesce(tot(y == p.base_year), F.lit(0)).cast(DEC))
           .withColumn("min_shock", F.min(F.when(y == p.shock_year, fv)).over(_all()))
           .withColumn("base_avg", F.col("vb").cast("double") / 12)
           .withColumn("in_range", F.col("date_id").between(lo, hi)))
    # rows of the search range numbered 1..n in month order; others NULL
    rn = F.when(F.col("in_range"), F.row_number().over(Window.partitionBy("in_range").orderBy("date_id")))
    x = x.withColumn("_rn", rn)
    best = F.min(F.when(F.col("in_range"), F.struct(fv.alias("v"), F.col("_rn").alias("rn")))).over(_all())
    x = x.withColumn("_min_rn", best["rn"])
    rec = F.min(F.when((F.col("_rn") > F.col("_min_rn")) & (fv.cast("double") >= F.col("base_avg")), F.col("_rn")))
    v = x.agg(F.max("vc").alias("vc"), F.max("vb").alias("vb"), F.max("min_shock").alias("min_shock"),
              (rec - F.max("_min_rn")).alias("recovery_rows"))
    cy = key_year("date_id")
    t = crossing_monthly(m).agg(
        F.coalesce(F.sum(F.when(cy == p.current_year, F.col("focus_trucks"))), F.lit(0)).alias("tc"),
        F.coalesce(F.sum(F.when(cy == p.base_year, F.col("focus_trucks"))), F.lit(0)).alias("tb"))
    j = _one_row(v, t).withColumn("base_avg", F.col("vb").cast("double") / 12)
    vg = metrics.growth_pct("vc", "vb", None)
    tg = metrics.growth_pct("tc", "tb", None)
    return j.select(
        F.round(vg, 2).alias("value_growth_pct"),
        F.round(tg, 2).alias("trucks_growth_pct"),
        F.round(F.when(metrics.truthy(tg), vg / tg), 2).alias("ratio_density"),
        F.round(F.when(metrics.truthy("base_avg"),
                       (F.coalesce(F.col("min_shock"), F.lit(0)).cast("double") - F.col("base_avg")) / F.col("base_avg") * 100), 2)
         .alias("drop_pct"),
        F.when(metrics.truthy("base_avg"), F.col("recovery_rows")).cast("int").alias("recovery_months"))


def _focus_value_trucks(m: Model):
    p = m.p
    lo, _ = year_range(p.dual_start_year)
    _, hi = year_range(p.dual_end_year)
    v = (trade_monthly(m).where(F.col("has_focus").isNotNull() & F.col("date_id").between(lo, hi))
         .select("date_id", F.col("focus_v").alias("value_usd")))
    t = (crossing_monthly(m).where(F.col("has_focus_trucks").isNotNull() & F.col("date_id").between(lo, hi))
         .select("date_id", F.col("focus_trucks").cast("long").alias("trucks")))
    return v, t


def mart_dual_series(m: Model) -> DataFrame:
    v, t = _focus_value_trucks(m)
    return (v.join(t, "date_id", "full_outer")
             .select(key_to_date("date_id").alias("month_date"), "value_usd", "trucks"))


def mart_density_trend(m: Model) -> DataFrame:
    """USD per truck per month (months with both measures) and its linear
    trend over the row index: slope per year and R^2."""
    v, t = _focus_value_trucks(m)
    # t holds at most one row per month of the requested range: a proven bound
    j = (v.join(F.broadcast(t), "date_id")
          .select("date_id", F.round(metrics.safe_div("value_usd", "trucks"), 2).alias("usd_per_truck"))
          .where(F.col("usd_per_truck").isNotNull()))
    j = windows.series_index(j, "date_id", "idx")
    x, yv = F.col("idx").cast("double"), F.col("usd_per_truck")
    n = F.count(yv).over(_all())
    vx, vy = F.var_pop(x).over(_all()), F.var_pop(yv).over(_all())
    slope = F.when(n < 2, None).when(vx == 0, F.lit(0.0)).otherwise(F.regr_slope(yv, x).over(_all()))
    r2 = F.when(n < 2, None).when((vy == 0) | (vx == 0), F.lit(0.0)).otherwise(F.regr_r2(yv, x).over(_all()))
    return j.select(key_to_date("date_id").alias("month_date"), "idx", "usd_per_truck",
                    F.round(slope * 12, 2).alias("slope_per_year"), F.round(r2, 3).alias("r_squared"))
