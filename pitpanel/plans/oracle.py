"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Each oracle query is ``WITH <adapter + operator CTEs> SELECT ...`` over the
raw tables, written from the operator definitions -- it shares no code with
the Spark side.  CTE fragments are composed by name so the modeling-panel
chain is written once.
"""

from __future__ import annotations

# ---------------------------------------------------------------- adapters
ANNUAL = """annual AS (
  SELECT r_name AS state, n_name AS county, lpad(cast(n_nationkey AS varchar), 5, '0') AS county_fips,
         c_mktsegment AS crop, cast(year(o_orderdate) AS int) AS year,
         cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) / count(*) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name, n_name, n_nationkey, c_mktsegment, year(o_orderdate))"""

DAILY = """daily AS (
  SELECT lpad(cast(s_nationkey AS varchar), 5, '0') AS county_fips,
         cast(year(cast(l_shipdate AS date)) AS int) AS year, cast(l_shipdate AS date) AS date,
         sum(l_quantity) / 10.0 AS PRECTOTCORR, sum(l_quantity) / count(l_quantity) AS T2M,
         max(l_quantity) AS T2M_MAX
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY s_nationkey, cast(l_shipdate AS date))"""

WEEKLY = """weekly AS (
  SELECT lpad(cast(c_nationkey AS varchar), 5, '0') AS county_fips,
         cast(date_trunc('week', o_orderdate) AS date) AS date,
         100.0 * cast(count_if(o_orderpriority = '5-LOW') AS double) / cast(count(*) AS double) AS D0,
         100.0 * cast(count_if(o_orderpriority = '4-NOT SPECIFIED') AS double) / cast(count(*) AS double) AS D1,
         100.0 * cast(count_if(o_orderpriority = '3-MEDIUM') AS double) / cast(count(*) AS double) AS D2,
         100.0 * cast(count_if(o_orderpriority = '2-HIGH') AS double) / cast(count(*) AS double) AS D3,
         100.0 * cast(count_if(o_orderpriority = '1-URGENT') AS double) / cast(count(*) AS double) AS D4
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_nationkey, cast(date_trunc('week', o_orderdate) AS date))"""

DIRTY = """dirty AS (
  SELECT cast(year AS varchar) AS year, state AS state_name, county AS county_name, crop AS commodity_desc,
         'USD / ORDER' AS unit_desc,
         CASE WHEN (cast(county_fips AS int) + year) % 17 = 0 THEN '(D)'
              ELSE format('{:,}', cast(floor(value) AS bigint)) END AS "Value",
         cast(cast(cast(county_fips AS int) // 1000 AS double) AS varchar) AS state_fips_code,
         cast(cast(cast(county_fips AS int) % 1000 AS double) AS varchar) AS county_ansi,
         cast(cast(cast(county_fips AS int) AS double) AS varchar) AS county_fips
  FROM annual)"""

# ---------------------------------------------------------------- targets
TARGETS = """targets0 AS (
  SELECT state, county, county_fips, crop, year, value AS actual_yield,
         CASE WHEN count(value) OVER w5 >= 3 THEN avg(value) OVER w5 END AS expected_yield
  FROM annual
  WINDOW w5 AS (PARTITION BY state, county_fips, crop ORDER BY year ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT *, actual_yield - expected_yield AS yield_anomaly,
         CASE WHEN expected_yield IS NOT NULL AND expected_yield <> 0
              THEN ((actual_yield - expected_yield) / expected_yield) * 100.0 END AS yield_anomaly_pct
  FROM targets0)"""

LAGS = """lagt AS (
  SELECT county_fips, crop, year,
    lag(yield_anomaly) OVER wl AS prior_year_yield_anomaly,
    lag(actual_yield) OVER wl AS prior_year_yield,
    CASE WHEN count(yield_anomaly) OVER w3 >= 1 THEN avg(yield_anomaly) OVER w3 END AS rolling_3yr_mean_yield_anomaly,
    CASE WHEN count(yield_anomaly) OVER w3 >= 2 THEN stddev_samp(yield_anomaly) OVER w3 END AS rolling_3yr_std_yield_anomaly,
    CASE WHEN count(actual_yield) OVER w3 >= 1 THEN avg(actual_yield) OVER w3 END AS rolling_3yr_mean_yield,
    CASE WHEN count(actual_yield) OVER w3 >= 2 THEN stddev_samp(actual_yield) OVER w3 END AS rolling_3yr_std_yield
  FROM targets
  WINDOW wl AS (PARTITION BY county_fips, crop ORDER BY year, state, actual_yield),
         w3 AS (PARTITION BY county_fips, crop ORDER BY year, state, actual_yield ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""

# ---------------------------------------------------------------- weather
RUNS = """season AS (SELECT * FROM daily WHERE month(date) BETWEEN 4 AND 8),
runs1 AS (
  SELECT *, count(PRECTOTCORR) OVER wr AS nn, row_number() OVER wr AS rn FROM season
  WINDOW wr AS (PARTITION BY county_fips, year ORDER BY date, PRECTOTCORR ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
runs AS (
  SELECT *,
    CASE WHEN PRECTOTCORR <= 1.0 THEN nn - coalesce(max(CASE WHEN PRECTOTCORR > 1.0 THEN nn END) OVER wr, 0) END AS run_bridge,
    CASE WHEN PRECTOTCORR <= 1.0 THEN rn - coalesce(max(CASE WHEN PRECTOTCORR IS NULL OR NOT (PRECTOTCORR <= 1.0) THEN rn END) OVER wr, 0) END AS run_break
  FROM runs1
  WINDOW wr AS (PARTITION BY county_fips, year ORDER BY date, PRECTOTCORR ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

CK = """ck(checkpoint, end_key, end_mm, end_dd) AS (VALUES
  ('may_31', 531, 5, 31), ('june_30', 630, 6, 30), ('july_31', 731, 7, 31),
  ('august_31', 831, 8, 31), ('full_season', 831, 8, 31))"""

CKW = """ckw0 AS (
  SELECT r.county_fips, r.year, ck.checkpoint,
    coalesce(sum(PRECTOTCORR), 0.0) AS cumulative_precip,
    avg(T2M) AS mean_temp,
    max(T2M_MAX) AS max_temp,
    count_if(T2M_MAX >= 35.0) AS extreme_heat_days,
    count_if(PRECTOTCORR <= 1.0) AS dry_days,
    cast(coalesce(max(run_bridge), 0) AS bigint) AS longest_dry_spell,
    coalesce(sum(CASE WHEN T2M - 10.0 > 0.0 THEN T2M - 10.0 ELSE 0.0 END), 0.0) AS growing_degree_days,
    count(*) AS obs_days,
    cast(coalesce(max(run_break), 0) AS bigint) AS max_consecutive_dry_days,
    CASE WHEN ck.checkpoint IN ('july_31', 'august_31', 'full_season')
         THEN cast(count_if(month(date) >= 7 AND T2M_MAX >= 35.0) AS double) END AS extreme_heat_days_after_july_1,
    coalesce(sum(CASE WHEN make_date(year(date), ck.end_mm, ck.end_dd) - date <= 29 THEN PRECTOTCORR END), 0.0)
      AS precip_last_30_days_before_checkpoint,
    cast(count_if(make_date(year(date), ck.end_mm, ck.end_dd) - date <= 29 AND T2M_MAX >= 35.0) AS double)
      AS heat_days_last_30_days_before_checkpoint,
    coalesce(sum(CASE WHEN make_date(year(date), ck.end_mm, ck.end_dd) - date <= 29
                      THEN (CASE WHEN T2M - 10.0 > 0.0 THEN T2M - 10.0 ELSE 0.0 END) END), 0.0)
      AS gdd_last_30_days_before_checkpoint
  FROM runs r JOIN ck ON month(r.date) * 100 + day(r.date) <= ck.end_key
  GROUP BY r.county_fips, r.year, ck.checkpoint),
ckw AS (
  SELECT *, obs_days < 153 AS is_partial_year,
    cumulative_precip - CASE WHEN count(cumulative_precip) OVER wp >= 1 THEN avg(cumulative_precip) OVER wp END AS precip_anomaly,
    cumulative_precip - CASE WHEN count(cumulative_precip) OVER wp >= 1 THEN avg(cumulative_precip) OVER wp END AS precip_anomaly_from_county_checkpoint_mean,
    growing_degree_days - CASE WHEN count(growing_degree_days) OVER wp >= 1 THEN avg(growing_degree_days) OVER wp END AS gdd_anomaly_from_county_checkpoint_mean,
    extreme_heat_days - CASE WHEN count(extreme_heat_days) OVER wp >= 1 THEN avg(extreme_heat_days) OVER wp END AS heat_days_anomaly_from_county_checkpoint_mean,
    dry_days - CASE WHEN count(dry_days) OVER wp >= 1 THEN avg(dry_days) OVER wp END AS dry_days_anomaly_from_county_checkpoint_mean,
    mean_temp - CASE WHEN count(mean_temp) OVER wp >= 1 THEN avg(mean_temp) OVER wp END AS temp_mean_anomaly_from_county_checkpoint_mean,
    CASE WHEN avg(cumulative_precip) OVER wp IS NOT NULL AND avg(cumulative_precip) OVER wp <> 0
         THEN cumulative_precip / avg(cumulative_precip) OVER wp END AS precip_pct_of_county_checkpoint_mean
  FROM ckw0
  WINDOW wp AS (PARTITION BY county_fips, checkpoint ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

# ---------------------------------------------------------------- drought
DROUGHT = """wk AS (
  SELECT *, CASE WHEN D4 > 0 THEN 4 WHEN D3 > 0 THEN 3 WHEN D2 > 0 THEN 2 WHEN D1 > 0 THEN 1 ELSE 0 END AS dom
  FROM weekly WHERE month(date) BETWEEN 4 AND 8),
drought AS (
  SELECT county_fips, cast(year(date) AS int) AS year,
    count_if(D0 > 0) AS weeks_d0, count_if(D1 > 0) AS weeks_d1, count_if(D2 > 0) AS weeks_d2,
    count_if(D3 > 0) AS weeks_d3, count_if(D4 > 0) AS weeks_d4, count_if(D2 + D3 + D4 > 0) AS weeks_d2_plus,
    max(dom) AS max_drought_category, avg(dom) AS mean_drought_severity,
    max(D0) AS d0_max_pct, max(D1) AS d1_max_pct, max(D2) AS d2_max_pct, max(D3) AS d3_max_pct,
    max(D4) AS d4_max_pct, max(D2 + D3 + D4) AS d2_plus_max_pct
  FROM wk GROUP BY county_fips, year(date))"""

# ---------------------------------------------------------------- panel
PANEL = """panel_all AS (
  SELECT t.*, l.prior_year_yield_anomaly, l.prior_year_yield, l.rolling_3yr_mean_yield_anomaly,
    l.rolling_3yr_std_yield_anomaly, l.rolling_3yr_mean_yield, l.rolling_3yr_std_yield,
    w.checkpoint, w.cumulative_precip, w.mean_temp, w.max_temp, w.extreme_heat_days, w.dry_days,
    w.longest_dry_spell, w.growing_degree_days, w.obs_days, w.max_consecutive_dry_days,
    w.extreme_heat_days_after_july_1, w.precip_last_30_days_before_checkpoint,
    w.heat_days_last_30_days_before_checkpoint, w.gdd_last_30_days_before_checkpoint,
    w.is_partial_year, w.precip_anomaly, w.precip_anomaly_from_county_checkpoint_mean,
    w.gdd_anomaly_from_county_checkpoint_mean, w.heat_days_anomaly_from_county_checkpoint_mean,
    w.dry_days_anomaly_from_county_checkpoint_mean, w.temp_mean_anomaly_from_county_checkpoint_mean,
    w.precip_pct_of_county_checkpoint_mean,
    d.weeks_d0, d.weeks_d1, d.weeks_d2, d.weeks_d3, d.weeks_d4, d.weeks_d2_plus,
    d.max_drought_category, d.mean_drought_severity,
    t.year - 2015 AS year_index,
    w.extreme_heat_days * w.dry_days AS heat_dry_stress,
    w.extreme_heat_days * w.longest_dry_spell AS heat_dry_spell
  FROM targets t
  LEFT JOIN lagt l ON t.county_fips = l.county_fips AND t.crop = l.crop AND t.year = l.year
  LEFT JOIN ckw w ON t.county_fips = w.county_fips AND t.year = w.year
  LEFT JOIN drought d ON t.county_fips = d.county_fips AND t.year = d.year),
panel AS (SELECT * FROM panel_all WHERE yield_anomaly IS NOT NULL)"""

def bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; write it as ``count(CASE ...)``
    (BIGINT, like Spark's count)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"count(CASE WHEN {bigint_counts(sql[j + len(key):k - 1])} THEN 1 END)")
        i = k


# ---------------------------------------------------------------- split + labels
LAB = """mp AS (SELECT * FROM panel WHERE checkpoint IS NOT NULL),
cut2 AS (SELECT min(year) AS cutoff FROM (SELECT DISTINCT year FROM mp ORDER BY year DESC LIMIT 2)),
thr2 AS (SELECT state, county_fips, crop, quantile_cont(yield_anomaly_pct, 0.2) AS risk_threshold
         FROM mp, cut2 WHERE mp.year < cut2.cutoff GROUP BY state, county_fips, crop),
lab AS (SELECT mp.*, CASE WHEN mp.year < cut2.cutoff THEN 'train' ELSE 'test' END AS split,
          CASE WHEN mp.yield_anomaly_pct IS NOT NULL AND thr2.risk_threshold IS NOT NULL
               THEN cast(mp.yield_anomaly_pct <= thr2.risk_threshold AS int) END AS severe_risk
        FROM mp CROSS JOIN cut2
        LEFT JOIN thr2 ON mp.state = thr2.state AND mp.county_fips = thr2.county_fips AND mp.crop = thr2.crop),
train AS (SELECT * FROM lab WHERE split = 'train'),
test AS (SELECT * FROM lab WHERE split = 'test')"""

REG_PREDS = """gm AS (SELECT CASE WHEN avg(yield_anomaly) IS NULL OR avg(yield_anomaly) = 0 THEN 0.0
                      ELSE avg(yield_anomaly) END AS g FROM train),
cm AS (SELECT county_fips, crop, avg(yield_anomaly) AS v FROM train
       WHERE county_fips IS NOT NULL AND crop IS NOT NULL GROUP BY county_fips, crop),
crm AS (SELECT crop, avg(yield_anomaly) AS v FROM train WHERE crop IS NOT NULL GROUP BY crop),
ccm AS (SELECT crop, checkpoint, avg(yield_anomaly) AS v FROM train
        WHERE crop IS NOT NULL AND checkpoint IS NOT NULL GROUP BY crop, checkpoint),
hist AS (SELECT year, NULL AS state, county_fips, crop, NULL AS checkpoint, yield_anomaly, false AS is_test
         FROM train WHERE yield_anomaly IS NOT NULL
         UNION ALL SELECT year, state, county_fips, crop, checkpoint, yield_anomaly, true FROM test),
prev AS (SELECT *, CASE WHEN count(*) OVER w = 0 THEN 0.0 ELSE arg_max(yield_anomaly, year) OVER w END AS y_pred
         FROM hist WINDOW w AS (PARTITION BY county_fips, crop ORDER BY year
                                RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
reg_preds AS (
  SELECT year, state, county_fips, crop, checkpoint, 'zero_anomaly' AS model, 'regression' AS task,
         yield_anomaly AS y_true, cast(0.0 AS double) AS y_pred FROM test
  UNION ALL
  SELECT year, state, county_fips, crop, checkpoint, 'previous_year_anomaly', 'regression', yield_anomaly,
         cast(y_pred AS double) FROM prev WHERE is_test
  UNION ALL
  SELECT t.year, t.state, t.county_fips, t.crop, t.checkpoint, 'county_historical_mean', 'regression',
         t.yield_anomaly, cast(CASE WHEN cm.county_fips IS NOT NULL THEN cm.v WHEN crm.crop IS NOT NULL THEN crm.v
                                    ELSE gm.g END AS double)
  FROM test t LEFT JOIN cm ON t.county_fips = cm.county_fips AND t.crop = cm.crop
       LEFT JOIN crm ON t.crop = crm.crop CROSS JOIN gm
  UNION ALL
  SELECT t.year, t.state, t.county_fips, t.crop, t.checkpoint, 'crop_checkpoint_mean', 'regression',
         t.yield_anomaly, cast(CASE WHEN ccm.crop IS NOT NULL THEN ccm.v WHEN crm.crop IS NOT NULL THEN crm.v
                                    ELSE gm.g END AS double)
  FROM test t LEFT JOIN ccm ON t.crop = ccm.crop AND t.checkpoint = ccm.checkpoint
       LEFT JOIN crm ON t.crop = crm.crop CROSS JOIN gm)"""

CLS_PREDS = """maj AS (SELECT coalesce((SELECT severe_risk FROM train WHERE severe_risk IS NOT NULL GROUP BY severe_risk
                                 ORDER BY count(*) DESC, severe_risk ASC LIMIT 1), 0) AS m),
valid AS (SELECT * FROM train WHERE severe_risk IS NOT NULL),
gr AS (SELECT coalesce(avg(severe_risk), 0.0) AS g FROM valid),
cr AS (SELECT county_fips, crop, avg(severe_risk) AS v FROM valid
       WHERE county_fips IS NOT NULL AND crop IS NOT NULL GROUP BY county_fips, crop),
crr AS (SELECT crop, avg(severe_risk) AS v FROM valid WHERE crop IS NOT NULL GROUP BY crop),
tc AS (SELECT * FROM test WHERE severe_risk IS NOT NULL),
rates AS (SELECT tc.*, CASE WHEN cr.county_fips IS NOT NULL THEN cr.v WHEN crr.crop IS NOT NULL THEN crr.v
                            ELSE gr.g END AS rate
          FROM tc LEFT JOIN cr ON tc.county_fips = cr.county_fips AND tc.crop = cr.crop
               LEFT JOIN crr ON tc.crop = crr.crop CROSS JOIN gr),
cls_preds AS (
  SELECT year, state, county_fips, crop, checkpoint, 'majority_class' AS model, 'classification' AS task,
         severe_risk AS y_true, cast(maj.m AS int) AS y_pred FROM tc CROSS JOIN maj
  UNION ALL
  SELECT year, state, county_fips, crop, checkpoint, 'historical_county_risk', 'classification', severe_risk,
         coalesce(cast(rate >= 0.5 AS int), 0) FROM rates)"""

FRAGMENTS = {
    "annual": ANNUAL, "daily": DAILY, "weekly": WEEKLY, "dirty": DIRTY, "targets": TARGETS,
    "lagt": LAGS, "runs": RUNS, "ck": CK, "ckw": CKW, "drought": DROUGHT, "panel": PANEL,
    "lab": LAB, "reg_preds": REG_PREDS, "cls_preds": CLS_PREDS,
}
DEPENDS = {
    "dirty": ["annual"], "targets": ["annual"], "lagt": ["targets"], "runs": ["daily"],
    "ckw": ["runs", "ck"], "drought": ["weekly"], "panel": ["targets", "lagt", "ckw", "drought"],
    "lab": ["panel"], "reg_preds": ["lab"], "cls_preds": ["lab"],
}


def with_ctes(names: list[str], body: str, extra: str | None = None) -> str:
    """``WITH`` clause holding ``names`` and their dependencies in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [FRAGMENTS[n] for n in order]
    if extra:
        parts.append(extra)
    return bigint_counts("WITH " + ",\n".join(parts) + "\n" + body)


SIG_DIGITS = 8


def sig_round_sql(c: str, sig: int = SIG_DIGITS) -> str:
    """Same significant-digit rounding as the Spark side."""
    d = (f"least(greatest({sig - 1} - floor(log10(greatest(abs({c}), CAST(1e-300 AS DOUBLE)))), -12), 22)")
    scale = f"pow(CAST(10.0 AS DOUBLE), abs({d}))"
    half = "CAST(0.5 AS DOUBLE)"
    return (f"(CASE WHEN isnan({c}) OR abs({c}) = 0 OR abs({c}) >= CAST(1e13 AS DOUBLE) THEN {c} "
            f"WHEN {d} >= 0 THEN floor({c} * {scale} + {half}) / {scale} "
            f"ELSE floor({c} / {scale} + {half}) * {scale} END + CAST(0.0 AS DOUBLE))")


def finish_sql(sql: str, doubles: list[str], digits: dict[str, int] | None = None) -> str:
    """Round double outputs the same way the Spark side does."""
    if not doubles:
        return sql
    digits = digits or {}
    repl = ", ".join(f'{sig_round_sql(chr(34) + c + chr(34), digits.get(c, SIG_DIGITS))} AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"
