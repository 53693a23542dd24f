"""Registered queries over inputs with defects: readers (S2-S4), unions (S10),
saved results (S12, S15), models saved and loaded (S13, S14), quality gates
(C8, C12, C13, J10, T8, M2) and feature groups of panels that lack columns
(M3, M4).  Each defect is put into the rows that the tables give, and the SQL
beside it says what must become of it.  ``catalog`` imports this module.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators import features as FS
from pitpanel.operators import metrics as M
from pitpanel.operators import ml as ML
from pitpanel.operators import panel as P
from pitpanel.operators import splits as SP
from pitpanel.plans import catalog as C
from pitpanel.plans import oracle as O
from pitpanel.schema import validate_merge_keys
from pitpanel.session import ensure_checkpoint_dir
from pitpanel.sources import adapters as A
from pitpanel.sources import records as R
from pitpanel.sources.sinks import read_if_exists, write_table


def _path(spark, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ readers
@C.register("s4_daily_csv", O.with_ctes(["daily"], """
SELECT county_fips, CASE WHEN day(date) = 5 THEN NULL ELSE year END AS year,
  CASE WHEN day(date) IN (13, 14) THEN NULL ELSE cast(date AS varchar) END AS date,
  CASE WHEN day(date) IN (7, 8) THEN NULL ELSE cast(PRECTOTCORR AS double) END AS PRECTOTCORR,
  cast(T2M AS double) AS T2M, cast(T2M_MAX AS double) AS T2M_MAX
FROM daily"""), ["PRECTOTCORR", "T2M", "T2M_MAX"])
def q_s4(spark, sf_dir):
    """Daily CSV with ids as floats, impossible and missing dates, years
    and measures that are no numbers; the rows stay, the values are NULL."""
    path, day = _path(spark, "s4"), F.dayofmonth("date")
    d = A.daily(spark, sf_dir)
    write_table(d.select(
        F.col("county_fips").cast("int").cast("double").cast("string").alias("county_fips"),
        F.when(day == 5, F.lit("unknown")).otherwise(F.col("year").cast("string")).alias("year"),
        F.when(day == 13, F.lit("2001-02-30")).when(day != 14, F.col("date").cast("string")).alias("date"),
        F.when(day == 7, F.lit("trace")).when(day != 8, F.col("PRECTOTCORR").cast("string")).alias("PRECTOTCORR"),
        F.col("T2M").cast("string").alias("T2M"), F.concat(F.lit(" "), F.col("T2M_MAX").cast("string")).alias("T2M_MAX"),
    ), path, fmt="csv")
    return R.read_daily(spark, path).withColumn("date", F.col("date").cast("string"))


@C.register("s3_weekly_csv", O.with_ctes(["weekly"], """
SELECT date, county_fips, cast(year(date) AS int) AS year,
  CASE WHEN month(date) = 2 THEN 0.0 ELSE D0 END AS D0, CASE WHEN month(date) = 3 THEN 0.0 ELSE D1 END AS D1,
  CASE WHEN month(date) = 4 THEN 100.0 ELSE D2 END AS D2, CASE WHEN month(date) = 5 THEN 0.0 ELSE D3 END AS D3,
  0.0::DOUBLE AS D4
FROM weekly WHERE day(date) <> 1"""), ["D0", "D1", "D2", "D3", "D4"])
def q_s3(spark, sf_dir):
    """S3 + C9: weekly CSV under its source names with unreadable dates (rows
    dropped), text, blank, too large and negative shares, and no D4 at all."""
    path, month = _path(spark, "s3"), F.month("date")
    w = A.weekly(spark, sf_dir)
    write_table(w.select(
        F.col("county_fips").cast("int").cast("string").alias("FIPS"),
        F.when(F.dayofmonth("date") == 1, F.lit("no date")).otherwise(F.date_format("date", "yyyyMMdd")).alias("MapDate"),
        F.when(month == 2, F.lit("n/a")).otherwise(F.col("D0").cast("string")).alias("D0"),
        F.when(month != 3, F.col("D1").cast("string")).alias("D1"),
        F.when(month == 4, F.lit("250")).otherwise(F.col("D2").cast("string")).alias("D2"),
        F.when(month == 5, F.lit("-3")).otherwise(F.col("D3").cast("string")).alias("D3"),
    ), path, fmt="csv")
    return R.read_weekly(spark, path)


_S2_MEASURES = ["cumulative_precip", "mean_temp", "max_temp", "extreme_heat_days", "dry_days", "obs_days"]


@C.register("s2_weather_csv", O.with_ctes(["ckw"], """
SELECT county_fips, checkpoint, CASE WHEN obs_days % 5 = 0 THEN NULL ELSE cast(year AS int) END AS year,
  CASE WHEN obs_days % 7 = 0 THEN NULL ELSE cast(cumulative_precip AS double) END AS cumulative_precip,
  cast(mean_temp AS double) AS mean_temp, cast(max_temp AS double) AS max_temp,
  cast(extreme_heat_days AS double) AS extreme_heat_days, cast(dry_days AS double) AS dry_days,
  cast(obs_days AS double) AS obs_days, is_partial_year
FROM ckw"""), _S2_MEASURES)
def q_s2(spark, sf_dir):
    """Weather-feature CSV with ids as floats, years and measures that are
    no numbers and flags in either case."""
    path = _path(spark, "s2")
    w = C.weather_df(spark, sf_dir)
    write_table(w.select(
        F.col("county_fips").cast("int").cast("double").cast("string").alias("county_fips"), "checkpoint",
        F.when(F.col("obs_days") % 5 == 0, F.lit("year?")).otherwise(F.col("year").cast("string")).alias("year"),
        F.when(F.col("obs_days") % 7 == 0, F.lit("--")).otherwise(F.col("cumulative_precip").cast("string"))
        .alias("cumulative_precip"), *_S2_MEASURES[1:], F.initcap(F.col("is_partial_year").cast("string")).alias("is_partial_year"),
    ), path, fmt="csv")
    return R.read_weather_features(spark, path)


@C.register("s10_union_frames", O.with_ctes(["annual"], """
SELECT year, crop, county_fips, CASE WHEN crop = 'BUILDING' THEN NULL ELSE state END AS state,
  CASE WHEN crop = 'MACHINERY' THEN county END AS county
FROM annual WHERE crop IN ('BUILDING', 'MACHINERY', 'FURNITURE')"""))
def q_s10(spark, sf_dir):
    """Frames of single crops, with other orders and sets of columns."""
    a = A.annual(spark, sf_dir)
    one = {c: a.where(F.col("crop") == c) for c in ("BUILDING", "MACHINERY", "FURNITURE")}
    return R.union_frames([one["BUILDING"].select("year", "crop", "county_fips"),
                           one["MACHINERY"].select("county", "state", "county_fips", "crop", "year"),
                           one["FURNITURE"].select("crop", "year", "state", "county_fips")])


# ------------------------------------------------------------------ saved results
@C.register("s12_saved_predictions", O.with_ctes(["reg_preds"], """
SELECT fmt, model, count(*) AS n, avg(y_pred) AS mean_pred
FROM reg_preds, (VALUES ('csv'), ('json'), ('parquet')) f(fmt) GROUP BY fmt, model
UNION ALL SELECT 'absent', NULL, 0, NULL"""), ["mean_pred"])
def q_s12(spark, sf_dir):
    """S12 + S15: predictions saved in each format and read back if they are
    there; a table that was never saved is reported as absent."""
    preds, out = C.reg_preds(spark, sf_dir).select(*C.PRED_COLS), []
    for fmt in ("csv", "json", "parquet"):
        path = _path(spark, f"s12-{fmt}")
        write_table(preds, path, fmt=fmt)
        saved = read_if_exists(spark, path, fmt)
        out.append(saved.groupBy("model").agg(F.count("*").alias("n"), F.avg(F.col("y_pred").cast("double")).alias("mean_pred"))
                   .withColumn("fmt", F.lit(fmt)))
    if read_if_exists(spark, _path(spark, "s15")) is None:
        out.append(spark.range(1).select(F.lit("absent").alias("fmt"), F.lit(0).cast("long").alias("n")))
    return R.union_frames(out).select("fmt", "model", "n", "mean_pred")


@C.register("s14_saved_model_scores", O.with_ctes(["lab"], """
SELECT year, state, county_fips, crop, checkpoint, cast(yield_anomaly AS double) AS y_true, true AS as_fitted,
  true AS missing_is_error
FROM lab WHERE split = 'test' AND yield_anomaly IS NOT NULL"""), ["y_true"])
def q_s14(spark, sf_dir):
    """S13 + S14: a ridge model saved, loaded and applied to the test panel;
    every stored score equals the fitted model's, a missing model is an error."""
    train, test = C.labelled_split(spark, sf_dir)
    train, test = (d.where("yield_anomaly is not null") for d in (train, test))
    model = ML.fit_model(train, "ridge", [*FS.BASE_NUMERIC, "mean_temp", "dry_days"], ["crop"], "yield_anomaly")
    path, stored = _path(spark, "s13"), _path(spark, "s14")
    ML.save_model(model, path)
    ML.score_panel(path, test, "ridge", "regression", "yield_anomaly", out_path=stored)
    key = ["year", "state", "county_fips", "crop", "checkpoint"]
    fitted = ML.predict(model, test, key, "yield_anomaly", "ridge", "regression")
    missing = _outcome(lambda: ML.load_model(_path(spark, "s13-none"))) == "FileNotFoundError"
    return spark.read.parquet(stored).join(fitted.select(*key, F.col("y_pred").alias("again")), key) \
        .select(*key, F.col("y_true").cast("double").alias("y_true"),
                (F.abs(F.col("y_pred") - F.col("again")) <= 1e-9 * (1 + F.abs("again"))).alias("as_fitted"),
                F.lit(missing).alias("missing_is_error"))


# ------------------------------------------------------------------ gates
def _with_bad_ids(spark, sf_dir) -> DataFrame:
    """``annual`` with aggregate rows (no id), ids of letters and of six digits."""
    a = A.annual(spark, sf_dir)
    return R.union_frames([
        a.withColumn("county_fips", F.col("county_fips").cast("int").cast("double").cast("string")),
        a.where("year % 2 = 0").withColumn("county_fips", F.lit(None).cast("string")),
        a.where("year % 3 = 0").withColumn("county_fips", F.concat(F.lit("A"), F.substring("county_fips", 2, 4))),
        a.where("year % 5 = 0").withColumn("county_fips", F.concat(F.lit("9"), "county_fips"))])


@C.register("c12_valid_entities", O.with_ctes(["annual"], """
SELECT county_fips, year, crop, (SELECT sum((year % 2 = 0)::INT + (year % 3 = 0)::INT + (year % 5 = 0)::INT)::BIGINT
                                 FROM annual) AS dropped_rows
FROM annual"""))
def q_c12(spark, sf_dir):
    """Rows of valid ids, with the number of rows dropped for theirs."""
    bad = _with_bad_ids(spark, sf_dir)
    return P.valid_entities(bad).select("county_fips", "year", "crop") \
        .join(F.broadcast(P.count_invalid_entities(bad)))  # one row


@C.register("c13_stray_columns", O.with_ctes(["panel"], "SELECT * FROM panel"), C.PANEL_DOUBLES)
def q_c13(spark, sf_dir):
    """Yields with a unit and weather with names of its own that clash
    with the yields'; the panel is the one without them."""
    yields = C.targets_df(spark, sf_dir).withColumn("unit", F.lit("USD / ORDER"))
    weather = C.weather_df(spark, sf_dir).withColumns({c: F.lit("stray") for c in ("county", "state", "state_fips")})
    return P.build_panel(yields, weather, C.drought_df(spark, sf_dir))


@C.register("j1_unmatched_rows", O.with_ctes(["panel"], """
SELECT count_if(checkpoint IS NULL) AS unmatched_rows, count(*) AS rows
FROM (SELECT t.county_fips, CASE WHEN t.year % 2 = 0 THEN NULL ELSE w.checkpoint END AS checkpoint
      FROM targets t LEFT JOIN ckw w ON t.county_fips = w.county_fips AND t.year = w.year AND t.year % 2 = 1)"""))
def q_j1_unmatched(spark, sf_dir):
    """Panel rows that found no weather, which lacks every other year."""
    weather = C.weather_df(spark, sf_dir).where("year % 2 = 1")
    panel = P.build_panel(C.targets_df(spark, sf_dir), weather, drop_missing_target=False)
    return P.unmatched_rows(panel, ["checkpoint", "obs_days", "mean_temp"])


def _outcome(check: Callable[[], object]) -> str:
    """``ok`` or the name of the error that ``check`` raises."""
    try:
        check()
    except (AssertionError, FileNotFoundError, KeyError, ValueError) as e:
        return type(e).__name__
    return "ok"


@C.register("t8_gates", O.with_ctes(["panel", "lab", "dirty"], """
SELECT * FROM (
  SELECT 'c8' AS gate, 'clean' AS input, CASE WHEN count_if("Value" <> '(D)') > 0 THEN 'ok' ELSE 'ValueError' END AS outcome FROM dirty
  UNION ALL SELECT 'c8', 'suppressed', CASE WHEN count_if("Value" = '(D)' AND false) > 0 THEN 'ok' ELSE 'ValueError' END FROM dirty
  UNION ALL SELECT 'c8', 'no value column', 'ValueError'
  UNION ALL SELECT 'c8', 'text values', 'ValueError'
  UNION ALL SELECT 'j10', 'panel', 'ok'
  UNION ALL SELECT 'j10', 'no year', 'KeyError'
  UNION ALL SELECT 't8 years', 'split', CASE WHEN (SELECT count(*) FROM (SELECT year FROM lab WHERE split = 'train'
    INTERSECT SELECT year FROM lab WHERE split = 'test')) = 0 THEN 'ok' ELSE 'AssertionError' END
  UNION ALL SELECT 't8 years', 'overlap', 'AssertionError'
  UNION ALL SELECT 't8 panel', 'panel', CASE WHEN (SELECT count(*) FROM (SELECT 1 FROM panel WHERE checkpoint IS NOT NULL
    GROUP BY county_fips, crop, year, checkpoint HAVING count(*) > 1)) = 0 THEN 'ok' ELSE 'ValueError' END
  UNION ALL SELECT 't8 panel', 'repeated rows', 'ValueError'
  UNION ALL SELECT 't8 panel', 'no target', 'KeyError'
  UNION ALL SELECT 'm2', 'features', 'ok'
  UNION ALL SELECT 'm2', 'target among them', 'ValueError'
  UNION ALL SELECT 'm4', 'unknown group', 'ValueError')"""))
def q_gates(spark, sf_dir):
    """Every gate on an input that passes and on ones that must not."""
    clean, panel = R.clean_yield_records(A.dirty(spark, sf_dir)), C.stored_panel(spark, sf_dir)
    train, test = C.labelled_split(spark, sf_dir)
    numeric, categorical = FS.select_feature_columns(panel)
    checks = {
        ("c8", "clean"): lambda: R.validate_yield_records(clean),
        ("c8", "suppressed"): lambda: R.validate_yield_records(
            R.clean_yield_records(A.dirty(spark, sf_dir).where("Value = '(D)'"))),
        ("c8", "no value column"): lambda: R.validate_yield_records(clean.drop("value")),
        ("c8", "text values"): lambda: R.validate_yield_records(clean.withColumn("value", F.col("value").cast("string"))),
        ("j10", "panel"): lambda: validate_merge_keys(panel, "panel"),
        ("j10", "no year"): lambda: validate_merge_keys(panel.drop("year"), "panel"),
        ("t8 years", "split"): lambda: SP.assert_no_year_overlap(train, test),
        ("t8 years", "overlap"): lambda: SP.assert_no_year_overlap(train.unionByName(test), test),
        ("t8 panel", "panel"): lambda: SP.panel_sanity_check(panel),
        ("t8 panel", "repeated rows"): lambda: SP.panel_sanity_check(panel.unionByName(panel.where("year % 2 = 0"))),
        ("t8 panel", "no target"): lambda: SP.panel_sanity_check(panel.drop("yield_anomaly")),
        ("m2", "features"): lambda: FS.assert_no_leakage(numeric, categorical),
        ("m2", "target among them"): lambda: FS.assert_no_leakage([*numeric, "yield_anomaly_pct"], categorical),
        ("m4", "unknown group"): lambda: FS.feature_set(panel, "soil"),
    }
    rows = [(gate, given, _outcome(check)) for (gate, given), check in checks.items()]
    return spark.createDataFrame(rows, "gate string, input string, outcome string")


# ------------------------------------------------------------------ features, order
_LACKING = {"whole": [], "no drought": FS.DROUGHT_COLUMNS, "no lags": FS.LAGGED_YIELD_COLUMNS}


def _members() -> list[tuple[str, str, str]]:
    """(panel, group, column) that SURVEY's groups give, from the fixed values."""
    have = [c for c, _ in C.PANEL_LAYOUT]
    numeric = {**FS.GROUPS, FS.ALL_GROUP: [c for g in FS.GROUPS.values() for c in g] + [FS.YEAR_INDEX_FEATURE]}
    out = []
    for panel, gone in _LACKING.items():
        for group, columns in numeric.items():
            left = [c for c in columns if c in have and c not in gone]
            if left:
                out += [(panel, group, c) for c in dict.fromkeys([*FS.BASE_NUMERIC, *left, *FS.BASE_CATEGORICAL])]
        out += [(panel, "eda", c) for c in have if c not in FS.EDA_NON_FEATURES and c not in gone]
    return out


@C.register("m4_feature_groups", O.with_ctes(["panel"], "\nUNION ALL\n".join(
    f"SELECT '{p}' AS panel, '{g}' AS feature_group, '{c}' AS \"column\", count({c}) AS present FROM panel"
    for p, g, c in _members())))
def q_m4(spark, sf_dir):
    """M3 + M4: the columns of every available group, and those left for
    exploration, with their present values, of panels that lack columns."""
    panel, out = C.stored_panel(spark, sf_dir), []
    for name, gone in _LACKING.items():
        p = panel.drop(*gone)
        groups = {g: [c for part in FS.feature_set(p, g) for c in part] for g in FS.available_groups(p)}
        members = [(g, c) for g, columns in (groups | {"eda": FS.eda_feature_columns(p)}).items() for c in columns]
        counts = p.agg(*[F.count(c).alias(c) for c in dict.fromkeys(c for _, c in members)])
        out.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("panel"), F.lit(g).alias("feature_group"), F.lit(c).alias("column"),
                     F.col(c).alias("present")) for g, c in members])).alias("m")).select("m.*"))
    return R.union_frames(out)


@C.register("o1_first_panel_rows", O.with_ctes(["panel"], """
SELECT state, county, crop, year, checkpoint, yield_anomaly FROM panel
ORDER BY state, county, crop, year, checkpoint LIMIT 20"""), ["yield_anomaly"])
def q_o1(spark, sf_dir):
    """O1 + O6: the first rows of the panel in the order of its sink."""
    return M.head(P.sort_panel(C.stored_panel(spark, sf_dir)), 20, P.SORT_COLUMNS) \
        .select(*P.SORT_COLUMNS, "yield_anomaly")
