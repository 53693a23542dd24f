"""Raw yield records: typed reading and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.types import StringType, StructField, StructType

from pitpanel.functions.ids import (
    fips_from_parts, normalize_county_code, normalize_fips, normalize_state_fips, to_number,
)

# Source column names -> canonical names, and the clean layout.
RAW_RENAME = {
    "year": "year",
    "state_name": "state",
    "county_name": "county",
    "commodity_desc": "crop",
    "unit_desc": "unit",
    "Value": "value",
    "state_fips_code": "state_fips",
    "county_ansi": "county_ansi",
}
CLEAN_COLUMNS = ["year", "state", "county", "county_fips", "crop", "value", "unit"]
ID_COLUMNS = ("county_fips", "state_fips", "county_ansi", "state_fips_code")


def read_csv_as_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column read as text (ids never inferred
    numeric); the schema is built from the header alone."""
    header = spark.read.option("header", True).csv(path).columns
    schema = StructType([StructField(c, StringType(), True) for c in header])
    return spark.read.option("header", True).schema(schema).csv(path)


def normalize_id_columns(df: DataFrame) -> DataFrame:
    """C1-C4 on whichever id columns exist; a missing 5-char id is rebuilt
    from state + county parts."""
    cols = {}
    if "county_fips" in df.columns:
        cols["county_fips"] = normalize_fips("county_fips")
    for c in ("state_fips", "state_fips_code"):
        if c in df.columns:
            cols[c] = normalize_state_fips(c)
    if "county_ansi" in df.columns:
        cols["county_ansi"] = normalize_county_code("county_ansi")
    out = df.withColumns(cols) if cols else df
    st = "state_fips" if "state_fips" in out.columns else ("state_fips_code" if "state_fips_code" in out.columns else None)
    if st and "county_ansi" in out.columns:
        rebuilt = F.concat(F.col(st), F.col("county_ansi"))
        out = out.withColumn("county_fips", F.coalesce(F.col("county_fips"), rebuilt)
                             if "county_fips" in out.columns else rebuilt)
    return out


def trim_strings(df: DataFrame) -> DataFrame:
    """C5."""
    return df.select(*[F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that are present."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns and k != v})


def source_filter(df: DataFrame, crops: Sequence[str] | None = None, states: Sequence[str] | None = None,
                  start_year: int | None = None, end_year: int | None = None,
                  extra: dict[str, str] | None = None) -> DataFrame:
    """the source predicates (commodity, state, year range and any
    equality such as statistic / unit / aggregation level / domain)."""
    cond = F.lit(True)
    if crops:
        cond = cond & F.col("commodity_desc").isin(*crops)
    if states:
        cond = cond & F.col("state_name").isin(*states)
    y = F.col("year").cast("string").try_cast("int")
    if start_year is not None:
        cond = cond & (y >= start_year)
    if end_year is not None:
        cond = cond & (y <= end_year)
    for k, v in (extra or {}).items():
        cond = cond & (F.col(k) == v)
    return df.filter(cond)


def clean_yield_records(df: DataFrame) -> DataFrame:
    """Trim, rename, year as INT, numeric value (commas stripped,
    suppression codes / blanks -> missing, then dropped), 5-char id from
    state + county parts, missing clean columns added as NULL, projected."""
    out = rename_columns(trim_strings(df), RAW_RENAME)
    out = out.withColumn("year", F.col("year").cast("string").try_cast("int")) \
        .withColumn("value", to_number("value"))
    out = out.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    if "state_fips" in out.columns and "county_ansi" in out.columns:
        out = out.withColumn("county_fips", fips_from_parts("state_fips", "county_ansi"))
    else:
        out = out.withColumn("county_fips", F.lit(None).cast("string"))
    for c in CLEAN_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*CLEAN_COLUMNS)


def validate_yield_records(df: DataFrame) -> None:
    """Required columns, numeric value, not all missing (one job)."""
    missing = [c for c in CLEAN_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"yield records are missing required columns: {missing}")
    if not isinstance(df.schema["value"].dataType, NumericType):
        raise ValueError("yield records need a numeric value column")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("nv")).first()
    if row["nv"] == 0:
        raise ValueError("no yield record has a value")


def load_panel(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a saved panel, normalise id and year, derive a checkpoint
    label when absent (C16) and drop any pre-existing label column.  CSV columns
    get the declared panel types; a column without one is a measure (DOUBLE),
    and text that does not fit its type is NULL."""
    from pitpanel.operators.panel import add_checkpoint_label
    from pitpanel.schema import PANEL_TYPES
    df = read_csv_as_text(spark, path) if fmt == "csv" else spark.read.parquet(path)
    if fmt == "csv":
        df = df.select(*[F.col(f"`{c}`").try_cast(PANEL_TYPES.get(c, "double")).alias(c) for c in df.columns])
    df = df.withColumn("county_fips", normalize_fips("county_fips")) \
        .withColumn("year", F.col("year").cast("string").try_cast("int"))
    df = add_checkpoint_label(df)
    return df.drop(*[c for c in ("severe_risk_descriptive", "severe_risk") if c in df.columns])


def _cast_known(df: DataFrame, numeric: Sequence[str] = (), ints: Sequence[str] = (),
                bools: Sequence[str] = ()) -> DataFrame:
    cols = {}
    for c in df.columns:
        if c in ints:
            cols[c] = F.trim(F.col(c)).try_cast("int")
        elif c in bools:
            cols[c] = F.lower(F.trim(F.col(c))).isin("true", "1")
        elif c in numeric:
            cols[c] = F.trim(F.col(c)).try_cast("double")
    return df.withColumns(cols) if cols else df


def read_weather_features(spark: SparkSession, path: str) -> DataFrame:
    """Weather-feature CSV; ids stay text (normalised), year coerced,
    every other known measure numeric."""
    df = normalize_id_columns(read_csv_as_text(spark, path))
    text = {"county_fips", "state_fips", "county", "state", "checkpoint"}
    numeric = [c for c in df.columns if c not in text | {"year", "is_partial_year"}]
    return _cast_known(df, numeric, ints=["year"], bools=["is_partial_year"])


def read_daily(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Daily measurements CSV with date parsing (bad dates -> NULL)."""
    df = normalize_id_columns(read_csv_as_text(spark, path))
    text = {"county_fips", "state_fips", "county", "date"}
    numeric = [c for c in df.columns if c not in text | {"year", "month"}]
    df = _cast_known(df, numeric, ints=["year", "month"])
    return df.withColumn("date", F.try_to_date(F.col("date"), date_format))


def read_weekly(spark: SparkSession, path: str) -> DataFrame:
    """S3: weekly severity CSV -> cleaned."""
    from pitpanel.operators.weekly import clean_weekly
    return clean_weekly(read_csv_as_text(spark, path))


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name (missing columns as NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
