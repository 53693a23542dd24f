"""Run-time schema contracts (C8, J10): analysis-time checks, no Spark job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


# The types of a saved panel's columns (measures are DOUBLE).
PANEL_TYPES = dict.fromkeys(
    ["county_fips", "state_fips", "state", "county", "crop", "unit", "checkpoint"], "string") | dict.fromkeys(
    ["year", "year_index", "max_drought_category", "severe_risk"], "int") | dict.fromkeys(
    ["extreme_heat_days", "dry_days", "longest_dry_spell", "obs_days", "max_consecutive_dry_days", "weeks_d0",
     "weeks_d1", "weeks_d2", "weeks_d3", "weeks_d4", "weeks_d2_plus", "heat_dry_stress", "heat_dry_spell"],
    "bigint") | {"is_partial_year": "boolean", "severe_risk_descriptive": "string"}


def require_columns(df: DataFrame, cols: Iterable[str], where: str = "input") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{where} is missing columns: {missing}. Found columns: {df.columns}")


def validate_merge_keys(df: DataFrame, name: str, keys: Iterable[str] = ("county_fips", "year")) -> None:
    """Informative error when join keys are absent."""
    require_columns(df, keys, f"{name} merge keys")


def numeric_columns(df: DataFrame) -> list[str]:
    from pyspark.sql.types import BooleanType, NumericType
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (NumericType, BooleanType))]
