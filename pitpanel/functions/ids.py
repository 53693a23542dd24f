"""Identifier normalisation and numeric coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms that count as a missing identifier.
MISSING_TEXT = ["nan", "None", "NaN", "", "<NA>"]

# Suppression codes in source yield values.
SUPPRESSION_CODES = ["(D)", "(Z)", "(NA)"]

# A plain decimal number (optionally signed / exponent), as a numeric parser
# that rejects trailing letters would accept it.
_NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_fill(c, width: int) -> Column:
    """Left-pad with zeros up to ``width`` but never truncate (``lpad`` would)."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def normalize_code(c, width: int) -> Column:
    """Trim -> missing forms to NULL -> part before '.' -> zero-fill."""
    s = F.trim(_col(c).cast("string"))
    head = F.trim(F.substring_index(s, ".", 1))
    return F.when(s.isNull() | s.isin(*MISSING_TEXT), F.lit(None).cast("string")) \
        .otherwise(zero_fill(head, width))


def normalize_fips(c) -> Column:
    return normalize_code(c, 5)


def normalize_state_fips(c) -> Column:
    return normalize_code(c, 2)


def normalize_county_code(c) -> Column:
    return normalize_code(c, 3)


def fips_from_parts(state, county) -> Column:
    """C4: 5-char id from state (2) + county (3); NULL if either is missing."""
    return F.concat(normalize_state_fips(state), normalize_county_code(county))


def is_valid_fips(c) -> Column:
    """Exactly five digits."""
    return _col(c).rlike(r"^\d{5}$") & _col(c).isNotNull()


def to_number(c) -> Column:
    """Strip thousands separators; anything that is not a plain number
    (suppression codes, blanks, ``5D``) becomes NULL."""
    s = F.regexp_replace(_col(c).cast("string"), ",", "")
    return F.when(s.rlike(_NUMERIC_TEXT), F.trim(s).try_cast("double"))


def nan_to_null(c) -> Column:
    """NaN is not missing in Spark aggregates; convert it once at ingest."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def sentinel_to_null(c, sentinel: float = -999.0) -> Column:
    """C11: exact sentinel match -> NULL."""
    return F.nullif(_col(c), F.lit(sentinel))
