"""Nested JSON payloads.

The weather service returns ``{"PARAM": {"YYYYMMDD": value}}`` per entity;
the yield service returns ``{"data": [record, ...]}`` or ``{"error": [...]}``.
Both are parsed with ``from_json`` and flattened with generators inside
each task -- no shuffle, no driver round trip.

Nothing is lost silently: a payload either yields rows, is empty, or is in
the quarantine with its reason and raw text, and ``payload_balance`` counts
all three in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from pitpanel.functions.ids import sentinel_to_null

# The requested daily parameters and the missing-value sentinel.
WEATHER_PARAMS = ["PRECTOTCORR", "T2M", "T2M_MIN", "T2M_MAX"]
SENTINEL = -999.0


#: Why a payload (or one key of it) is in the quarantine.
NO_PAYLOAD = "no payload"
NOT_AN_OBJECT = "not a JSON object"
ERROR_KEY = "error"
BAD_SHAPE = "unexpected shape"
BAD_DATE = "bad date key"


def _weather_parsed(df: DataFrame, payload_col: str, keep: Sequence[str]) -> DataFrame:
    """Payloads with their maps ``_m`` and the reason why they cannot be read."""
    maps = MapType(StringType(), MapType(StringType(), StringType()))
    keys = F.json_object_keys(F.col(payload_col))
    parsed = df.select(*keep, F.col(payload_col).alias("_payload"), keys.alias("_keys"),
                       F.from_json(F.col(payload_col), maps).alias("_m"))
    whole = F.coalesce(F.forall(F.map_values("_m"), lambda v: v.isNotNull()), F.lit(False)) \
        & (F.size(F.map_keys("_m")) == F.size("_keys"))
    return parsed.withColumn("_reason", F.when(F.col("_payload").isNull(), NO_PAYLOAD)
                             .when(F.col("_keys").isNull(), NOT_AN_OBJECT)
                             .when((F.size("_keys") == 0) | ~whole, BAD_SHAPE))


def _weather_cells(df: DataFrame, payload_col: str, params: Sequence[str], keep: Sequence[str]) -> DataFrame:
    parsed = _weather_parsed(df, payload_col, keep).where(F.col("_reason").isNull())
    first = F.element_at(F.map_keys(F.col("_m")), 1)
    empty = F.create_map().cast(MapType(StringType(), StringType()))
    acc = F.transform_values(F.col("_m")[first], lambda k, v: F.struct(F.lit(True).alias("_present")))
    done: list[str] = []
    for p in params:
        acc = F.map_zip_with(acc, F.coalesce(F.col("_m")[p], empty), _merger(list(done), p))
        done.append(p)
    return parsed.select(*keep, "_payload", F.explode(acc).alias("_d", "_v")).filter(F.col("_v._present")) \
        .withColumn("_date", F.when(F.col("_d").rlike("^[0-9]{8}$"), F.try_to_date("_d", "yyyyMMdd")))


def unnest_weather_payload(df: DataFrame, payload_col: str = "payload",
                           params: Sequence[str] = WEATHER_PARAMS, keep: Sequence[str] = ()) -> DataFrame:
    """One row per date of the *first* parameter, one column per
    requested parameter; a date absent from a parameter gets the sentinel,
    and the sentinel (exact match) becomes NULL; adds date, year, month.

    The parameter maps are merged by date with ``map_zip_with`` (a hash
    merge, linear in the payload) and exploded once -- no per-date map
    lookups (which scan the map) and no shuffle.  What cannot be read is in
    ``quarantined_weather``."""
    rows = _weather_cells(df, payload_col, params, keep).where(F.col("_date").isNotNull())
    cols = []
    for p in params:
        v = F.coalesce(F.col(f"_v.{p}").try_cast("double"), F.lit(SENTINEL))
        cols.append(sentinel_to_null(v).alias(p))
    out = rows.select(*keep, F.col("_date").alias("date"), *cols)
    return out.withColumn("year", F.year("date")).withColumn("month", F.month("date"))


def quarantined_weather(df: DataFrame, payload_col: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Payloads that cannot be read, and single dates that are none: the
    kept columns, reason, key (a date's) and the raw payload."""
    whole = _weather_parsed(df, payload_col, keep).where(F.col("_reason").isNotNull()) \
        .select(*keep, F.col("_reason").alias("reason"), F.lit(None).cast("string").alias("key"), F.col("_payload").alias(payload_col))
    dates = _weather_cells(df, payload_col, (), keep).where(F.col("_date").isNull()) \
        .select(*keep, F.lit(BAD_DATE).alias("reason"), F.col("_d").alias("key"), F.col("_payload").alias(payload_col))
    return whole.unionByName(dates)


def _merger(prev: list[str], p: str):
    """(key, accumulated struct, value) -> struct carrying one more parameter."""
    return lambda k, a, v: F.struct(a["_present"].alias("_present"), *[a[q].alias(q) for q in prev], v.alias(p))


RECORD_FIELDS = ["year", "state_name", "county_name", "commodity_desc", "unit_desc", "Value",
                 "state_fips_code", "county_ansi"]


def _records_parsed(df: DataFrame, payload_col: str, fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Payloads with their records ``_p.data``, the reason why they cannot be
    read, and the text of an ``error`` key, whatever its type."""
    rec = StructType([StructField(f, StringType(), True) for f in fields])
    schema = StructType([StructField("data", ArrayType(rec), True), StructField("error", StringType(), True)])
    parsed = df.select(*keep, F.col(payload_col).alias("_payload"), F.json_object_keys(F.col(payload_col)).alias("_keys"),
                       F.from_json(F.col(payload_col), schema).alias("_p"))
    data = F.get_json_object("_payload", "$.data")  # its raw text: parsing alone would turn other shapes into nulls
    items = F.from_json(data, ArrayType(StringType()))
    bad = data.isNotNull() & (F.json_array_length(data).isNull() | F.exists(items, lambda r: r.isNull() | ~r.startswith("{")))
    messages = F.from_json(F.col("_p.error"), ArrayType(StringType()))
    return parsed.select(
        *keep, "_payload", F.col("_p.data").alias("_data"),
        F.when(F.col("_payload").isNull(), NO_PAYLOAD).when(F.col("_keys").isNull(), NOT_AN_OBJECT)
        .when(F.array_contains("_keys", "error"), ERROR_KEY).when(bad, BAD_SHAPE).alias("_reason"),
        F.when(F.array_contains("_keys", "error"),
               F.coalesce(F.when(F.col("_p.error").startswith("["), F.array_join(messages, "; ")), "_p.error", F.lit("")))
        .alias("_error"))


def unnest_records(df: DataFrame, payload_col: str = "payload", fields: Sequence[str] = RECORD_FIELDS,
                   keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``data[]`` records -> rows (all text), and the quarantine: payloads
    with an ``error`` key of any kind, without text, that are no JSON object or
    whose ``data`` is no list of records (kept columns, reason, error, payload).
    An absent or empty ``data`` yields no rows."""
    parsed = _records_parsed(df, payload_col, fields, keep)
    errors = parsed.filter(F.col("_reason").isNotNull()) \
        .select(*keep, F.col("_reason").alias("reason"), F.col("_error").alias("error"), F.col("_payload").alias(payload_col))
    rows = parsed.filter(F.col("_reason").isNull()).select(*keep, F.explode("_data").alias("_r")).select(*keep, "_r.*")
    return rows, errors


def payload_balance(df: DataFrame, payload_col: str = "payload", fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """Where each payload went: outcome (``rows``, ``empty`` or the reason of
    the quarantine), payloads, records.  The payloads add up to the input."""
    records = F.coalesce(F.size(F.coalesce("_data", F.array())), F.lit(0))
    return _records_parsed(df, payload_col, fields, []) \
        .groupBy(F.coalesce("_reason", F.when(records > 0, "rows").otherwise("empty")).alias("outcome")) \
        .agg(F.count("*").alias("payloads"), F.sum(F.when(F.col("_reason").isNull(), records).otherwise(0)).alias("records"))
