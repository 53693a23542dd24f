"""Landed daily batches: centroid dimension (S7, J8), completeness-based
resume (S8, J9) and batch merge (S9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.ids import normalize_fips, zero_fill


def centroids(raw: DataFrame, requested: DataFrame | None = None, requested_col: str = "county_fips") -> DataFrame:
    """S7 + J8: (county_fips, county, state_fips, lat, lon) from a raw
    centroid file (STATEFP, COUNTYFP, COUNAME, LATITUDE, LONGITUDE as text);
    kept only for requested ids (normalised, semi join); missing lat/lon dropped."""
    st = zero_fill(F.trim(F.col("STATEFP")), 2)
    out = raw.select(
        F.concat(st, zero_fill(F.trim(F.col("COUNTYFP")), 3)).alias("county_fips"),
        F.upper(F.trim(F.col("COUNAME"))).alias("county"),
        st.alias("state_fips"),
        F.trim(F.col("LATITUDE")).try_cast("double").alias("lat"),
        F.trim(F.col("LONGITUDE")).try_cast("double").alias("lon"),
    )
    if requested is not None:
        ids = requested.select(normalize_fips(requested_col).alias("county_fips")).dropna()
        out = out.join(ids, "county_fips", "left_semi")
    return out.dropna(subset=["lat", "lon"])


def completeness(landed: DataFrame, start_year: int, end_year: int, id_col: str = "county_fips",
                 year_col: str = "year") -> DataFrame:
    """An entity is complete iff every year of [start, end] is present
    (relational division: distinct in-range years per entity = n years)."""
    n = end_year - start_year + 1
    y = F.col(year_col).cast("int")
    return (landed.filter(y.between(start_year, end_year))
            .groupBy(id_col).agg(F.count_distinct(y).alias("years_present"))
            .withColumn("complete", F.col("years_present") == n))


def remaining_entities(entities: DataFrame, landed: DataFrame, start_year: int, end_year: int,
                       id_col: str = "county_fips") -> DataFrame:
    """Entities still to load = all - complete (anti join)."""
    done = completeness(landed, start_year, end_year, id_col).filter("complete").select(id_col)
    return entities.join(done, id_col, "left_anti")


def merge_batches(batches: Sequence[DataFrame], keys: Sequence[str] = ("county_fips", "date")) -> DataFrame:
    """S9 + U1: union landed batches, the latest batch wins per key.

    Deliberate deviation: a re-fetched entity keeps one row per (entity,
    date), never the old and the new row both (which would double sums)."""
    tagged = [b.withColumn("_batch", F.lit(i)) for i, b in enumerate(batches)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col("_batch").desc())
    return u.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_batch")
