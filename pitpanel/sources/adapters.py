"""Adapter views: panel-shaped inputs derived from the star-schema tables.

The driver tables have no crops or weather, so each logical input of the
panel is derived from them (entity = nation, state = region, crop = market
segment):

* ``annual``  -- yield analogue: mean order value per (nation, segment, year)
* ``daily``   -- weather analogue: per (supplier nation, ship date) quantities
* ``weekly``  -- drought analogue: order-priority shares per (nation, week)
* ``dirty``   -- raw yield records with float-like ids and suppressed values

Every view is a distributed aggregation whose work grows with the tables.
Large fact tables are pre-aggregated on their foreign key before the
dimension join so the shuffle carries partial sums, not raw rows; the
nation/region dimensions are fixed-size (25 / 5 rows) and broadcast, while
customer / supplier grow with the scale factor and are left to the planner
(sort-merge or AQE-converted broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.functions.ids import zero_fill

# Order priorities mapped onto severity categories D0..D4.
PRIORITY_TO_CATEGORY = {
    "5-LOW": "D0",
    "4-NOT SPECIFIED": "D1",
    "3-MEDIUM": "D2",
    "2-HIGH": "D3",
    "1-URGENT": "D4",
}


_READS: dict[tuple[int, str], tuple[object, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table reader, one relation per (session, path): listing and
    footer reads happen once, and identical sub-plans share one relation."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    js = spark._jsparkSession
    key = (id(js), path)
    # the session object is kept in the value, so its id cannot be reused
    if key not in _READS or _READS[key][0] is not js:
        _READS[key] = (js, spark.read.parquet(path))
    return _READS[key][1]


def _fips(c) -> F.Column:
    return zero_fill(F.col(c).cast("string"), 5)


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(state, county, county_fips, crop, year, value) -- yield analogue."""
    orders = table(spark, sf_dir, "orders")
    per_cust = (
        orders.select("o_custkey", F.year("o_orderdate").cast("int").alias("year"),
                      F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
        .groupBy("o_custkey", "year")
        .agg(F.sum("price").alias("price_sum"), F.count(F.lit(1)).alias("n"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    joined = (
        per_cust.join(customer, per_cust.o_custkey == customer.c_custkey)
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return (
        joined.groupBy(
            F.col("r_name").alias("state"), F.col("n_name").alias("county"),
            _fips("n_nationkey").alias("county_fips"), F.col("c_mktsegment").alias("crop"), "year")
        .agg((F.sum("price_sum").cast("double") / F.sum("n")).alias("value"))
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(county_fips, year, date, PRECTOTCORR, T2M, T2M_MAX) -- weather analogue."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("date"), "l_quantity")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(supplier, li.l_suppkey == supplier.s_suppkey)
    g = (
        j.groupBy(_fips("s_nationkey").alias("county_fips"), "date")
        .agg(F.sum("l_quantity").alias("q_sum"), F.count("l_quantity").alias("q_n"),
             F.max("l_quantity").alias("q_max"))
    )
    return g.select(
        "county_fips", F.year("date").cast("int").alias("year"), "date",
        (F.col("q_sum") / 10.0).alias("PRECTOTCORR"),
        (F.col("q_sum") / F.col("q_n")).alias("T2M"),
        F.col("q_max").alias("T2M_MAX"),
    )


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(county_fips, date, D0..D4) weekly percentages -- drought analogue."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.date_trunc("week", "o_orderdate").cast("date").alias("date"), "o_orderpriority")
    per_cust = orders.groupBy("o_custkey", "date").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("o_orderpriority") == p).alias(cat) for p, cat in PRIORITY_TO_CATEGORY.items()])
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = per_cust.join(customer, per_cust.o_custkey == customer.c_custkey)
    g = j.groupBy(_fips("c_nationkey").alias("county_fips"), "date").agg(
        F.sum("n").alias("n"), *[F.sum(cat).alias(cat) for cat in PRIORITY_TO_CATEGORY.values()])
    return g.select("county_fips", "date",
                    *[(F.lit(100.0) * F.col(cat).cast("double") / F.col("n").cast("double")).alias(cat)
                      for cat in PRIORITY_TO_CATEGORY.values()])


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yield records as a source would land them: every column a string,
    ids float-formatted (``3.0``), values with thousands separators or the
    suppression code ``(D)``."""
    a = annual(spark, sf_dir)
    code = F.col("county_fips").cast("int")
    value_txt = F.when((code + F.col("year")) % 17 == 0, F.lit("(D)")).otherwise(
        F.format_number(F.floor("value").cast("bigint"), 0))
    return a.select(
        F.col("year").cast("string").alias("year"),
        F.col("state").alias("state_name"),
        F.col("county").alias("county_name"),
        F.col("crop").alias("commodity_desc"),
        F.lit("USD / ORDER").alias("unit_desc"),
        value_txt.alias("Value"),
        F.floor(code / 1000).cast("double").cast("string").alias("state_fips_code"),
        (code % 1000).cast("double").cast("string").alias("county_ansi"),
        code.cast("double").cast("string").alias("county_fips"),
    )
