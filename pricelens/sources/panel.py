"""The price panel over the star-schema test tables.

One observation per line item: price = extended price / quantity, cost =
price * (1 - discount); product = part type, brand = part brand, region /
state from the customer's nation, city = market segment, station =
supplier, date = order date. Every registered query starts here, so its
work grows with the tables.

Join plan: ``nation`` and ``region`` are fixed 25- and 5-row dimensions of
this schema, so they are broadcast by hint. ``customer``, ``part`` and
``orders`` grow with the data; their strategy is left to AQE, which
broadcasts a side only when its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the
sort-merge join (with skew splitting). The names of nation and region are
joined last, so that rows are shuffled with the nation's key alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def padded(key: str, width: int):
    """``%0<width>d`` of a key; a formatter is called only for what isn't 0 to width digits."""
    k = F.col(key)
    return (F.when(k.between(0, 10 ** width - 1), F.lpad(k.cast("string"), width, "0"))
             .otherwise(F.format_string(f"%0{width}d", k)))


def star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows, without what ``star_columns`` computes from a row's other columns; whoever
    shuffles or writes rows moves these. Orders are joined last: rows then lie by order, and a
    dedup by (order, line) finds them together."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")

    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    ords = orders.join(cust, orders.o_custkey == cust.c_custkey)
    x = (li.join(part, li.l_partkey == part.p_partkey)
           .join(ords, li.l_orderkey == ords.o_orderkey)
           .join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey))
    return x.select(
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("city"),
        F.col("p_type").alias("product"),
        F.col("p_brand").alias("brand"),
        F.to_date(F.col("o_orderdate")).alias("obs_date"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate",
    )


def star_columns(rows: DataFrame) -> DataFrame:
    """The panel's columns from its joined rows."""
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    given = [c for c in rows.columns if c.startswith("l_")]
    return rows.select(
        "region", "state", "city",
        F.col("l_suppkey").alias("station"),
        F.concat(F.lit("S-"), padded("l_suppkey", 6)).alias("station_code"),
        "product", "brand", "obs_date",
        price.alias("price"),
        (price * (F.lit(1.0) - F.col("l_discount"))).alias("cost"),
        *given)


def star_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_columns(star_rows(spark, sf_dir))


# The same panel for the DuckDB oracle; every oracle query is
# ``WITH panel AS (...) , ...`` over the pre-registered tables.
PANEL_SQL = """
panel AS (
  SELECT r.r_name AS region, n.n_name AS state, c.c_mktsegment AS city,
         l.l_suppkey AS station, printf('S-%06d', l.l_suppkey) AS station_code,
         p.p_type AS product, p.p_brand AS brand,
         CAST(o.o_orderdate AS DATE) AS obs_date,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS price,
         (l.l_extendedprice / NULLIF(l.l_quantity, 0)) * (1.0 - l.l_discount) AS cost,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
         l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
         l.l_shipdate
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""
