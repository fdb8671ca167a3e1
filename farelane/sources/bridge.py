"""Trip-shaped raw tables derived from the benchmark tables.

The test tables hold orders and line items, not trips, so this module renames
them into the three raw trip layouts and the zone seed.  Everything is lazy:
``lineitem ⋈ orders ⋈ customer ⋈ supplier`` with only the needed columns, the
service filter pushed into the ``lineitem`` scan.  Join strategies are left to
Catalyst/AQE: ``orders`` is joined with a shuffle on the order key, the
customer and supplier sides are broadcast only when their measured size is
under ``spark.sql.autoBroadcastJoinThreshold``.

Mapping (one row per line item):
  service           l_returnflag: A → green, R → yellow, N → fhv
  vendor / base     nullif(l_suppkey % 50, 0) as text
  pickup / dropoff  o_orderdate / l_shipdate
  pickup zone       c_nationkey;  dropoff zone  s_nationkey
  payment, rate     l_linenumber
  passengers        l_quantity;  distance  l_quantity
  fare, extra, tax  l_extendedprice, l_discount, l_tax
  tip               round(price * discount, 2)
  total             round(price * (1 - discount) * (1 + tax), 2)
  sr flag           null when l_linestatus = 'O' else 1
  zones             n_nationkey, n_name, r_name ('MIDDLE EAST' → 'Unknown'),
                    'N/A' for 'MIDDLE EAST', 'Boro Zone' for even keys, else 'Yellow Zone'
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.schemas import NUMERIC

SERVICE_FLAG = {"green": "A", "yellow": "R", "fhv": "N"}


_READ_CACHE: dict = {}


class Tables:
    """Lazy access to ``<root>/<name>.parquet``.

    The DataFrame for a table (a plan, no data) is kept per session and path,
    so building many queries does not re-read the Parquet footer each time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = os.path.join(self.root, f"{name}.parquet")
        key = (id(self.spark), path)
        df = _READ_CACHE.get(key)
        if df is None or df.sparkSession is not self.spark:
            df = self.spark.read.parquet(path)
            _READ_CACHE[key] = df
        return df


def _money(c, dec="decimal(18,2)"):
    return F.col(c).cast(dec) if isinstance(c, str) else c.cast(dec)


def _numeric(c):
    return c.cast(NUMERIC)


def _spread(df: DataFrame) -> DataFrame:
    """Deal rows out when the table's files give fewer splits than cores (the test tables are one row group each)."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def trip_base(t: Tables, service: str | None = None) -> DataFrame:
    """Line items of one service with order date and both nation keys."""
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate")
    if service is not None:
        li = li.where(F.col("l_returnflag") == SERVICE_FLAG[service])
    li = _spread(li)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    cust = t.customer.select("c_custkey", "c_nationkey")
    supp = t.supplier.select("s_suppkey", "s_nationkey")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(cust, F.col("o_custkey") == F.col("c_custkey"))
              .join(supp, F.col("l_suppkey") == F.col("s_suppkey")))


def _amounts() -> dict:
    price = _money("l_extendedprice")
    disc = _money("l_discount", "decimal(4,2)")
    tax = _money("l_tax", "decimal(4,2)")
    one = F.lit(1).cast("decimal(3,2)")
    zero = F.lit(0).cast(NUMERIC)
    return {
        "trip_distance": _numeric(_money("l_quantity")),
        "fare_amount": _numeric(price),
        "extra": _numeric(disc),
        "mta_tax": _numeric(tax),
        "tip_amount": _numeric(F.round(price * disc, 2)),
        "tolls_amount": zero,
        "ehail_fee": zero,
        "improvement_surcharge": zero,
        "total_amount": _numeric(F.round(price * (one - disc) * (one + tax), 2)),
        "congestion_surcharge": zero,
    }


def _vendor():
    return F.nullif(F.col("l_suppkey") % 50, F.lit(0)).cast("string")


def green_raw(t: Tables) -> DataFrame:
    a = _amounts()
    return trip_base(t, "green").select(
        _vendor().alias("VendorID"),
        F.col("o_orderdate").alias("lpep_pickup_datetime"),
        F.col("l_shipdate").alias("lpep_dropoff_datetime"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        F.col("l_linenumber").cast("string").alias("RatecodeID"),
        F.col("c_nationkey").cast("string").alias("PULocationID"),
        F.col("s_nationkey").cast("string").alias("DOLocationID"),
        F.col("l_quantity").cast("bigint").alias("passenger_count"),
        a["trip_distance"].alias("trip_distance"),
        a["fare_amount"].alias("fare_amount"),
        a["extra"].alias("extra"),
        a["mta_tax"].alias("mta_tax"),
        a["tip_amount"].alias("tip_amount"),
        a["tolls_amount"].alias("tolls_amount"),
        a["ehail_fee"].alias("ehail_fee"),
        a["improvement_surcharge"].alias("improvement_surcharge"),
        a["total_amount"].alias("total_amount"),
        F.col("l_linenumber").cast("bigint").alias("payment_type"),
        ((F.col("l_linenumber") % 2) + 1).cast("string").alias("trip_type"),
        a["congestion_surcharge"].alias("congestion_surcharge"),
    )


def yellow_raw(t: Tables) -> DataFrame:
    a = _amounts()
    return trip_base(t, "yellow").select(
        _vendor().alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_quantity").cast("bigint").alias("passenger_count"),
        a["trip_distance"].alias("trip_distance"),
        F.col("l_linenumber").cast("string").alias("RatecodeID"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        F.col("c_nationkey").cast("string").alias("PULocationID"),
        F.col("s_nationkey").cast("string").alias("DOLocationID"),
        F.col("l_linenumber").cast("bigint").alias("payment_type"),
        a["fare_amount"].alias("fare_amount"),
        a["extra"].alias("extra"),
        a["mta_tax"].alias("mta_tax"),
        a["tip_amount"].alias("tip_amount"),
        a["tolls_amount"].alias("tolls_amount"),
        a["improvement_surcharge"].alias("improvement_surcharge"),
        a["total_amount"].alias("total_amount"),
        a["congestion_surcharge"].alias("congestion_surcharge"),
    )


def fhv_raw(t: Tables) -> DataFrame:
    return trip_base(t, "fhv").select(
        _vendor().alias("dispatching_base_num"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropOff_datetime"),
        F.col("c_nationkey").cast("bigint").alias("PUlocationID"),
        F.col("s_nationkey").cast("bigint").alias("DOlocationID"),
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.lit(1)).cast("bigint").alias("SR_Flag"),
        F.nullif(F.col("l_partkey") % 40, F.lit(0)).cast("string").alias("Affiliated_base_number"),
    )


RAW_BUILDERS = {"green": green_raw, "yellow": yellow_raw, "fhv": fhv_raw}


def raw_trips(t: Tables, service: str) -> DataFrame:
    return RAW_BUILDERS[service](t)


def zone_seed(t: Tables) -> DataFrame:
    """Zone lookup in the seed layout (locationid, borough, zone, service_zone)."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("bigint").alias("locationid"),
                     F.when(F.col("r_name") == "MIDDLE EAST", F.lit("Unknown"))
                      .otherwise(F.col("r_name")).alias("borough"),
                     F.col("n_name").alias("zone"),
                     F.when(F.col("r_name") == "MIDDLE EAST", F.lit("N/A"))
                      .when(F.col("n_nationkey") % 2 == 0, F.lit("Boro Zone"))
                      .otherwise(F.lit("Yellow Zone")).alias("service_zone")))
