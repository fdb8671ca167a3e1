"""Declared schemas for raw trip files, the zone seed and staging outputs.

Raw datetimes are wall-clock values without an offset, so they are declared as
TIMESTAMP_NTZ.  NUMERIC columns are DECIMAL(38,9).  Column comments carry the
descriptions the load flow attaches to its tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)
TS = T.TimestampNTZType()


def _f(name, dtype, comment=None):
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, True, metadata=meta)


YELLOW_RAW = T.StructType([
    _f("VendorID", T.StringType(), "Code of the provider that supplied the record"),
    _f("tpep_pickup_datetime", TS, "When the meter was engaged"),
    _f("tpep_dropoff_datetime", TS, "When the meter was disengaged"),
    _f("passenger_count", T.LongType(), "Passengers in the vehicle"),
    _f("trip_distance", NUMERIC, "Elapsed trip distance in miles"),
    _f("RatecodeID", T.StringType(), "Rate code in effect at the end of the trip"),
    _f("store_and_fwd_flag", T.StringType(), "Held in vehicle memory before sending"),
    _f("PULocationID", T.StringType(), "Zone where the meter was engaged"),
    _f("DOLocationID", T.StringType(), "Zone where the meter was disengaged"),
    _f("payment_type", T.LongType(), "How the passenger paid"),
    _f("fare_amount", NUMERIC, "Time-and-distance fare"),
    _f("extra", NUMERIC, "Extras and surcharges"),
    _f("mta_tax", NUMERIC, "MTA tax"),
    _f("tip_amount", NUMERIC, "Tip amount"),
    _f("tolls_amount", NUMERIC, "Tolls paid"),
    _f("improvement_surcharge", NUMERIC, "Improvement surcharge"),
    _f("total_amount", NUMERIC, "Total charged"),
    _f("congestion_surcharge", NUMERIC, "Congestion surcharge"),
])

GREEN_RAW = T.StructType([
    _f("VendorID", T.StringType(), "Code of the provider that supplied the record"),
    _f("lpep_pickup_datetime", TS, "When the meter was engaged"),
    _f("lpep_dropoff_datetime", TS, "When the meter was disengaged"),
    _f("store_and_fwd_flag", T.StringType(), "Held in vehicle memory before sending"),
    _f("RatecodeID", T.StringType(), "Rate code in effect at the end of the trip"),
    _f("PULocationID", T.StringType(), "Zone where the meter was engaged"),
    _f("DOLocationID", T.StringType(), "Zone where the meter was disengaged"),
    _f("passenger_count", T.LongType(), "Passengers in the vehicle"),
    _f("trip_distance", NUMERIC, "Elapsed trip distance in miles"),
    _f("fare_amount", NUMERIC, "Time-and-distance fare"),
    _f("extra", NUMERIC, "Extras and surcharges"),
    _f("mta_tax", NUMERIC, "MTA tax"),
    _f("tip_amount", NUMERIC, "Tip amount"),
    _f("tolls_amount", NUMERIC, "Tolls paid"),
    _f("ehail_fee", NUMERIC, "E-hail fee"),
    _f("improvement_surcharge", NUMERIC, "Improvement surcharge"),
    _f("total_amount", NUMERIC, "Total charged"),
    _f("payment_type", T.LongType(), "How the passenger paid"),
    _f("trip_type", T.StringType(), "Street-hail or dispatch"),
    _f("congestion_surcharge", NUMERIC, "Congestion surcharge"),
])

FHV_RAW = T.StructType([
    _f("dispatching_base_num", T.StringType(), "Base that dispatched the trip"),
    _f("pickup_datetime", TS, "Pickup time"),
    _f("dropOff_datetime", TS, "Dropoff time"),
    _f("PUlocationID", T.LongType(), "Pickup zone"),
    _f("DOlocationID", T.LongType(), "Dropoff zone"),
    _f("SR_Flag", T.LongType(), "Shared-ride flag"),
    _f("Affiliated_base_number", T.StringType(), "Affiliated base"),
])

# The for-hire layout of the scheduled load, which takes zone ids and the flag as text.
FHV_FLOW = T.StructType([
    _f("dispatching_base_num", T.StringType(), "Base that dispatched the trip"),
    _f("pickup_datetime", TS, "Pickup time"),
    _f("dropOff_datetime", TS, "Dropoff time"),
    _f("PUlocationID", T.StringType(), "Pickup zone"),
    _f("DOlocationID", T.StringType(), "Dropoff zone"),
    _f("SR_Flag", T.StringType(), "Shared-ride flag"),
    _f("Affiliated_base_number", T.StringType(), "Affiliated base"),
])

RAW_SCHEMAS = {"yellow": YELLOW_RAW, "green": GREEN_RAW, "fhv": FHV_RAW}

# Pickup/dropoff column names per service in the raw files.
PICKUP_COL = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime", "fhv": "pickup_datetime"}
DROPOFF_COL = {"yellow": "tpep_dropoff_datetime", "green": "lpep_dropoff_datetime", "fhv": "dropOff_datetime"}
VENDOR_COL = {"yellow": "VendorID", "green": "VendorID", "fhv": "dispatching_base_num"}
PU_COL = {"yellow": "PULocationID", "green": "PULocationID", "fhv": "PUlocationID"}
DO_COL = {"yellow": "DOLocationID", "green": "DOLocationID", "fhv": "DOlocationID"}

ZONE_SEED = T.StructType([
    _f("locationid", T.LongType(), "Zone id"),
    _f("borough", T.StringType(), "Borough"),
    _f("zone", T.StringType(), "Zone name"),
    _f("service_zone", T.StringType(), "Service zone"),
])

# Output column order of the green and yellow staging models.
STAGING_COLUMNS = [
    "tripid", "vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "payment_type_description",
]

MONEY_COLUMNS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "ehail_fee", "improvement_surcharge", "total_amount"]

FACT_TRIPS_COLUMNS = [
    "tripid", "vendorid", "service_type", "ratecodeid", "pickup_locationid",
    "pickup_borough", "pickup_zone", "dropoff_locationid", "dropoff_borough",
    "dropoff_zone", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
    "total_amount", "payment_type", "payment_type_description",
]

FACT_FHV_COLUMNS = [
    "dispatchid", "service_type", "pickup_datetime", "pickup_locationid",
    "pickup_borough", "pickup_zone", "dropoff_datetime", "dropoff_locationid",
    "dropoff_borough", "dropoff_zone", "sr_flag",
]
