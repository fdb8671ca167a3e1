"""Reference SQL for each registered query, runnable by DuckDB.

These strings restate the modelled SQL over the benchmark tables (the same
renaming as ``farelane.sources.bridge``) so the Spark results can be checked
independently.  Building blocks are CTEs; ``sql(final, *needs)`` prepends the
blocks a statement needs, in dependency order.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong one in the library shows.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
PAYMENTS = [(1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute"), (5, "Unknown"), (6, "Voided trip")]

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_DISC = "CAST(l_discount AS DECIMAL(4,2))"
_TAX = "CAST(l_tax AS DECIMAL(4,2))"
_ONE = "CAST(1 AS DECIMAL(3,2))"
_N = "DECIMAL(38,9)"

_AMOUNTS = {
    "trip_distance": f"CAST(CAST(l_quantity AS DECIMAL(18,2)) AS {_N})",
    "fare_amount": f"CAST({_PRICE} AS {_N})",
    "extra": f"CAST({_DISC} AS {_N})",
    "mta_tax": f"CAST({_TAX} AS {_N})",
    "tip_amount": f"CAST(ROUND({_PRICE} * {_DISC}, 2) AS {_N})",
    "tolls_amount": f"CAST(0 AS {_N})",
    "ehail_fee": f"CAST(0 AS {_N})",
    "improvement_surcharge": f"CAST(0 AS {_N})",
    "total_amount": f"CAST(ROUND({_PRICE} * ({_ONE} - {_DISC}) * ({_ONE} + {_TAX}), 2) AS {_N})",
    "congestion_surcharge": f"CAST(0 AS {_N})",
}
_VENDOR = "CAST(NULLIF(l_suppkey % 50, 0) AS VARCHAR)"

GREEN_COLS = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "store_and_fwd_flag",
              "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "trip_distance",
              "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
              "improvement_surcharge", "total_amount", "payment_type", "trip_type",
              "congestion_surcharge"]
YELLOW_COLS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
               "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
               "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
               "improvement_surcharge", "total_amount", "congestion_surcharge"]
FHV_COLS = ["dispatching_base_num", "pickup_datetime", "dropOff_datetime", "PUlocationID",
            "DOlocationID", "SR_Flag", "Affiliated_base_number"]


def _raw_select(service: str) -> str:
    common = {
        "VendorID": f"{_VENDOR}",
        "store_and_fwd_flag": "l_linestatus",
        "RatecodeID": "CAST(l_linenumber AS VARCHAR)",
        "PULocationID": "CAST(c_nationkey AS VARCHAR)",
        "DOLocationID": "CAST(s_nationkey AS VARCHAR)",
        "passenger_count": "CAST(l_quantity AS BIGINT)",
        "payment_type": "CAST(l_linenumber AS BIGINT)",
        "trip_type": "CAST((l_linenumber % 2) + 1 AS VARCHAR)",
        "lpep_pickup_datetime": "o_orderdate", "lpep_dropoff_datetime": "l_shipdate",
        "tpep_pickup_datetime": "o_orderdate", "tpep_dropoff_datetime": "l_shipdate",
        **_AMOUNTS,
    }
    if service == "fhv":
        exprs = {
            "dispatching_base_num": _VENDOR,
            "pickup_datetime": "o_orderdate",
            "dropOff_datetime": "l_shipdate",
            "PUlocationID": "CAST(c_nationkey AS BIGINT)",
            "DOlocationID": "CAST(s_nationkey AS BIGINT)",
            "SR_Flag": "CAST(CASE WHEN l_linestatus = 'O' THEN NULL ELSE 1 END AS BIGINT)",
            "Affiliated_base_number": "CAST(NULLIF(l_partkey % 40, 0) AS VARCHAR)",
        }
        cols, flag = FHV_COLS, "N"
    else:
        exprs = common
        cols, flag = (GREEN_COLS, "A") if service == "green" else (YELLOW_COLS, "R")
    sel = ",\n    ".join(f"{exprs[c]} AS {c}" for c in cols)
    return f"SELECT\n    {sel}\n  FROM trip_base WHERE l_returnflag = '{flag}'"


def _order_all(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def _payment_case(c: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in PAYMENTS)
    return f"CASE TRY_CAST({c} AS INTEGER) {whens} ELSE 'EMPTY' END"


def surrogate(*cols) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '{NULL_TOKEN}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00')"


def _taxi_stg(raw: str, cols, pickup: str, dropoff: str, trip_type: str, ehail: str) -> str:
    return f"""SELECT
    {surrogate('VendorID', pickup)} AS tripid,
    TRY_CAST(VendorID AS BIGINT) AS vendorid,
    TRY_CAST(RatecodeID AS BIGINT) AS ratecodeid,
    TRY_CAST(PULocationID AS BIGINT) AS pickup_locationid,
    TRY_CAST(DOLocationID AS BIGINT) AS dropoff_locationid,
    {pickup} AS pickup_datetime,
    {dropoff} AS dropoff_datetime,
    store_and_fwd_flag,
    TRY_CAST(passenger_count AS BIGINT) AS passenger_count,
    CAST(trip_distance AS {_N}) AS trip_distance,
    {trip_type} AS trip_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    {ehail} AS ehail_fee,
    improvement_surcharge, total_amount,
    COALESCE(TRY_CAST(payment_type AS BIGINT), 0) AS payment_type,
    {_payment_case('payment_type')} AS payment_type_description
  FROM (SELECT *, row_number() OVER (PARTITION BY VendorID, {pickup}
                                     ORDER BY {_order_all(cols)}) AS rn
        FROM {raw} WHERE VendorID IS NOT NULL) d
  WHERE rn = 1"""


def _stg_fhv(year_pred: str) -> str:
    return f"""SELECT
    CAST(dispatching_base_num AS VARCHAR) AS dispatchid,
    TRY_CAST(PUlocationID AS BIGINT) AS pickup_locationid,
    TRY_CAST(DOlocationID AS BIGINT) AS dropoff_locationid,
    pickup_datetime,
    dropOff_datetime AS dropoff_datetime,
    TRY_CAST(SR_Flag AS BIGINT) AS sr_flag
  FROM fhv_raw {year_pred}"""


FACT_COLS_SQL = """t.tripid, t.vendorid, t.service_type, t.ratecodeid, t.pickup_locationid,
    pz.borough AS pickup_borough, pz.zone AS pickup_zone, t.dropoff_locationid,
    dz.borough AS dropoff_borough, dz.zone AS dropoff_zone, t.pickup_datetime,
    t.dropoff_datetime, t.store_and_fwd_flag, t.passenger_count, t.trip_distance, t.trip_type,
    t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount, t.ehail_fee,
    t.improvement_surcharge, t.total_amount, t.payment_type, t.payment_type_description"""

FHV_FACT_COLS_SQL = """f.dispatchid, f.service_type, f.pickup_datetime, f.pickup_locationid,
    pz.borough AS pickup_borough, pz.zone AS pickup_zone, f.dropoff_datetime,
    f.dropoff_locationid, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone, f.sr_flag"""


_REGISTERED: dict[str, tuple[str, list[str]]] = {}


def register_cte(name: str, body: str, *deps: str) -> None:
    """Add a named CTE (with the CTEs it reads) for later statements."""
    _REGISTERED[name] = (body, list(deps))


def ctes(p: dict) -> dict[str, tuple[str, list[str]]]:
    """CTE name → (body, dependencies).  ``p`` holds the query parameters."""
    fy = p["fhv_year"]
    return {**_base_ctes(p, fy), **_REGISTERED}


def _base_ctes(p: dict, fy) -> dict[str, tuple[str, list[str]]]:
    return {
        "trip_base": ("""SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
    l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
    o.o_orderdate, c.c_nationkey, s.s_nationkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey""", []),
        "green_raw": (_raw_select("green"), ["trip_base"]),
        "yellow_raw": (_raw_select("yellow"), ["trip_base"]),
        "fhv_raw": (_raw_select("fhv"), ["trip_base"]),
        "zone_seed": ("""SELECT CAST(n_nationkey AS BIGINT) AS locationid,
    CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS borough,
    n_name AS zone,
    CASE WHEN r_name = 'MIDDLE EAST' THEN 'N/A' WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey""", []),
        "dim_zones": ("SELECT locationid, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone FROM zone_seed", ["zone_seed"]),
        "kz": ("SELECT * FROM dim_zones WHERE borough != 'Unknown'", ["dim_zones"]),
        "stg_green": (_taxi_stg("green_raw", GREEN_COLS, "lpep_pickup_datetime", "lpep_dropoff_datetime",
                                "TRY_CAST(trip_type AS BIGINT)", f"CAST(ehail_fee AS {_N})"), ["green_raw"]),
        "stg_yellow": (_taxi_stg("yellow_raw", YELLOW_COLS, "tpep_pickup_datetime", "tpep_dropoff_datetime",
                                 "CAST(1 AS BIGINT)", f"CAST(0 AS {_N})"), ["yellow_raw"]),
        "stg_fhv": (_stg_fhv(f"WHERE extract(year FROM pickup_datetime) = {fy}"), ["fhv_raw"]),
        "trips_unioned": ("SELECT *, 'Green' AS service_type FROM stg_green UNION ALL "
                          "SELECT *, 'Yellow' AS service_type FROM stg_yellow", ["stg_green", "stg_yellow"]),
        "fact_trips": (f"""SELECT {FACT_COLS_SQL}
  FROM trips_unioned t
  JOIN kz pz ON t.pickup_locationid = pz.locationid
  JOIN kz dz ON t.dropoff_locationid = dz.locationid""", ["trips_unioned", "kz"]),
        "fact_fhv_trips": (f"""SELECT {FHV_FACT_COLS_SQL}
  FROM (SELECT *, 'Fhv' AS service_type FROM stg_fhv) f
  JOIN kz pz ON f.pickup_locationid = pz.locationid
  JOIN kz dz ON f.dropoff_locationid = dz.locationid""", ["stg_fhv", "kz"]),
    }


def sql(final: str, needs, p: dict) -> str:
    """Prepend the CTEs ``final`` needs (transitively), in dependency order."""
    defs = ctes(p)
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in defs[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n  {defs[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def r6(c: str, alias: str | None = None) -> str:
    return f"ROUND(CAST({c} AS DOUBLE), 6) AS {alias or c}"


money = r6
