"""Dimension joins (J1, J2) and the union of services.

The zone dimension is joined twice (pickup and dropoff roles).  It is
broadcast where its measured bytes are under the session's threshold; otherwise
Catalyst and AQE pick a shuffle join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.operators.filters import known_zones

def role_zone(zones: DataFrame, role: str) -> DataFrame:
    """Zone columns renamed for one role: ``<role>_borough``, ``<role>_zone``."""
    return zones.select(F.col("locationid").alias(f"_{role}_zone_id"),
                        F.col("borough").alias(f"{role}_borough"),
                        F.col("zone").alias(f"{role}_zone"))


def join_pickup_zone(trips: DataFrame, zones: DataFrame, only_known: bool = True,
                     _checked: DataFrame | None = None) -> DataFrame:
    """Inner join on the pickup zone; unknown or null locations drop out."""
    dim = _checked if _checked is not None else (known_zones(zones) if only_known else zones)
    pz = role_zone(dim, "pickup")
    return (trips.join(pz, trips["pickup_locationid"] == pz["_pickup_zone_id"], "inner")
                 .drop("_pickup_zone_id"))


def with_zones(trips: DataFrame, zones: DataFrame, only_known: bool = True) -> DataFrame:
    """Inner joins on both pickup and dropoff zones (role-playing dimension)."""
    dim = known_zones(zones) if only_known else zones
    out = join_pickup_zone(trips, zones, only_known, _checked=dim)
    dz = role_zone(dim, "dropoff")
    return (out.join(dz, out["dropoff_locationid"] == dz["_dropoff_zone_id"], "inner")
               .drop("_dropoff_zone_id"))


def union_services(*dfs: DataFrame) -> DataFrame:
    """UNION ALL matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)
