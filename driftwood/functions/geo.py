"""Great-circle distance as a native Column expression (usable as a FeatureFunction)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine(latitude: Column, longitude: Column, user_latitude: Column, user_longitude: Column) -> Column:
    """Distance in km between (latitude, longitude) and (user_latitude, user_longitude), degrees in."""
    lat1, lon1 = F.radians(latitude), F.radians(longitude)
    lat2, lon2 = F.radians(user_latitude), F.radians(user_longitude)
    a = (F.pow(F.sin((lat2 - lat1) / 2), 2)
         + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2))
    return F.lit(EARTH_RADIUS_KM) * F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def register_haversine_sql(spark: SparkSession, name: str = "haversine_km") -> str:
    """Same formula as a SQL temporary function, so ``spark.sql`` users can call it."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(latitude DOUBLE, longitude DOUBLE,
                                                  user_latitude DOUBLE, user_longitude DOUBLE)
        RETURNS DOUBLE
        RETURN {EARTH_RADIUS_KM} * 2 * atan2(
            sqrt(pow(sin((radians(user_latitude) - radians(latitude)) / 2), 2)
                 + cos(radians(latitude)) * cos(radians(user_latitude))
                 * pow(sin((radians(user_longitude) - radians(longitude)) / 2), 2)),
            sqrt(1 - (pow(sin((radians(user_latitude) - radians(latitude)) / 2), 2)
                 + cos(radians(latitude)) * cos(radians(user_latitude))
                 * pow(sin((radians(user_longitude) - radians(longitude)) / 2), 2))))""")
    return name
