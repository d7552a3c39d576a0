"""Distances between customers and sellers, and what regions buy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchweave.functions.scalars import round_half_even
from merchweave.operators.cleaning import LATITUDES, LONGITUDES

EARTH_KM = 6371.0
BANDS = (100, 500, 1000, 2500, 5000)  # km


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance over a sphere; NULL if a coordinate is."""
    dlat, dlng = F.radians(lat2 - lat1) / 2, F.radians(lng2 - lng1) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlng) * F.sin(dlng)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def zip_centroids(points: DataFrame) -> DataFrame:
    """(zip, lat, lng): the mean of a zip prefix's points inside the valid box, summed exactly."""
    inside = F.col("geolocation_lat").between(*LATITUDES) & F.col("geolocation_lng").between(*LONGITUDES)

    def mean(c: str) -> Column:
        return F.sum(F.col(c).cast("decimal(12,6)")).cast("double") / F.count(c)

    return (
        points.filter(inside)
        .groupBy(F.col("geolocation_zip_code_prefix").alias("zip"))
        .agg(mean("geolocation_lat").alias("lat"), mean("geolocation_lng").alias("lng"))
    )


def band(km: Column, bounds: Sequence[int] = BANDS) -> Column:
    """The distance's band, such as ``500-1000``; ``unknown`` without a distance."""
    out, low = F.when(km.isNull(), "unknown"), 0
    for high in bounds:
        out, low = out.when(km < high, f"{low}-{high}"), high
    return out.otherwise(f"{low}+")


def distance_bands(items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame, points: DataFrame) -> DataFrame:
    """(customer_state, distance_band, n_lines, mean_km): how far order lines travel.

    Lines are counted per pair of zip prefixes first, so the distance is computed once for each pair.
    """
    people = customers.select("customer_id", "customer_state", F.col("customer_zip_code_prefix").alias("to_zip"))
    shops = sellers.select("seller_id", F.col("seller_zip_code_prefix").alias("from_zip"))
    pairs = (
        items.select("order_id", "seller_id")
        .join(orders.select("order_id", "customer_id"), "order_id")
        .join(people, "customer_id")
        .join(shops, "seller_id")
        .groupBy("customer_state", "to_zip", "from_zip")
        .agg(F.count("*").alias("n"))
    )
    where = zip_centroids(points)
    here = where.select(F.col("zip").alias("to_zip"), F.col("lat").alias("lat1"), F.col("lng").alias("lng1"))
    there = where.select(F.col("zip").alias("from_zip"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"))
    km = round_half_even(haversine_km(F.col("lat1"), F.col("lng1"), F.col("lat2"), F.col("lng2")), 3)
    far = pairs.join(here, "to_zip", "left").join(there, "from_zip", "left").withColumn("km", km)
    return (
        far.groupBy("customer_state", band(F.col("km")).alias("distance_band"))
        .agg(
            F.sum("n").alias("n_lines"),
            # Metres as whole numbers, so that the order of the sum does not matter.
            round_half_even(
                F.try_divide(F.sum(F.rint(F.col("km") * 1000).cast("long") * F.col("n")), F.sum("n")) / 1000, 3
            ).alias("mean_km"),
        )
    )


def regional_preferences(lines: DataFrame, region: str, category: str) -> DataFrame:
    """Each region's categories by lines: rank, share of the region, and the share over the share of all regions."""
    counts = lines.select(region, category).dropna().groupBy(region, category).agg(F.count("*").alias("n_lines"))
    by_region, by_category = W.partitionBy(region), W.partitionBy(category)
    # One row per region and category from here on.
    total = counts.agg(F.sum("n_lines")).scalar().cast("double")
    n = F.col("n_lines").cast("double")
    share, overall = n / F.sum("n_lines").over(by_region), F.sum("n_lines").over(by_category) / total
    return counts.select(
        region,
        category,
        "n_lines",
        F.row_number().over(by_region.orderBy(F.desc("n_lines"), category)).alias("rank"),
        round_half_even(share, 9).alias("region_share"),
        round_half_even(share / overall, 9).alias("preference"),
    )
