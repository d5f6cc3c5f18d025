"""From aggregates to fact rows with dimension ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dims import (
    DATE_KEY, LOCATION_KEY, PLATFORM_KEY, date_dimension, with_dimension_id,
)
from ..operators.rollup import LEVEL
from ..operators.sessions import BUCKETS
from ..schemas import ALL
from ..sinks.tables import refresh_dimension


@dataclass
class Dimensions:
    date: DataFrame
    platform: DataFrame
    location: DataFrame


def refresh_dimensions(spark: SparkSession, base: str, days: DataFrame, platforms: DataFrame | None,
                       locations: DataFrame | None) -> Dimensions:
    """Give ids to all keys of this run. ``days`` has dt, ``platforms`` pl, ``locations`` the place columns."""
    date = refresh_dimension(spark, f"{base}/dimension_date", date_dimension(days), DATE_KEY)
    named = platforms.select(F.col("pl").alias("platform_name")) if platforms is not None else (
        spark.createDataFrame([], "platform_name string"))
    placed = locations if locations is not None else (
        spark.createDataFrame([], "country string, province string, city string"))
    return Dimensions(
        date,
        refresh_dimension(spark, f"{base}/dimension_platform", named, PLATFORM_KEY),
        refresh_dimension(spark, f"{base}/dimension_location", placed.select(*LOCATION_KEY), LOCATION_KEY),
    )


def _dated(df: DataFrame, dims: Dimensions) -> DataFrame:
    calendar = F.date_format("dt", "yyyy-MM-dd")
    named = df.withColumn("created", calendar)
    return with_dimension_id(named, dims.date, {"calendar": "created", "type": F.lit("day")}, "date_dimension_id")


def _on_platform(df: DataFrame, dims: Dimensions) -> DataFrame:
    return with_dimension_id(df, dims.platform, {"platform_name": "pl"}, "platform_dimension_id")


def _located(df: DataFrame, dims: Dimensions, city="city") -> DataFrame:
    return with_dimension_id(
        df, dims.location, {"country": "country", "province": "province", "city": city}, "location_dimension_id"
    )


def session_aggr_fact(stat: DataFrame, dims: Dimensions) -> DataFrame:
    return _on_platform(_dated(stat, dims), dims).select(
        "date_dimension_id", "platform_dimension_id", LEVEL, "session_count", *BUCKETS
    )


def user_fact(stat: DataFrame, dims: Dimensions) -> DataFrame:
    return _on_platform(_dated(stat, dims), dims).select(
        "date_dimension_id", "platform_dimension_id", LEVEL, "active_users", "new_install_users",
        "session_count", "session_length", "created",
    )


def device_location_fact(stat: DataFrame, dims: Dimensions) -> DataFrame:
    return _located(_on_platform(_dated(stat, dims), dims), dims).select(
        "date_dimension_id", "platform_dimension_id", "location_dimension_id", LEVEL,
        "active_users", "session_count", "bounce_sessions", "created",
    )


def top_product_fact(top: DataFrame, dims: Dimensions) -> DataFrame:
    """Provinces are stored as locations whose city is ``all``."""
    return _located(_dated(top, dims), dims, F.lit(ALL)).select(
        "date_dimension_id", "location_dimension_id",
        F.col("product_id").try_cast("bigint").alias("product_id"),
        F.col("browser_count").alias("browser_product_count"), "city_infos",
    )


def flow_fact(flow: DataFrame, dims: Dimensions) -> DataFrame:
    return _located(_dated(flow, dims), dims).select(
        "date_dimension_id", "location_dimension_id", LEVEL, "nu", "uv", "pv", "sn", "on", "created"
    )
