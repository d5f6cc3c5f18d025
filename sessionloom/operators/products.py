"""Product views per area and the top products of each province."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import event_date
from ..functions.text import not_blank
from ..schemas import PRODUCT_VIEW


def product_area_count(events: DataFrame) -> DataFrame:
    """Views per day, country, province, city and product; blank products are skipped."""
    return (
        events.filter((F.col("en") == PRODUCT_VIEW) & not_blank(F.col("pid")))
        .groupBy(event_date(F.col("access_time")).alias("dt"), "country", "province", "city",
                 F.col("pid").alias("product_id"))
        .agg(F.count("*").alias("browser_count"))
    )


def concat_sorted(c: Column) -> Column:
    """Aggregate: the values of a group in ascending order, comma separated."""
    return F.array_join(F.array_sort(F.collect_list(c)), ",")


def city_concat(area_counts: DataFrame) -> DataFrame:
    """Total views and city list per province and product.

    Its input holds a city once per product, so a list is as long as the number
    of cities of a province at most.
    """
    return area_counts.groupBy("dt", "country", "province", "product_id").agg(
        F.sum("browser_count").alias("browser_count"), concat_sorted(F.col("city")).alias("city_infos")
    )


def topk_per_group(df: DataFrame, keys: Sequence[str], k: int, *order: Column) -> DataFrame:
    """First ``k`` rows per group; the planner limits groups before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def area_top3_product(events: DataFrame, k: int = 3) -> DataFrame:
    """Most viewed products per day and province; equal counts go to the smaller product id."""
    totals = city_concat(product_area_count(events))
    top = topk_per_group(totals, ["dt", "country", "province"], k, F.desc("browser_count"), F.asc("product_id"))
    return top.drop("rank")
