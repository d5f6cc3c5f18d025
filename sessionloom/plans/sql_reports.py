"""The product report as chained SQL views, for sessions that work in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.sql import register_functions


def area_top3_product_sql(events: DataFrame, prefix: str = "loom") -> DataFrame:
    """Same result as ``area_top3_product``; leaves its views behind for further queries."""
    spark = events.sparkSession
    register_functions(spark)
    events.createOrReplaceTempView(f"{prefix}_events")
    spark.sql(f"""
        SELECT event_date(access_time) AS dt, country, province, city, pid AS product_id, count(*) AS browser_count
        FROM {prefix}_events WHERE en = 'e_bp' AND not_blank(pid) GROUP BY ALL
    """).createOrReplaceTempView(f"{prefix}_area_counts")
    spark.sql(f"""
        SELECT dt, country, province, product_id, sum(browser_count) AS browser_count,
               listagg(city, ',') WITHIN GROUP (ORDER BY city) AS city_infos
        FROM {prefix}_area_counts GROUP BY dt, country, province, product_id
    """).createOrReplaceTempView(f"{prefix}_area_totals")
    return spark.sql(f"""
        SELECT dt, country, province, product_id, browser_count, city_infos FROM (
            SELECT *, row_number() OVER (PARTITION BY dt, country, province
                                         ORDER BY browser_count DESC, product_id) AS rank
            FROM {prefix}_area_totals)
        WHERE rank <= 3
    """)
