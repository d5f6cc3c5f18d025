"""Daily analysis: one day of events to five facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import checked_date
from ..operators.cube import event_cube
from ..operators.grain import session_grain
from ..operators.locations import stats_device_location
from ..operators.products import area_top3_product
from ..operators.sessions import session_aggr_stat
from ..operators.users import stats_user
from ..schemas import ALL
from ..sinks.tables import replace_day
from ..sources.event_table import read_event_day
from . import facts


def _places(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select("country", "province", "city") for f in frames]).distinct()


def run_daily(spark: SparkSession, date: str, warehouse: str) -> None:
    """Write all facts of one day; running it again replaces them.

    The day's events without copies, and the session grain, are written once and read back, so that the three analyses
    on it neither repeat the scan and shuffle of raw events nor depend on cached blocks
    that go with a lost executor. The fact inputs are small and stored the same way.
    """
    day = checked_date(date)
    stage = f"{warehouse}/stage/dt={day}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{stage}/{name}")
        return spark.read.schema(df.schema).parquet(f"{stage}/{name}")

    events = stored(read_event_day(spark, f"{warehouse}/events", date), "events")
    grain = stored(session_grain(events), "grain")
    sessions = stored(session_aggr_stat(grain), "sessions")
    users = stored(stats_user(grain), "users")
    places = stored(stats_device_location(grain), "places")
    top = stored(area_top3_product(events), "top")
    stored(event_cube(events), "event_cube")

    one_day = spark.range(1).select(F.lit(day).alias("dt"))
    dims = facts.refresh_dimensions(
        spark,
        warehouse,
        one_day,
        reduce(DataFrame.unionByName, [f.select("pl") for f in (sessions, users, places)]).distinct(),
        _places(places, top.withColumn("city", F.lit(ALL))),
    )
    date_id = dims.date.filter((F.col("calendar") == date) & (F.col("type") == "day")).first()["id"]
    replace_day(facts.session_aggr_fact(sessions, dims), f"{warehouse}/session_aggr_stat", date_id)
    replace_day(facts.user_fact(users, dims), f"{warehouse}/stats_user", date_id)
    replace_day(facts.device_location_fact(places, dims), f"{warehouse}/stats_device_location", date_id)
    replace_day(facts.top_product_fact(top, dims), f"{warehouse}/area_top3_product", date_id)
    counts = spark.read.parquet(f"{stage}/event_cube").withColumn("date_dimension_id", F.lit(date_id)).drop("dt")
    replace_day(counts, f"{warehouse}/event_cube", date_id)
