"""Registered queries: each reads whole tables under ``sf_dir`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import dates, ip, packed, text
from ..operators import (
    cube, dedup, dims, grain, locations, parse, products, regions, sessions, upsert, users, visits, wordcount,
)
from ..operators.rollup import LEVEL, fan_out
from ..schemas import ALL
from ..session import fresh_dir, pin_utc, written_once
from ..sinks import event_store
from ..sources import derived, event_table
from ..sources.ip_rules import rule_columns
from . import facts
from .etl import located_events, stored_columns
from .sql_reports import area_top3_product_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VISIT_GAP_MS = 18 * 60 * 1000
FLOW_BATCH_MS = 60_000


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _text_date(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns or ("dt",)})


def _grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grain.session_grain(derived.weblog(spark, sf_dir))


# --- sources and parsing -----------------------------------------------------

@query
def ip_rules(spark, sf_dir):
    return rule_columns(derived.rule_lines(derived.ip_rules(spark, sf_dir)))


@query
def parse_log(spark, sf_dir):
    events = located_events(derived.raw_lines(spark, sf_dir), derived.ip_rules(spark, sf_dir))
    return events.select("ip", "access_time", "country", "province", "city", "uid", "sid", "en", "pl", "pid",
                         F.element_at("params", F.lit("tt")).alias("tt"),
                         F.size(F.map_keys("params")).alias("n_params"))


@query
def bad_records(spark, sf_dir):
    bad = parse.bad_records(parse.parse_lines(derived.raw_lines(spark, sf_dir)))
    return bad.groupBy("reason").agg(F.count("*").alias("n"))


@query
def parse_params(spark, sf_dir):
    """Query parameters of every crawled page address."""
    pages = derived.load(spark, sf_dir, "pages").select("page_id", text.query_text(F.col("url")).alias("query"))
    params = text.last_value_map(F.col("keys"), F.col("vals"), ~F.col("bad_escape"))
    return parse.with_pairs(pages).select("page_id", F.explode(params).alias("name", "val"))


@query
def ip_to_long(spark, sf_dir):
    v = derived.visits(spark, sf_dir)
    return v.select("event_id", "ip", ip.ip_to_long(F.col("ip")).alias("ip_number"))


@query
def ip_region(spark, sf_dir):
    w = derived.weblog(spark, sf_dir)
    return w.select("event_id", "ip", "country", "province", "city")


@query
def ip_region_wide(spark, sf_dir):
    """Rules over several slices each, broadcast."""
    v = derived.visits(spark, sf_dir).select("event_id", "ip_num")
    return regions.resolve_regions(v, derived.wide_ip_rules(spark, sf_dir)).drop("ip_num")


@query
def ip_region_by_shuffle(spark, sf_dir):
    """The same beyond the limit of a broadcast: distinct addresses meet the rules."""
    v = derived.visits(spark, sf_dir).select("event_id", "ip_num")
    return regions.resolve_regions(v, derived.wide_ip_rules(spark, sf_dir), broadcast_bytes=0).drop("ip_num")


@query
def event_day_scan(spark, sf_dir):
    """All events into a store as two loads, and one day read from it."""
    events = derived.stored_events(spark, sf_dir)
    base = fresh_dir(spark, "events")
    for k in range(2):
        event_store.replace_load(stored_columns(events.filter(F.col("event_id") % 2 == k)), base, "etl", f"half-{k}")
    day = event_table.read_event_day(spark, base, "2024-01-15")
    return day.select("uid", "sid", "access_time", "en", "country", "province", "city", "pl", "pid")


@query
def event_dedup(spark, sf_dir):
    rows = dedup.dedup_events(derived.weblog_dup(spark, sf_dir))
    return rows.select("access_time", "uid", "en", "sid", "pl", "pid", "ip", "ingest_seq")


@query
def date_ops(spark, sf_dir):
    v = derived.visits(spark, sf_dir)
    day = dates.event_date(F.col("access_time"))
    return v.select(
        "event_id",
        dates.format_epoch(F.col("access_time"), "yyyy/MM/dd").alias("day_path"),
        F.date_format(dates.next_day(day), "yyyy-MM-dd").alias("next_day"),
        dates.parse_epoch(F.date_format(day, "yyyy-MM-dd"), "yyyy-MM-dd").alias("day_ms"),
        dates.day_start(dates.next_day(day)).alias("next_day_ms"),
    )


@query
def date_dimension(spark, sf_dir):
    """Calendar of all order days, with ids."""
    days = derived.load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dt"))
    return dims.assign_ids(dims.date_dimension(days), dims.DATE_KEY)


@query
def valid_date(spark, sf_dir):
    """Real order dates with the day, month or year moved, so that many leave the calendar."""
    key = F.col("o_orderkey")
    moved = F.concat_ws(
        "-",
        F.when(key % 11 == 0, "0000").when(key % 13 == 0, "2000").otherwise(F.date_format("o_orderdate", "yyyy")),
        F.when(key % 3 == 0, F.lpad((key % 14).cast("string"), 2, "0")).otherwise(F.date_format("o_orderdate", "MM")),
        F.when(key % 2 == 0, F.lpad((key % 33).cast("string"), 2, "0"))
        .when(key % 17 == 0, "1").otherwise(F.date_format("o_orderdate", "dd")),
    )
    orders = derived.load(spark, sf_dir, "orders").select("o_orderkey", moved.alias("day_text"))
    return orders.select("o_orderkey", "day_text", dates.is_valid_date(F.col("day_text")).cast("int").alias("valid"))


@query
def ua_class(spark, sf_dir):
    v = derived.visits(spark, sf_dir)
    agent = F.concat(
        F.lit("Mozilla/5.0 ("),
        F.when(F.col("pl") == "android", "Linux; Android 13")
        .when(F.col("pl") == "ios", F.when(F.col("event_id") % 2 == 0, "iPhone; CPU OS 17").otherwise("iPad; CPU OS 17"))
        .otherwise("X11; Linux x86_64"),
        F.lit(") r/"), F.col("event_id").cast("string"),
    )
    named = v.select("event_id", agent.alias("b_usa"))
    return named.select("event_id", "b_usa", text.device_class(F.col("b_usa")).alias("device"))


# --- session grain and what follows from it -----------------------------------

@query
def session_grain(spark, sf_dir):
    return _text_date(_grain(spark, sf_dir))


@query
def session_metrics(spark, sf_dir):
    return _text_date(sessions.session_metrics(_grain(spark, sf_dir)))


@query
def session_hist(spark, sf_dir):
    return _text_date(sessions.session_histogram(sessions.session_metrics(_grain(spark, sf_dir))))


@query
def session_aggr_stat(spark, sf_dir):
    return _text_date(sessions.session_aggr_stat(_grain(spark, sf_dir)))


@query
def session_hist_packed(spark, sf_dir):
    hist = sessions.session_histogram(sessions.session_metrics(_grain(spark, sf_dir)))
    return _text_date(sessions.histogram_packed(hist))


@query
def packed_fields(spark, sf_dir):
    """Counters read back from the packed text, one of them overwritten first."""
    hist = sessions.session_histogram(sessions.session_metrics(_grain(spark, sf_dir)))
    texts = sessions.histogram_packed(hist).withColumn("packed", packed.set_field(F.col("packed"), "60", F.lit(-1)))
    fields = packed.unpack_fields(F.col("packed"))
    return _text_date(texts.select(
        "dt", "pl", LEVEL,
        packed.get_field(F.col("packed"), "session_count").cast("bigint").alias("session_count"),
        packed.get_field(F.col("packed"), "60").cast("bigint").alias("step_60"),
        *[F.element_at(fields, F.lit(name)).cast("bigint").alias(column)
          for column, (name, _, _) in sessions.BUCKETS.items() if column != "step_60"],
    ))


@query
def stats_user(spark, sf_dir):
    return _text_date(users.stats_user(_grain(spark, sf_dir)))


@query
def stats_user_all_views(spark, sf_dir):
    return _text_date(users.stats_user(_grain(spark, sf_dir), views="all"))


@query
def stats_device_location(spark, sf_dir):
    return _text_date(locations.stats_device_location(_grain(spark, sf_dir)))


@query
def location_flow(spark, sf_dir):
    return _text_date(locations.location_flow(_grain(spark, sf_dir)))


@query
def event_cube(spark, sf_dir):
    return _text_date(cube.event_cube(derived.weblog(spark, sf_dir)))


# --- products ------------------------------------------------------------------

@query
def product_area_count(spark, sf_dir):
    return _text_date(products.product_area_count(derived.weblog(spark, sf_dir)))


@query
def city_concat(spark, sf_dir):
    return _text_date(products.city_concat(products.product_area_count(derived.weblog(spark, sf_dir))))


@query
def area_top3_product(spark, sf_dir):
    """From raw lines: parse, locate, count and rank."""
    events = located_events(derived.raw_lines(spark, sf_dir), derived.ip_rules(spark, sf_dir))
    return _text_date(products.area_top3_product(events))


@query
def topk_per_group(spark, sf_dir):
    """Five most active users of each day."""
    v = derived.visits(spark, sf_dir)
    per_user = v.groupBy(dates.event_date(F.col("access_time")).alias("dt"), "uid").agg(F.count("*").alias("n"))
    return _text_date(products.topk_per_group(per_user, ["dt"], 5, F.desc("n"), F.asc("uid")))


@query
def sql_surface(spark, sf_dir):
    return _text_date(area_top3_product_sql(derived.weblog(spark, sf_dir)))


# --- sessions from bare events ---------------------------------------------------

@query
def sessionize(spark, sf_dir):
    v = derived.visits(spark, sf_dir).select("event_id", "uid", "access_time", "en")
    return visits.sessionize(v, gap_ms=VISIT_GAP_MS).select("event_id", "uid", "access_time", "session_no")


@query
def sessionize_page_opened(spark, sf_dir):
    v = derived.visits(spark, sf_dir).select("event_id", "uid", "access_time", "en")
    opened = visits.sessionize(v, gap_ms=VISIT_GAP_MS, openers=["e_pv", "e_l"])
    return opened.select("event_id", "uid", "access_time", "session_no")


@query
def session_summary(spark, sf_dir):
    v = derived.visits(spark, sf_dir).select("event_id", "uid", "access_time", "en")
    return visits.session_summary(v)


@query
def first_visit(spark, sf_dir):
    v = derived.visits(spark, sf_dir)
    return visits.first_visit(v).select("uid", "event_id", "access_time", "en", "pl")


# --- words -----------------------------------------------------------------------

@query
def word_count(spark, sf_dir):
    return wordcount.word_count(derived.load(spark, sf_dir, "documents").select("text"), "text")


# --- dimensions and facts ----------------------------------------------------------

@query
def dim_platform(spark, sf_dir):
    labels = fan_out(derived.visits(spark, sf_dir).select("pl").distinct(), ["pl"], users.LEVELS)
    return dims.assign_ids(labels.select(F.col("pl").alias("platform_name")).distinct(), dims.PLATFORM_KEY)


@query
def dim_location(spark, sf_dir):
    placed = derived.weblog(spark, sf_dir).select("country", "province", "city").distinct()
    return dims.assign_ids(placed, dims.LOCATION_KEY)


def _dimensions(stat: DataFrame, platforms: bool = True, city: str | None = "city") -> facts.Dimensions:
    """Ids for the keys of one statistic, starting from empty dimension tables."""
    spark = stat.sparkSession
    named = stat.select(F.col("pl").alias("platform_name")).distinct() if platforms else (
        spark.createDataFrame([], "platform_name string"))
    if city is None:
        placed = spark.createDataFrame([], "country string, province string, city string")
    else:
        placed = stat.select("country", "province", (F.col(city) if city == "city" else F.lit(city)).alias("city"))
    return facts.Dimensions(
        dims.assign_ids(dims.date_dimension(stat), dims.DATE_KEY),
        dims.assign_ids(named, dims.PLATFORM_KEY),
        dims.assign_ids(placed.distinct(), dims.LOCATION_KEY),
    )


@query
def fact_session_aggr_stat(spark, sf_dir):
    stat = written_once(sessions.session_aggr_stat(_grain(spark, sf_dir)))
    return facts.session_aggr_fact(stat, _dimensions(stat, city=None))


@query
def fact_stats_user(spark, sf_dir):
    stat = written_once(users.stats_user(_grain(spark, sf_dir)))
    return facts.user_fact(stat, _dimensions(stat, city=None))


@query
def fact_stats_device_location(spark, sf_dir):
    stat = written_once(locations.stats_device_location(_grain(spark, sf_dir)))
    return facts.device_location_fact(stat, _dimensions(stat))


@query
def fact_area_top3_product(spark, sf_dir):
    stat = written_once(products.area_top3_product(derived.weblog(spark, sf_dir)))
    return facts.top_product_fact(stat, _dimensions(stat, platforms=False, city=ALL))


@query
def fact_stats_location_flow(spark, sf_dir):
    stat = written_once(locations.location_flow(_grain(spark, sf_dir)))
    return facts.flow_fact(stat, _dimensions(stat, platforms=False))


@query
def flow_upsert_latest(spark, sf_dir):
    """Views and launches per day and platform, rewritten by one batch per minute."""
    v = derived.visits(spark, sf_dir)
    batch = F.call_function("div", F.col("access_time"), F.lit(FLOW_BATCH_MS))
    per_batch = v.groupBy(dates.event_date(F.col("access_time")).alias("dt"), "pl", batch.alias("batch_id")).agg(
        F.count_if(F.col("en") == "e_l").alias("nu"), F.count_if(F.col("en").isin("e_pv", "e_bp")).alias("pv")
    )
    upto = Window.partitionBy("dt", "pl").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    log = per_batch.select(
        "dt", "pl", "batch_id", F.sum("nu").over(upto).alias("nu"), F.sum("pv").over(upto).alias("pv"),
        F.concat(F.lit("batch "), F.col("batch_id").cast("string")).alias("created"),
    )
    return _text_date(upsert.latest_flow(log, ["dt", "pl"]))
