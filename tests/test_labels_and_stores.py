"""Data that reads like a total's label, and one event store for load, stream and daily analysis."""

import os

from pyspark.sql import functions as F

from sessionloom.operators import cube, grain, locations, sessions, users
from sessionloom.plans.daily import run_daily
from sessionloom.plans.etl import run_etl
from sessionloom.schemas import table
from sessionloom.sinks import batchlog, tables
from sessionloom.sources.ip_rules import read_ip_rules
from sessionloom.sources.streams import text_lines
from sessionloom.streaming.events import start_event_load
from sessionloom.streaming.landing import start_landing

from conftest import rows

EVENTS = "access_time long, uid string, sid string, en string, pl string, country string, province string, city string"
T = 1_556_199_190_643


def test_a_value_called_all_is_no_total(spark):
    events = spark.createDataFrame([
        (T, "u1", "s1", "e_pv", "all", "C", "all", "all"), (T, "u1", "s1", "e_pv", "pc", "C", "P", "X"),
        (T, None, None, "e_l", None, "C", "P", "all")], EVENTS)
    g = grain.session_grain(events)
    assert rows(users.stats_user(g), "pl", "level", "active_users", "session_count") == sorted(
        [("all", 0, 1, 1), ("all", 1, 2, 2), ("pc", 0, 1, 1), (None, 0, 1, 1)], key=repr)
    hist = sessions.session_histogram(sessions.session_metrics(g))
    assert rows(hist, "pl", "session_count") == sorted([("all", 1), ("all", 2), ("pc", 1), (None, 1)], key=repr)
    assert rows(cube.event_cube(events).filter("en = 'e_pv'"), "pl", "level", "event_count") == [
        ("all", 0, 1), ("all", 2, 2), ("pc", 0, 1)]
    flow = locations.location_flow(g)
    assert rows(flow, "province", "city", "uv", "on") == [
        ("P", "X", 1, 1), ("P", "all", 1, 1), ("P", "all", 2, 2), ("all", "all", 1, 1), ("all", "all", 1, 1),
        ("all", "all", 2, 1)]


def prepared(tmp_path):
    os.makedirs(f"{tmp_path}/in")
    with open(f"{tmp_path}/rules", "w") as out:
        out.write("x|y|16777216|16777471|a|C|P|X\n")
    with open(f"{tmp_path}/in/a.log", "w") as out:
        for k in range(6):
            out.write(f"1.0.0.{k % 2}|{T + k // 2}|h|/l?en=e_pv&uid=u{k % 3}&sid=s{k % 3}&pl=pc\n")
        out.write(f"1.0.0.1|{T}|h|/l?en=e_pv&uid=u0&sid=s0&pl=pc\n")
    return f"{tmp_path}/in", f"{tmp_path}/rules"


def test_stream_and_landed_load_give_the_same_facts(spark, tmp_path):
    source, rules = prepared(tmp_path)
    live, landed = f"{tmp_path}/live", f"{tmp_path}/landed"
    start_event_load(text_lines(spark, source), read_ip_rules(spark, rules), f"{live}/events", f"{tmp_path}/cp1",
                     None).awaitTermination()
    start_landing(text_lines(spark, source), f"{tmp_path}/raw", f"{tmp_path}/cp2", every=None).awaitTermination()
    today = spark.sql("select date_format(current_timestamp(), 'yyyy-MM-dd')").first()[0]
    run_etl(spark, today, f"{tmp_path}/raw", rules, landed, landed=True)
    found = []
    for warehouse in (live, landed):
        run_daily(spark, "2019-04-25", warehouse)
        found.append([rows(spark.read.parquet(f"{warehouse}/{fact}").drop("created"))
                      for fact in ("stats_user", "event_cube", "stats_device_location", "session_aggr_stat")])
    assert found[0] == found[1] and all(found[0])


def test_known_keys_write_no_file(spark, tmp_path):
    wanted = spark.createDataFrame([("pc",), ("ios",)], "platform_name string")
    path = f"{tmp_path}/dim"
    files = set()
    for _ in range(3):
        tables.refresh_dimension(spark, path, wanted, ["platform_name"])
        files.add(tuple(sorted(f for f in os.listdir(path) if f.startswith("part"))))
    assert len(files) == 1
    assert spark.read.parquet(path).select(F.countDistinct("id"), F.count("*")).first() == (2, 2)


def test_compaction_of_a_replayed_batch_is_left_alone(spark, tmp_path):
    schema = table(k="string", n="bigint")
    latest = lambda log: log.groupBy("k").agg(F.sum("n").alias("n"))
    for batch in range(3):
        batchlog.append_batch(spark.createDataFrame([("a", 1)], schema), f"{tmp_path}/log", batch)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for _ in range(2):
            batchlog.compact(spark, f"{tmp_path}/log", schema, 2, latest)
            assert rows(batchlog.read_log(spark, f"{tmp_path}/log", schema), "k", "n") == [("a", 3)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
