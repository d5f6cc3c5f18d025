import os

import pytest
from pyspark.sql import functions as F

from sessionloom.__main__ import main
from sessionloom.functions.text import split_trimmed
from sessionloom.operators import dims
from sessionloom.operators.dedup import dedup_events
from sessionloom.operators.upsert import latest_flow
from sessionloom.plans.daily import run_daily
from sessionloom.plans.etl import run_etl
from sessionloom.session import pin_utc
from sessionloom.sinks.batchlog import append_batch, compact, read_log
from sessionloom.sinks.tables import refresh_dimension, replace_day
from sessionloom.schemas import table
from sessionloom.sources import derived, jdbc
from sessionloom.sources.event_table import read_event_day, stored_day
from sessionloom.sources.logs import MissingInput, read_day_logs, read_landed_day

from conftest import plan_of, rows


def write_lines(folder, lines, name="a.log"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")


def line(ms, uid="u1", en="e_pv", **more):
    query = "&".join(f"{k}={v}" for k, v in dict(en=en, uid=uid, sid="s1", pl="pc", **more).items())
    return f"1.0.0.1|{ms}|h|/log.gif?{query}"


D1, D2 = 1_556_150_400_000, 1_556_236_800_000  # 2019-04-25 and 26


@pytest.fixture
def place(tmp_path):
    (tmp_path / "ip.txt").write_text("a|b|16777216|16777471|n|C|P|X\n")
    return tmp_path


def etl(spark, place, date):
    run_etl(spark, date, f"{place}/logs", f"{place}/ip.txt", f"{place}/wh")


def test_day_logs(spark, place):
    write_lines(f"{place}/logs/2019/04/25", ["x", "y"])
    write_lines(f"{place}/logs/2019/04/25/hour=10", ["z"])
    assert rows(read_day_logs(spark, f"{place}/logs/", "2019-04-25"), "value") == [("x",), ("y",), ("z",)]


def test_missing_input_is_an_error(spark, place):
    with pytest.raises(MissingInput):
        read_day_logs(spark, f"{place}/logs", "2019-04-25")
    with pytest.raises(MissingInput):
        read_landed_day(spark, f"{place}/nothing", "2019-04-25")
    with pytest.raises(MissingInput):
        read_event_day(spark, f"{place}/nothing", "2019-04-25")
    with pytest.raises(ValueError):
        read_day_logs(spark, f"{place}/logs", "2019-02-30")


def test_dedup_keeps_the_last_whole_row(spark):
    table_ = spark.createDataFrame(
        [(1, "u", "e", "old", 1), (1, "u", "e", None, 2), (1, "u", "f", "x", 1), (1, "u", "e", "none", None)],
        "access_time bigint, uid string, en string, pl string, src_pos bigint")
    got = dedup_events(table_)
    assert rows(got, "en", "pl") == sorted([("e", None), ("f", "x")], key=repr)
    assert "WindowGroupLimit" in plan_of(got)


def test_load_is_idempotent_and_quarantines(spark, place):
    write_lines(f"{place}/logs/2019/04/25", [line(D1), line(D1), line(D1 + 5), line(D2 + 1), "1.x|1|h|/l?en=a&uid=b"])
    for _ in range(2):
        etl(spark, place, "2019-04-25")
        stored = spark.read.parquet(f"{place}/wh/events")
        assert rows(stored, "access_time", "city") == [(D1, "X"), (D1 + 5, "X"), (D2 + 1, "X")]
        assert rows(spark.read.parquet(f"{place}/wh/bad_records"), "reason") == [("bad_ip",)]


def test_day_scan_prunes_and_later_loads_win(spark, place):
    write_lines(f"{place}/logs/2019/04/25", [line(D1, pid="1"), line(D1 + 9), line(D2 + 1, pid="early")])
    write_lines(f"{place}/logs/2019/04/26", [line(D1, pid="2"), line(D2 + 1, pid="own"), line(D2 + 2)])
    write_lines(f"{place}/logs/2019/04/27", [line(D1, pid="3"), line(D1 + 1)])
    for day in ("2019-04-25", "2019-04-26", "2019-04-27"):
        etl(spark, place, day)
    first = read_event_day(spark, f"{place}/wh/events", "2019-04-25")
    assert rows(first, "access_time", "pid") == sorted([(D1, "3"), (D1 + 1, None), (D1 + 9, None)], key=repr)
    second = read_event_day(spark, f"{place}/wh/events", "2019-04-26")
    assert rows(second, "access_time", "pid") == sorted([(D2 + 1, "own"), (D2 + 2, None)], key=repr)
    assert "GreaterThanOrEqual(access_time" in plan_of(first)
    assert {f.split("/dt=")[1].split("/")[0] for f in stored_day(spark, f"{place}/wh/events", "2019-04-25").inputFiles()} == {
        "2019-04-25"}


def test_replace_day_also_with_nothing(spark, tmp_path):
    base = str(tmp_path / "fact")
    fact = spark.createDataFrame([(1, 10)], "date_dimension_id int, n int")
    for day in (1, 2):
        replace_day(fact.withColumn("date_dimension_id", F.lit(day)), base, day)
        replace_day(fact.withColumn("date_dimension_id", F.lit(day)), base, day)
    assert rows(spark.read.parquet(base), "date_dimension_id", "n") == [(1, 10), (2, 10)]
    replace_day(fact.limit(0), base, 1)
    assert rows(spark.read.parquet(base), "date_dimension_id", "n") == [(2, 10)]


def test_dimension_ids_are_stable_and_gapless(spark, tmp_path):
    path = str(tmp_path / "dim")
    key = dims.LOCATION_KEY
    places = lambda *xs: spark.createDataFrame(list(xs), "country string, province string, city string")
    first = refresh_dimension(spark, path, places(("B", "P", "X"), ("A", "Q", "Y"), ("A", "Q", "Y"), (None, "P", None)), key)
    before = rows(first, "id", *key)
    assert before == sorted([(1, None, "P", None), (2, "A", "Q", "Y"), (3, "B", "P", "X")], key=repr)
    again = refresh_dimension(spark, path, places(("A", "Q", "Y"), (None, "P", None)), key)
    assert rows(again, "id", *key) == before
    more = refresh_dimension(spark, path, places(("A", "A", "A"), ("B", "P", "X"), ("A", "Q", None)), key)
    assert rows(more, "id", *key) == sorted([*before, (4, "A", "A", "A"), (5, "A", "Q", None)], key=repr)


def test_ids_follow_the_key_order_across_parts(spark):
    names = [f"{a}{b}" for a in ("pc", "ios", "an", "é", "") for b in ("", "x", "droid")] + [None]
    frame = spark.createDataFrame([(n,) for n in names], "platform_name string")
    got = dict((r["platform_name"], r["id"]) for r in dims.assign_ids(frame, dims.PLATFORM_KEY, 7).collect())
    ordered = [None] + sorted((n for n in names if n is not None), key=lambda n: n.encode())
    assert got == {n: 8 + i for i, n in enumerate(ordered)}


def test_unknown_dimension_key_gives_null_and_null_key_matches(spark):
    dim = spark.createDataFrame([(1, None), (2, "pc")], "id int, platform_name string")
    facts = spark.createDataFrame([(None,), ("pc",), ("tv",)], "pl string")
    got = dims.with_dimension_id(facts, dim, {"platform_name": "pl"}, "pid")
    assert rows(got, "pl", "pid") == sorted([(None, 1), ("pc", 2), ("tv", None)], key=repr)


def test_upsert_log_replay_and_compaction(spark, tmp_path):
    path, schema = str(tmp_path / "log"), table(id="int", n="bigint", created="string")
    batch = lambda *xs: spark.createDataFrame(list(xs), schema)
    latest = lambda log: latest_flow(log, ["id"])
    view = lambda: rows(latest(read_log(spark, path, schema)), "id", "n", "created")
    assert read_log(spark, path, schema).count() == 0
    append_batch(batch((1, 10, "a"), (2, 20, "a")), path, 0)
    append_batch(batch((1, 11, "b")), path, 1)
    append_batch(batch((1, 12, "b")), path, 1)
    assert view() == [(1, 12, "a"), (2, 20, "a")]
    compact(spark, path, schema, 1, latest)
    append_batch(batch((2, 21, "c"), (3, 1, "c")), path, 2)
    assert view() == [(1, 12, "a"), (2, 21, "a"), (3, 1, "c")]


def test_jdbc_options():
    write = jdbc.jdbc_options("jdbc:x:y", "stats_user", user="u", password="p")
    assert write["dbtable"] == "stats_user" and write["user"] == "u" and "driver" not in write
    assert jdbc.range_options("id", 1, 100, 8) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}


def test_load_and_analysis_end_to_end(spark, place, sf_dir):
    """One day of the event table: log files, rule file, events, facts; twice, through the command line too."""
    pin_utc(spark)
    date = "2024-01-15"
    lines = derived.raw_lines(spark, sf_dir)
    day = lines.filter(F.get(split_trimmed(F.col("value"), "|"), F.lit(1)).try_cast("bigint").between(
        1_705_276_800_000, 1_705_363_199_999))
    day.write.text(f"{place}/logs/2024/01/15")
    derived.rule_lines(derived.ip_rules(spark, sf_dir)).coalesce(1).write.text(f"{place}/rules")
    run_etl(spark, date, f"{place}/logs", f"{place}/rules", f"{place}/wh")
    run_daily(spark, date, f"{place}/wh")
    names = ["session_aggr_stat", "stats_user", "stats_device_location", "area_top3_product", "event_cube"]
    facts = {n: rows(spark.read.parquet(f"{place}/wh/{n}")) for n in names}
    assert all(facts.values())
    assert {r[-1] for r in facts["stats_user"]} == {1}, "date_dimension_id"
    no_ids = [r for n in ("session_aggr_stat", "stats_device_location", "area_top3_product") for r in facts[n]
              if None in r[:3]]
    assert not no_ids
    users = spark.read.parquet(f"{place}/wh/stats_user")
    platforms = spark.read.parquet(f"{place}/wh/dimension_platform")
    everyone = users.join(platforms, users["platform_dimension_id"] == platforms["id"]).filter("platform_name = 'all'")
    events = spark.read.parquet(f"{place}/wh/events")
    assert everyone.first()["active_users"] == events.select("uid").distinct().count()
    main(["daily", date, "--warehouse", f"{place}/wh"])
    assert {n: rows(spark.read.parquet(f"{place}/wh/{n}")) for n in names} == facts
