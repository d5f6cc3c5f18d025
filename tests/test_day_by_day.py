"""Late events, closed days, and runs that need one day: always what one run over everything gives."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from sessionloom.__main__ import main
from sessionloom.operators import dims, visits
from sessionloom.operators.grain import session_grain
from sessionloom.operators.locations import location_flow
from sessionloom.operators.upsert import latest_flow
from sessionloom.plans import visits as daily
from sessionloom.plans.etl import located_events
from sessionloom.schemas import table
from sessionloom.sinks import event_store, tables
from sessionloom.sinks.daylog import DayLog
from sessionloom.sources import streams
from sessionloom.sources.event_table import read_event_day
from sessionloom.streaming import events as live
from sessionloom.streaming import flow, sessions

from conftest import plan_of, rows

D, DAY = 1_556_150_400_000, 86_400_000  # 2019-04-25
EVENTS = "uid string, access_time long, en string"
FLOW = ["dt", "country", "province", "city", "level", "nu", "uv", "pv", "sn", "on"]
GAP = 120_000


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")
    stamp = 1_700_000_000 + len(os.listdir(folder))
    os.utime(f"{folder}/{name}", (stamp, stamp))


def line(ms, uid, sid="s", en="e_pv", more=""):
    return f"1.0.0.1|{D + ms}|h|/l?en={en}&uid={uid}&sid={sid}{more}"


@pytest.fixture
def rules(spark):
    return spark.createDataFrame([(1 << 24, (1 << 24) + 255, "C", "P", "X")],
                                 "start_ip bigint, end_ip bigint, country string, province string, city string")


def moments(seed, n=60):
    """Events of three users around three midnights, with pauses near the gap."""
    rng = random.Random(seed)
    return [(f"u{rng.randrange(3)}", D + rng.randrange(1, 4) * DAY + rng.randrange(-6, 6) * 70_000 + rng.choice([0, 1, GAP]),
             rng.choice(["e_pv", "e_s"])) for _ in range(n)]


def test_sessions_in_any_order_equal_the_batch(spark, tmp_path):
    found = sorted(set(moments(1)))
    everything = rows(visits.session_summary(spark.createDataFrame(found, EVENTS)), "uid", *visits.INTERVAL)
    for order in range(2):
        random.Random(order).shuffle(found)
        log = sessions.session_log(spark, f"{tmp_path}/s{order}", compact_every=3)
        for batch, at in enumerate(range(0, len(found), 12)):
            for _ in range(2 if batch % 2 else 1):  # every other batch is replayed
                sessions.repair_sessions(log, spark.createDataFrame(found[at:at + 12], EVENTS), batch)
        assert rows(sessions.stored_sessions(log), "uid", *visits.INTERVAL) == everything


def test_session_command_takes_late_lines(spark, tmp_path):
    put(f"{tmp_path}/in", "0.log", [line(0, "u"), line(200_000, "u"), line(5 * DAY, "v")])
    run = ["sessions", "--path", f"{tmp_path}/in", "--warehouse", f"{tmp_path}/wh", "--checkpoint", f"{tmp_path}/cp", "--once"]
    main(run)
    log = sessions.session_log(spark, f"{tmp_path}/wh/live_sessions")
    got = lambda: rows(sessions.stored_sessions(log), "uid", *visits.INTERVAL)
    assert got() == [("u", D, D, 1), ("u", D + 200_000, D + 200_000, 1), ("v", D + 5 * DAY, D + 5 * DAY, 1)]
    put(f"{tmp_path}/in", "1.log", [line(100_000, "u")])
    main(run)
    assert got() == [("u", D, D + 200_000, 3), ("v", D + 5 * DAY, D + 5 * DAY, 1)]


@pytest.mark.parametrize("openers", [None, ["e_pv"]])
def test_sessions_day_by_day_equal_one_run(spark, tmp_path, openers):
    found = sorted(set(moments(2)))
    events = spark.createDataFrame(found, EVENTS).cache()
    wh = str(tmp_path)
    event_store.replace_load(stored(events), f"{wh}/events", "etl", "all")
    for k in range(5):
        for _ in range(2 if k == 2 else 1):
            daily.run_sessions(spark, f"2019-04-{25 + k}", wh, openers=openers)
    closed = spark.read.schema(daily.OPEN).parquet(f"{wh}/sessions").select("uid", *visits.INTERVAL)
    left = daily.open_before(spark, f"{wh}/open_sessions", "2019-05-09")
    want = rows(visits.session_summary(events, openers=openers), "uid", *visits.INTERVAL)
    assert rows(closed.unionByName(left), "uid", *visits.INTERVAL) == want
    assert any(a // DAY != b // DAY for _, a, b, _ in want), "some session goes over midnight"


def stored(events):
    none = F.lit(None).cast("string")
    return events.select("*", *[none.alias(c) for c in (
        "ip", "country", "province", "city", "sid", "pl", "b_n", "pid", "os_n")])


def test_first_visits_day_by_day_equal_one_run(spark, tmp_path):
    found = sorted(set(moments(3)) | {("late", D + 3 * DAY + 5, "e_s")})
    events = spark.createDataFrame(found, EVENTS).cache()
    wh = str(tmp_path)
    event_store.replace_load(stored(events.unionByName(spark.createDataFrame([(None, D + DAY, "e")], EVENTS))),
                             f"{wh}/events", "etl", "all")
    for k in range(5):
        for _ in range(2 if k == 1 else 1):
            daily.run_first_visits(spark, f"2019-04-{25 + k}", wh, buckets=8)
    want = events.groupBy("uid").agg(F.min("access_time").alias("access_time"))
    assert rows(daily.first_visits(spark, wh), "uid", "access_time") == rows(want, "uid", "access_time")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        known = daily.first_visits(spark, wh)
        plan = plan_of(daily.new_users(read_event_day(spark, f"{wh}/events", "2019-04-28"), known, daily.checked_date("2019-04-28")))
        history = plan[:plan.index("known_uid")].count("Exchange"), plan.split("LeftAnti")[1].split("Bucketed: true")
        assert len(history[1]) == 2 and "Exchange" not in last_branch(plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def last_branch(plan):
    """The lines of the join's right side: those below it that stand under the last child."""
    lines = plan.splitlines()
    join = next(k for k, x in enumerate(lines) if "LeftAnti" in x)
    indent = lines[join].index("SortMergeJoin") if "SortMergeJoin" in lines[join] else lines[join].index("ShuffledHashJoin")
    right = max(k for k, x in enumerate(lines) if k > join and x.find("+- ") >= 0 and x.index("+- ") <= indent + 4)
    return "\n".join(lines[right:])


def run_flow(spark, base, rules, **kw):
    query = flow.start_flow(streams.text_lines(spark, f"{base}/in", 1), rules, f"{base}/flow_log", f"{base}/cp",
                            warehouse=str(base), every=None, **kw)
    query.awaitTermination()
    return query


def test_closed_days_leave_the_state_and_are_built_anew(spark, tmp_path, rules):
    base = str(tmp_path)
    for k in range(8):
        put(f"{base}/in", f"{k:02}.log", [line(k * DAY + j, f"u{j}", f"s{k}-{j % 2}", "e_l") for j in range(4)])
    query = run_flow(spark, base, rules)
    sizes = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes[4:]) <= max(sizes[:4]) + 1, f"state of eight days: {sizes}"
    put(f"{base}/in", "08.log", [line(9, "late", "s0-1"), line(8 * DAY, "x")])
    put(f"{base}/in", "09.log", [line(DAY + 9, "late", "s1-1", more="&country=all&province=all&city=all")])
    run_flow(spark, base, rules)
    batch = location_flow(session_grain(located_events(spark.read.text(f"{base}/in"), rules)))
    got = lambda: rows(flow.current_flow(spark, f"{base}/flow_log"), *FLOW)
    assert got() != rows(batch, *FLOW), "late rows are missing first"
    live.start_event_load(streams.text_lines(spark, f"{base}/in"), rules, f"{base}/events", f"{base}/cp2", None).awaitTermination()
    notes = flow.repair_flow(spark, f"{base}/flow_log", base)
    assert {n["day"]: n["dropped"] for n in notes if n["dropped"]} == {"2019-04-25": 1, "2019-04-26": 1}
    assert got() == rows(batch, *FLOW)
    facts = flow.current_flow_facts(spark, base)
    assert facts.count() == len(got()) and facts.filter("location_dimension_id IS NULL").count() == 0
    assert flow.repair_flow(spark, f"{base}/flow_log", base) == [], "nothing new"


def test_places_called_all_keep_their_facts(spark, tmp_path, rules):
    base = str(tmp_path)
    put(f"{base}/in", "0.log", [line(0, "u", more="&province=all&city=all"), line(1, "v"), line(2, "w", more="&city=all")])
    run_flow(spark, base, rules)
    assert flow.current_flow_facts(spark, base).count() == flow.current_flow(spark, f"{base}/flow_log").count()


def test_files_of_a_day_log_stay_flat(spark, tmp_path):
    schema = table(id="int", n="bigint", created="string")
    log = DayLog(spark, f"{tmp_path}/log", schema, lambda x: latest_flow(x, ["dt", "id"]), compact_every=5)
    held = []
    for k in range(60):
        row = spark.createDataFrame([(k % 3, k, str(k))], schema).withColumn("dt", F.make_date(F.lit(2024), F.lit(1), F.lit(1 + k // 30)))
        log.append(row, k)
        held.append((len(glob.glob(f"{tmp_path}/log/dt=2024-01-01/part=*")), len(log.read([log.days()[-1]]).inputFiles())))
    assert max(a for a, _ in held) <= 12 and max(b for _, b in held) <= 6
    assert [a for a, _ in held[30:]] == [held[30][0]] * 30, "another day's batches touch nothing here"
    got = rows(log.latest(log.read()), "dt", "id", "n", "created")
    assert [r[2:] for r in got] == [(27, "0"), (28, "1"), (29, "2"), (57, "30"), (58, "31"), (59, "32")]


def test_ids_pass_no_single_task(spark):
    keys = spark.range(1000).select((F.col("id") * 7919 % 1000).cast("string").alias("platform_name"))
    numbered = dims.assign_ids(keys, dims.PLATFORM_KEY, 5)
    assert "SinglePartition" not in plan_of(numbered) and dict(numbered.dtypes)["id"] == "bigint"
    ordered = sorted(str(k) for k in range(1000))
    assert rows(numbered) == sorted(((6 + k, n) for k, n in enumerate(ordered)), key=repr)


def test_a_second_writer_of_the_same_ids_fails(spark, tmp_path, monkeypatch):
    path, key = str(tmp_path / "dim"), ["platform_name"]
    frame = lambda *xs: spark.createDataFrame([(x,) for x in xs], "platform_name string")
    tables.refresh_dimension(spark, path, frame("a"), key)
    real = tables.written_once

    def meanwhile(df):
        monkeypatch.setattr(tables, "written_once", real)
        out = real(df)
        tables.refresh_dimension(spark, path, frame("c", "d"), key)
        return out

    monkeypatch.setattr(tables, "written_once", meanwhile)
    with pytest.raises(tables.ClaimedByAnother):
        tables.refresh_dimension(spark, path, frame("b"), key)
    assert rows(tables.refresh_dimension(spark, path, frame("b"), key)) == [(1, "a"), (2, "c"), (3, "d"), (4, "b")]


def test_a_writer_that_went_without_rows_blocks_for_a_while_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    frame = spark.createDataFrame([("a",)], "platform_name string")
    tables.claim_ids(spark, path, 0)
    with pytest.raises(tables.ClaimedByAnother):
        tables.refresh_dimension(spark, path, frame, ["platform_name"])
    monkeypatch.setattr(tables, "CLAIM_AGE", -1)
    assert rows(tables.refresh_dimension(spark, path, frame, ["platform_name"])) == [(1, "a")]
