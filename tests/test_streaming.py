import glob
import os

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import grain, locations, visits, wordcount
from sessionloom.plans.etl import located_events
from sessionloom.session import pin_utc
from sessionloom.sources import derived, streams
from sessionloom.sources.event_table import read_event_day
from sessionloom.sources.logs import MissingInput, read_landed_day
from sessionloom.streaming import events as live
from sessionloom.streaming import flow, landing, sessions, start
from sessionloom.streaming import wordcount as words

from conftest import rows

RULES = "start_ip bigint, end_ip bigint, country string, province string, city string"
FLOW = ["dt", "country", "province", "city", "nu", "uv", "pv", "sn", "on"]
DAY = 1_556_150_400_000  # 2019-04-25 UTC


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(lines) + "\n")
    # the file source reads in order of modification time
    stamp = 1_700_000_000 + len(os.listdir(folder))
    os.utime(f"{folder}/{name}", (stamp, stamp))


def line(ms, uid, sid, en, ip="1.0.0.1"):
    fields = {"en": en, "uid": uid, "sid": sid}
    query = "&".join(f"{k}={v}" for k, v in fields.items() if v is not None)
    return f"{ip}|{DAY + ms}|h|/log.gif?{query}"


@pytest.fixture
def rules(spark):
    first = 1 << 24
    return spark.createDataFrame(
        [(first, first + 255, "C", "P", "X"), (first + 256, first + 511, "C", "P", "Y")], RULES
    )


def run_flow(spark, src, rules, base, **kw):
    query = flow.start_flow(
        streams.text_lines(spark, src, 1), rules, f"{base}/flow", f"{base}/cp", every=None, **kw
    )
    query.awaitTermination()
    return query


def batch_flow(spark, src, rules):
    return locations.location_flow(grain.session_grain(located_events(spark.read.text(src), rules)))


BATCHES = [
    # batch 0: a launch, a session with one event, one with two, a line without session id
    [line(1, "u1", "s1", "e_l"), line(2, "u2", "s2", "e_pv"), line(3, "u2", "s2", "e_pv"), line(4, "u9", None, "e_pv")],
    # batch 1: s1 gets its second event (no bounce any more), s3 begins with one
    [line(5, "u1", "s1", "e_bp"), line(6, "u3", "s3", "e_pv", "1.0.1.1")],
    # batch 2: s3 gets two events at once in another city, s2 goes on
    [line(7, "u3", "s3", "e_pv"), line(8, "u3", "s3", "e_pv"), line(9, "u2", "s2", "e_s")],
    # batch 3: the missing session id again, an unknown place
    [line(10, "u8", None, "e_l"), line(11, "u7", "s7", "e_pv", "9.9.9.9")],
]


def test_flow_stream_equals_batch_after_every_batch(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    for i, lines in enumerate(BATCHES):
        put(src, f"{i}.log", lines)
        run_flow(spark, src, rules, tmp_path)  # also restarts from the checkpoint each time
        assert rows(flow.current_flow(spark, f"{tmp_path}/flow"), *FLOW) == rows(
            batch_flow(spark, src, rules), *FLOW
        ), f"after batch {i}"


def test_flow_counts_by_hand(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    for i, lines in enumerate(BATCHES[:2]):
        put(src, f"{i}.log", lines)
    run_flow(spark, src, rules, tmp_path)
    got = {r["city"]: r for r in flow.current_flow(spark, f"{tmp_path}/flow").filter("province = 'P'").collect()}
    everything = got["all"]
    # sessions: s1 (2 events), s2 (2), none (1), s3 (1)
    assert (everything["nu"], everything["uv"], everything["pv"], everything["sn"], everything["on"]) == (1, 4, 5, 4, 2)
    assert (got["Y"]["uv"], got["Y"]["sn"], got["Y"]["on"]) == (1, 1, 1)


def test_flow_replayed_batch_counts_once(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    for i, lines in enumerate(BATCHES):
        put(src, f"{i}.log", lines)
    run_flow(spark, src, rules, tmp_path)
    before = rows(flow.current_flow(spark, f"{tmp_path}/flow"))
    # without its commit the last batch is run again on restart
    last = max(glob.glob(f"{tmp_path}/cp/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run_flow(spark, src, rules, tmp_path)
    assert rows(flow.current_flow(spark, f"{tmp_path}/flow")) == before


def test_flow_compaction_and_facts(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    for i, lines in enumerate(BATCHES):
        put(src, f"{i}.log", lines)
    warehouse = str(tmp_path / "wh")
    run_flow(spark, src, rules, tmp_path, warehouse=warehouse, compact_every=3)
    assert os.path.exists(f"{tmp_path}/flow/dt=2019-04-25/part=b2")
    expected = batch_flow(spark, src, rules)
    assert rows(flow.current_flow(spark, f"{tmp_path}/flow"), *FLOW) == rows(expected, *FLOW)
    places = spark.read.parquet(f"{warehouse}/live/dimension_location")
    dates = spark.read.parquet(f"{warehouse}/live/dimension_date")
    assert places.count() == places.select("id").distinct().count()
    facts = flow.current_flow_facts(spark, warehouse)
    named = facts.join(places.withColumnRenamed("id", "location_dimension_id"), "location_dimension_id").join(
        dates.select(F.col("id").alias("date_dimension_id"), F.to_date("calendar").alias("dt")), "date_dimension_id"
    )
    assert rows(named, *FLOW) == rows(expected, *FLOW)


def test_flow_on_the_event_table(spark, tmp_path, sf_dir):
    pin_utc(spark)
    src = str(tmp_path / "in")
    derived.raw_lines(spark, sf_dir).repartition(3).write.text(src)
    rules = derived.ip_rules(spark, sf_dir)
    query = flow.start_flow(
        streams.text_lines(spark, src, 1), rules, f"{tmp_path}/flow", f"{tmp_path}/cp", every=None,
        watermark="60 days",
    )
    query.awaitTermination()
    assert start.late_rows_dropped(query) == 0
    assert rows(flow.current_flow(spark, f"{tmp_path}/flow"), *FLOW) == rows(batch_flow(spark, src, rules), *FLOW)


def test_flow_drops_and_counts_late_rows(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    day = 86_400_000
    put(src, "0.log", [line(20 * day, "u1", "s1", "e_l")])
    put(src, "1.log", [line(20 * day + 5, "u2", "s2", "e_l")])
    put(src, "2.log", [line(0, "u3", "s3", "e_l")])
    query = run_flow(spark, src, rules, tmp_path, watermark="1 day")
    assert start.late_rows_dropped(query) > 0
    days = {str(r["dt"]) for r in flow.current_flow(spark, f"{tmp_path}/flow").collect()}
    assert days == {"2019-05-15"}


def test_day_boundary_of_another_zone(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    put(src, "0.log", [line(15 * 3_600_000, "u1", "s1", "e_l"), line(17 * 3_600_000, "u1", "s2", "e_pv")])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        run_flow(spark, src, rules, tmp_path, day_starts_at="16 hours")
        got = rows(flow.current_flow(spark, f"{tmp_path}/flow"), *FLOW)
        assert got == rows(batch_flow(spark, src, rules), *FLOW)
        assert {str(r[0]) for r in got} == {"2019-04-25", "2019-04-26"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_word_counts_per_batch_running_and_union(spark, tmp_path):
    left, right = str(tmp_path / "a"), str(tmp_path / "b")
    put(left, "0.txt", ["to be or not to be", "to"])
    put(right, "0.txt", ["be  that"])
    put(left, "1.txt", ["to"])
    both = streams.union_streams([streams.text_lines(spark, p, 1) for p in (left, right)])
    words.start_word_count(both, f"{tmp_path}/per", f"{tmp_path}/cp1", every=None).awaitTermination()
    per_batch = words.batch_counts(spark, f"{tmp_path}/per")
    # nothing is carried over: some batch holds "to" once, as the second file does
    to_counts = sorted(r["n"] for r in per_batch.filter("word = 'to'").collect())
    assert sum(to_counts) == 4 and len(to_counts) == 2
    words.start_running_word_count(both, f"{tmp_path}/run", f"{tmp_path}/cp2", every=None).awaitTermination()
    lines = spark.read.text([left, right])
    assert rows(words.running_counts(spark, f"{tmp_path}/run")) == rows(wordcount.word_count(lines))


def test_landing_by_ingest_hour(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "logs")
    put(src, "0.log", ["a|1|h|/x", "b|2|h|/y"])
    landing.start_landing(streams.text_lines(spark, src), root, f"{tmp_path}/cp", every=None).awaitTermination()
    today = spark.sql("select date_format(current_timestamp(), 'yyyy-MM-dd') d").first()["d"]
    assert glob.glob(f"{root}/y=*/m=*/d=*/h=*/*.txt")
    assert rows(read_landed_day(spark, root, today), "value") == [("a|1|h|/x",), ("b|2|h|/y",)]
    with pytest.raises(MissingInput):
        read_landed_day(spark, root, "2001-01-01")


def test_closed_sessions_equal_batch(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    gap = 120_000
    moments = [0, 1000, 1000 + gap, 1001 + 2 * gap, 900_000]
    put(src, "0.log", [line(ms, "u1", "s", "e_pv") for ms in moments] + [line(5, "u2", "s", "e_pv")])
    put(src, "1.log", [line(10 * 86_400_000, "z", "s", "e_pv")])  # closes the others
    put(src, "2.log", [line(10 * 86_400_000, "z", "s", "e_pv")])
    events = located_events(streams.text_lines(spark, src, 1), rules)
    out = sessions.closed_sessions(events, gap)
    writer = out.writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out")
    start.paced(writer, f"{tmp_path}/cp", None).start().awaitTermination()
    got = rows(spark.read.parquet(f"{tmp_path}/out"), "uid", "start_ts", "end_ts", "n")
    batch = visits.session_summary(located_events(spark.read.text(src), rules), gap).filter("uid <> 'z'")
    assert got == rows(batch, "uid", "start_ts", "end_ts", "n")
    # a pause of exactly the gap does not end a session
    assert ("u1", DAY, DAY + 1000 + gap, 3) in got


def test_late_events_are_stored_in_any_order(spark, tmp_path, rules):
    src, day = str(tmp_path / "in"), 86_400_000
    for k, ms in enumerate([20 * day, 5, 10 * day, 20 * day + 1]):
        put(src, f"{k}.log", [line(ms, f"u{k}", "s", "e_pv")])
    live.start_event_load(streams.text_lines(spark, src, 1), rules, f"{tmp_path}/ev", f"{tmp_path}/cp",
                          every=None).awaitTermination()
    days = ["2019-04-25", "2019-05-05", "2019-05-15"]
    assert [read_event_day(spark, f"{tmp_path}/ev", d).count() for d in days] == [1, 1, 2]


def test_a_time_far_ahead_does_not_silence_the_flow(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    ahead = line(1, "x", "x", "e_l") + "&access_time=9999999999999"
    put(src, "0.log", [ahead, line(1, "y", "y", "e_l") + "&access_time=9223372036854775807"])
    for k in range(3):
        put(src, f"{k + 1}.log", [line(10 + k, f"u{k}", f"s{k}", "e_l")])
    run_flow(spark, src, rules, tmp_path, watermark="7 days")
    got = rows(flow.current_flow(spark, f"{tmp_path}/flow"), *FLOW)
    assert got == rows(batch_flow(spark, src, rules), *FLOW) and max(r[5] for r in got) == 3


def test_a_folder_of_another_layout_is_an_error(spark, tmp_path):
    spark.createDataFrame([(1,)], "access_time long").write.parquet(f"{tmp_path}/ev/dt=2019-04-25")
    with pytest.raises(MissingInput):
        read_event_day(spark, f"{tmp_path}/ev", "2019-04-25")


def test_live_event_load_drops_copies_and_keeps_bad_lines(spark, tmp_path, rules):
    src = str(tmp_path / "in")
    put(src, "0.log", [line(1, "u1", "s1", "e_l"), "1.x.0.1|1|h|/l?en=e_l&uid=u"])
    put(src, "1.log", [line(1, "u1", "s1", "e_l"), line(2, "u1", "s1", "e_pv", "1.0.1.9")])
    lines = streams.text_lines(spark, src, 1)
    live.start_event_load(lines, rules, f"{tmp_path}/ev", f"{tmp_path}/cp", every=None).awaitTermination()
    got = rows(read_event_day(spark, f"{tmp_path}/ev", "2019-04-25"), "access_time", "uid", "en", "city")
    assert got == [(DAY + 1, "u1", "e_l", "X"), (DAY + 2, "u1", "e_pv", "Y")]
    live.start_bad_records(lines, f"{tmp_path}/bad", f"{tmp_path}/cp2", every=None).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/bad"), "reason") == [("bad_ip",)]


def test_console_output(spark, tmp_path):
    src = str(tmp_path / "in")
    put(src, "0.txt", ["a b a"])
    counts = wordcount.word_count(streams.text_lines(spark, src))
    query = start.start_console(counts, f"{tmp_path}/cp", every=None)
    query.awaitTermination()
    assert query.exception() is None


def test_kafka_options():
    options = streams.kafka_options("h1:9092,h2:9092", ["event_log"], reset="smallest", max_offsets_per_trigger=500)
    assert options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "event_log",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "500",
    }
    assert streams.kafka_options("h", ["t"])["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        streams.kafka_options("h", ["t"], reset="middle")
