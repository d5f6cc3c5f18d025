import random

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import regions
from sessionloom.sources.ip_rules import read_ip_rules, rule_columns

from conftest import plan_of, rows

SCHEMA = "start_ip bigint, end_ip bigint, country string, province string, city string"


@pytest.fixture(scope="module")
def rules(spark):
    rnd = random.Random(7)
    cuts = sorted(rnd.sample(range(1 << 32), 400))
    # some ranges are a single address, some span many slices, gaps between
    found = [(a, b - 1 if i % 5 else a, f"C{i % 4}", f"P{i % 9}", f"T{i}")
             for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if i % 3]
    return spark.createDataFrame(found, SCHEMA).cache()


@pytest.fixture(scope="module")
def events(spark, rules):
    rnd = random.Random(11)
    edges = [e for r in rules.collect() for e in (r["start_ip"], r["end_ip"], r["start_ip"] - 1, r["end_ip"] + 1)]
    numbers = edges + [rnd.randrange(1 << 32) for _ in range(2000)] + [edges[5]] * 1500 + [-5, 1 << 40]
    return spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "id bigint, ip_num bigint").cache()


def brute(events, rules):
    joined = events.join(rules, events["ip_num"].between(rules["start_ip"], rules["end_ip"]), "left")
    return rows(joined.select("id", *[F.coalesce(c, F.lit("unknown")) for c in ("country", "province", "city")]))


def test_broadcast_join_equals_plain_range_join(spark, events, rules):
    got = regions.resolve_regions(events, rules)
    assert rows(got, "id", "country", "province", "city") == brute(events, rules)
    plan = plan_of(got)
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_join_of_a_large_rule_set_equals_plain_range_join(spark, events, rules):
    got = regions.resolve_regions(events, rules, broadcast_bytes=10)
    assert rows(got, "id", "country", "province", "city") == brute(events, rules)
    assert "Cartesian" not in plan_of(got)


def test_null_addresses_are_unknown_on_both_paths(spark, rules):
    lone = spark.createDataFrame([(1, None), (2, None)], "id bigint, ip_num bigint")
    for limit in (10, 10**9):
        got = regions.resolve_regions(lone, rules, broadcast_bytes=limit)
        assert rows(got, "id", "city") == [(1, "unknown"), (2, "unknown")]


@pytest.mark.parametrize(
    "bad",
    [
        [(0, 10, "a", "b", "c"), (10, 20, "a", "b", "d")],
        [(0, 1 << 20, "a", "b", "c"), (70_000, 70_001, "a", "b", "d")],
        [(5, 4, "a", "b", "c")],
        [(0, 1 << 33, "a", "b", "c")],
        [(None, 4, "a", "b", "c")],
    ],
)
def test_unusable_rules_raise(spark, bad):
    with pytest.raises(ValueError):
        regions.check_rules(spark.createDataFrame(bad, SCHEMA))


def test_rule_file(spark, tmp_path):
    path = tmp_path / "ip.txt"
    path.write_text("1.0.0.0|1.0.0.255|16777216|16777471|AS|C|P|T|x|y\n1.0.1.0|1.0.1.9|16777472|16777481|AS|C|P|U\n")
    got = read_ip_rules(spark, str(path))
    assert rows(got) == [(16777216, 16777471, "C", "P", "T"), (16777472, 16777481, "C", "P", "U")]
    assert got.schema == rule_columns(spark.read.text(str(path))).schema


def test_a_stream_finds_the_same_beyond_the_limit(spark, events, rules, tmp_path):
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    for name, limit in (("wide", 0), ("small", 10**9)):
        found = regions.resolve_regions(stream, rules, broadcast_bytes=limit)
        found.writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option(
            "checkpointLocation", f"{tmp_path}/cp-{name}").trigger(availableNow=True).start().awaitTermination()
        assert rows(spark.read.parquet(f"{tmp_path}/{name}"), "id", "country", "province", "city") == brute(events, rules)


def test_stored_rules_serve_batches_at_any_limit(spark, events, rules):
    known = regions.region_rules(rules)
    for limit in (0, known.bytes):
        got = regions.resolve_regions(events, known, broadcast_bytes=limit)
        assert rows(got, "id", "country", "province", "city") == brute(events, rules)
