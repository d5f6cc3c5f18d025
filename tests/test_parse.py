import pytest
from pyspark.sql import functions as F

from sessionloom.operators.parse import bad_records, good_events, parse_lines
from sessionloom.operators.regions import resolve_regions

from conftest import rows

GOOD = "en=e_pv&uid=u1&sid=s1"
T = "1556199190643"


def parse(spark, *lines):
    return parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


def only(spark, line):
    found = parse(spark, line).collect()
    assert len(found) == 1
    return found[0]


@pytest.mark.parametrize("line", ["", "  \t", "　", "a|b|c", f"1.0.0.1|{T}|h|/l?{GOOD}|x", None])
def test_unusable_lines_are_dropped(spark, line):
    assert parse(spark, line).count() == 0


@pytest.mark.parametrize("tail", ["", "|", "|||"])
def test_trailing_pipes_do_not_count_as_fields(spark, tail):
    row = only(spark, f"1.0.0.1|{T}|h|/l?{GOOD}{tail}")
    assert row["reason"] is None and row["uid"] == "u1" and row["access_time"] == int(T)


@pytest.mark.parametrize(
    "query, expected",
    [
        ("k=v=w", {}),
        ("k=", {}),
        ("=v", {}),
        ("k", {}),
        ("k= ", {}),
        ("k= ", {}),
        ("k=%20", {"k": " "}),
        ("k=v==", {"k": "v"}),
        ("k=a+b%26c", {"k": "a b&c"}),
        ("%6B=v", {"k": "v"}),
        ("k=1&k=2", {"k": "2"}),
        ("k=1&%6B=2&k=", {"k": "2"}),
        ("&&k=v&&", {"k": "v"}),
        ("x= y&k=v", {"x": " y", "k": "v"}),
        ("k=v?", {"k": "v"}),
        ("k=v?x=1", {}),
        ("k=caf%C3%A9", {"k": "café"}),
        (" ", {}),
        # the collector runs two requests together: the joined pair has three parts
        ("en=e_pven=e_pv&sdk=js", {"sdk": "js"}),
    ],
)
def test_query_rules(spark, query, expected):
    row = parse(spark, f"1.0.0.1|{T}|h|/l?{query}").first()
    assert row["params"] == expected


def test_second_question_mark_first(spark):
    assert only(spark, f"1.0.0.1|{T}|h|?{GOOD}")["uid"] == "u1"
    assert only(spark, f"1.0.0.1|{T}|h|/l??{GOOD}")["params"] == {}
    assert only(spark, f"1.0.0.1|{T}|h|/l")["params"] == {}


def test_parameters_replace_stored_fields_but_not_the_lookup(spark):
    rules = spark.createDataFrame(
        [(1 << 24, (1 << 24) + 9, "C", "P", "Y")],
        "start_ip bigint, end_ip bigint, country string, province string, city string",
    )
    events = good_events(parse(spark, f"1.0.0.1|{T}|h|/l?{GOOD}&ip=9.9.9.9&country=X&access_time=5"))
    got = resolve_regions(events, rules, "line_ip_num").first()
    assert (got["ip"], got["access_time"]) == ("9.9.9.9", 5)
    assert (got["country"], got["province"], got["city"]) == ("X", "P", "Y")


def test_bad_lines_carry_their_reason(spark):
    parsed = parse(
        spark,
        f"1.0.0.1|{T}|h|/l?{GOOD}&a=%zz",
        f"1.0.0.1|{T}|h|/l?{GOOD}&%zz=a",
        f"1.x.0.1|{T}|h|/l?{GOOD}",
        f" 1.0.0.1|{T}|h|/l?{GOOD}",
        f"1.0.0.1|noon|h|/l?{GOOD}",
        f"1.0.0.1|9223372036854775807|h|/l?{GOOD}",
        f"1.0.0.1|-1|h|/l?{GOOD}",
        f"1.0.0.1|{T}|h|/l?{GOOD}&access_time={int(T) + 86_400_001}",
        f"1.0.0.1|{T}|h|/l?en=e_pv&sid=s1",
        f"1.0.0.1|{T}|h|/l?uid=u1&sid=s1",
        f"1.0.0.1|{T}|h|/l?en=e_pv&uid=u1",
    )
    reasons = [r[0] for r in rows(bad_records(parsed), "reason")]
    assert reasons == ["ahead_time", "bad_escape", "bad_escape", "bad_ip", "bad_ip", "bad_time", "bad_time", "bad_time", "no_en",
                       "no_uid"]
    kept = rows(good_events(parsed), "uid", "sid", "en")
    assert kept == [("u1", None, "e_pv")]


def test_every_line_is_dropped_good_or_bad(spark):
    lines = [f"1.0.0.1|{T}|h|/l?{GOOD}", "junk", f"1.0.0.1|{T}|h|/l?a=%zz"]
    parsed = parse(spark, *lines)
    assert good_events(parsed).count() + bad_records(parsed).count() == 2


def test_parsing_never_shuffles_or_calls_python(spark):
    plan = good_events(parse_lines(spark.createDataFrame([("x",)], "value string")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text.replace("ExistingRDD", "")
    assert plan.filter(F.col("uid") == "x").count() == 0
