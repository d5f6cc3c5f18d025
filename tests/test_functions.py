import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sessionloom.functions import dates, packed, text
from sessionloom.functions.ip import ip_to_long, long_to_ip
from sessionloom.functions.ratios import BELOW_HALF, ratio2
from sessionloom.functions.sql import register_functions
from sessionloom.session import shared_dir

from conftest import rows


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{k} {'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return frame.select(column.alias("x")).first()["x"]


def exact_ratio(k, n):
    return float(Decimal(k / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_ratio_equals_exact_decimal_rounding(spark):
    n = 400
    pairs = spark.range(1, n + 1).withColumnRenamed("id", "n").select(
        "n", F.explode(F.sequence(F.lit(0).cast("bigint"), "n")).alias("k"))
    for r in pairs.select("k", "n", ratio2(F.col("k"), F.col("n")).alias("r")).collect():
        assert r["r"] == exact_ratio(r["k"], r["n"]), (r["k"], r["n"])


def test_ratio_cases(spark):
    assert len(BELOW_HALF) == 48
    assert one(spark, ratio2(F.col("k"), F.col("n")), k=57, n=200) == 0.28
    assert one(spark, ratio2(F.col("k"), F.col("n")), k=1, n=8) == 0.13
    assert one(spark, ratio2(F.col("k"), F.col("n")), k=0, n=0) is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**9), st.floats(0, 1)), min_size=1, max_size=40))
def test_ratio_of_large_counts(spark, cases):
    pairs = [(int(n * share), n) for n, share in cases]
    frame = spark.createDataFrame(pairs, "k bigint, n bigint")
    for r in frame.select("k", "n", ratio2(F.col("k"), F.col("n")).alias("r")).collect():
        assert r["r"] == exact_ratio(r["k"], r["n"])


@pytest.mark.parametrize(
    "ip, number",
    [("1.2.3.4", 0x01020304), ("255.255.255.255", 2**32 - 1), ("7", 7), ("1.2", 258), ("1.2.3.4..", 0x01020304),
     ("1.x.0.1", None), ("", None), ("...", 0), ("1..2", None), (" 1.2.3.4", None), ("999.0.0.1", (999 << 24) + 1)],
)
def test_ip_numbers(spark, ip, number):
    assert one(spark, ip_to_long(F.col("ip")), ip=ip) == number


def test_ip_text(spark):
    assert one(spark, long_to_ip(F.col("n")), n=0x01020304) == "1.2.3.4"


def calendar_valid(s):
    """Whether Python's own calendar reads the text and writes it back unchanged."""
    try:
        return dt.date.fromisoformat(s).isoformat() == s
    except ValueError:
        return False


def test_valid_dates(spark):
    years = ["0000", "0001", "1900", "2000", "2019", "2020", "9999"]
    cases = [f"{y}-{m:02d}-{d:02d}" for y in years for m in range(0, 14) for d in range(0, 33)]
    cases += ["2019-1-01", "2019-01-1", "19-01-01", "2019/01/01", "2019-01-01 ", "2019-01-01\n", "+2019-01-01", "x", ""]
    frame = spark.createDataFrame([(c,) for c in cases], "s string")
    for r in frame.select("s", dates.is_valid_date(F.col("s")).alias("ok")).collect():
        assert r["ok"] == calendar_valid(r["s"]), r["s"]


@pytest.mark.parametrize("bad", ["2019-02-29", "2019-2-01", "0000-01-01", "20190101", "", None])
def test_job_date_is_checked(bad):
    with pytest.raises(ValueError):
        dates.checked_date(bad)
    assert dates.checked_date("2020-02-29").isoformat() == "2020-02-29"


def test_date_parts(spark):
    day = spark.sql("select date'2018-12-30' d").select(
        *[c.alias(k) for k, c in dates.date_parts(F.col("d")).items()]).first()
    assert day.asDict() == {"year": 2018, "season": 4, "month": 12, "week": 52, "day": 30}


def test_days_follow_the_zone_over_a_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = spark.sql("select date'2019-03-31' d").select(
            dates.day_start(F.col("d")).alias("a"), dates.day_start(dates.next_day(F.col("d"))).alias("b")).first()
        assert row["b"] - row["a"] == 23 * 3_600_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_packed_fields(spark):
    packed_text = "session_count=21|1s_3s=13|4s_6s=8|60=0"
    assert one(spark, packed.get_field(F.col("s"), "1s_3s"), s=packed_text) == "13"
    assert one(spark, packed.get_field(F.col("s"), "3s"), s=packed_text) is None
    assert one(spark, packed.set_field(F.col("s"), "4s_6s", F.lit(9)), s=packed_text) == packed_text.replace("s=8|", "s=9|")
    assert one(spark, packed.set_field(F.col("s"), "none", F.lit(9)), s=packed_text) == packed_text
    assert one(spark, packed.unpack_fields(F.col("s"))["60"], s=packed_text) == "0"


@pytest.mark.parametrize(
    "agent, device",
    [("Mozilla (Linux; ANDROID 9)", "android"), ("Mozilla (iPhone; U)", "iphone"), ("curl", "pc"),
     ("iphone android", "android")],
)
def test_device_class(spark, agent, device):
    assert one(spark, text.device_class(F.col("ua")), ua=agent) == device


def test_words_keep_inner_and_drop_trailing_blanks(spark):
    assert one(spark, text.words(F.col("s")), s=" a  b  ") == ["", "a", "", "b"]


def test_sql_functions_equal_columns(spark):
    register_functions(spark)
    frame = spark.createDataFrame(
        [("1.2.3.4", "2020-02-29", 57, 200, "x=1|y=2"), ("1.x", "2019-02-29", 3, 0, "y=5"), ("...", " ", 1, 8, "")],
        "ip string, s string, k bigint, n bigint, p string",
    )
    by_column = frame.select(
        ip_to_long(F.col("ip")), dates.is_valid_date(F.col("s")), ratio2(F.col("k"), F.col("n")),
        packed.get_field(F.col("p"), "y"), text.not_blank(F.col("s")), text.device_class(F.col("p")),
        dates.event_date(F.col("k")),
    )
    frame.createOrReplaceTempView("f")
    by_sql = spark.sql("""SELECT ip_to_long(ip), is_valid_date(s), ratio2(k, n), packed_field(p, 'y'), not_blank(s),
                                 device_class(p), event_date(k) FROM f""")
    assert rows(by_sql) == rows(by_column)


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
