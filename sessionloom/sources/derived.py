"""Click-stream input made from a generic event table and a nation list.

The queries run on whole tables that hold no log lines of their own; these
views give every event a place, a session and a product, and write it as a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.barrier import computed_once
from ..functions.ip import long_to_ip
from ..operators.regions import resolve_regions
from ..schemas import ALL

DAY_MS = 86_400_000


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of ``sf_dir``; with a known schema its files are not opened for planning."""
    reader = spark.read.schema(SCHEMAS[table]) if table in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{table}.parquet")


def ip_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four city ranges of 65,536 addresses for each nation."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    placed = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").cast("bigint").alias("n"), "n_name", "r_name",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(3).cast("bigint"))).alias("c"),
    )
    start = (F.col("n") + 1) * 16777216 + F.col("c") * 65536
    return placed.select(
        start.alias("start_ip"),
        (start + 65535).alias("end_ip"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("province"),
        F.concat(F.lit("CITY_"), "n", F.lit("_"), "c").alias("city"),
    )


def rule_lines(rules: DataFrame) -> DataFrame:
    """Rules in their file format."""
    return rules.select(
        F.concat_ws(
            "|", long_to_ip(F.col("start_ip")), long_to_ip(F.col("end_ip")),
            F.col("start_ip").cast("string"), F.col("end_ip").cast("string"),
            F.lit("net"), "country", "province", "city",
        ).alias("value")
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event row per source event, still without a region."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    div = lambda a, b: F.call_function("div", a, F.lit(b).cast("bigint"))
    uid = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    slot = (div(F.col("user_id"), 27) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)) % 4
    en = F.expr(
        "CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' WHEN 'click' THEN 'e_pv' "
        "WHEN 'purchase' THEN 'e_bp' ELSE 'e_s' END"
    )
    return (
        load(spark, sf_dir, "events")
        .select(
            "event_id", "user_id", "event_type", ms.alias("ms"), k.alias("k"), slot.alias("slot"),
        )
        .select(
            "event_id",
            uid.alias("uid"),
            (F.col("ms") - F.col("ms") % DAY_MS + div(F.col("ms") % DAY_MS, 40)).alias("access_time"),
            F.concat(uid, F.lit("-"), div(F.col("ms"), DAY_MS).cast("string")).alias("sid"),
            en.alias("en"),
            F.element_at(F.array(F.lit("pc"), F.lit("ios"), F.lit("android")),
                         (F.col("user_id") % 3 + 1).cast("int")).alias("pl"),
            F.when((F.col("event_type") == "purchase") & (F.col("k") % 10 != 0),
                   F.col("k").cast("string")).alias("pid"),
            ((F.col("user_id") % 27 + 1) * 16777216 + F.col("slot") * 65536 + F.col("user_id")).alias("ip_num"),
        )
        .withColumn("ip", long_to_ip(F.col("ip_num")))
    )


def weblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their region; some lack a user, session or platform, are sent from a second platform, or name their
    platform or place like the label of a total."""
    located = resolve_regions(visits(spark, sf_dir), ip_rules(spark, sf_dir))
    every = lambda n: F.col("event_id") % n == 0
    none = F.lit(None).cast("string")
    return located.withColumns({
        "pl": F.when(every(97), ALL).when(every(89), none).when(every(13), "pc").otherwise(F.col("pl")),
        "uid": F.when(every(83), none).otherwise(F.col("uid")),
        "sid": F.when(every(79), none).otherwise(F.col("sid")),
        "province": F.when(every(101), ALL).otherwise(F.col("province")),
        "city": F.when(every(101), ALL).otherwise(F.col("city")),
    })


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a load would store them, the source's number as the line they came from."""
    none = F.lit(None).cast("string")
    return weblog(spark, sf_dir).withColumns({
        "b_n": none, "os_n": none, "params": F.create_map(F.lit("en"), F.col("en")),
        "src_time": F.lit(0).cast("bigint"), "src_name": F.lit("/logs"), "src_pos": F.lit(0).cast("bigint"),
        "src_line": F.col("event_id")})


def wide_ip_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ranges for each nation that cover several slices and end within one, with a gap behind them."""
    first = [(0, 0, 150_000, "NEAR"), (1, 150_001, 226_608, "FAR")]
    start = (F.col("n_nationkey").cast("bigint") + 1) * 16777216
    ranges = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(("k", "low", "high", "name"), r)]) for r in first]))
    return load(spark, sf_dir, "nation").select("n_nationkey", "n_name", ranges.alias("r")).select(
        (start + F.col("r.low")).alias("start_ip"), (start + F.col("r.high")).alias("end_ip"),
        F.col("r.name").alias("country"), F.col("n_name").alias("province"),
        F.concat(F.lit("WIDE_"), F.col("n_nationkey"), F.lit("_"), F.col("r.k")).alias("city"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log line; one line in fifty of each kind is damaged or unusual."""
    v = visits(spark, sf_dir)
    pair = lambda name, c: F.concat(F.lit(name + "="), F.url_encode(c))
    kind = F.col("event_id") % 50
    query = F.concat_ws(
        "&",
        F.when(kind == 4, "junk=a=b&half=&=none").when(kind == 6, "en=e_zz").when(kind == 8, "z=%zz"),
        pair("en", F.col("en")),
        F.when(kind == 10, F.concat(F.lit("%75id="), "uid")).otherwise(pair("uid", F.col("uid"))),
        pair("sid", F.col("sid")),
        pair("pl", F.col("pl")),
        F.when(F.col("pid").isNotNull(), pair("pid", F.col("pid"))),
        F.when(kind == 7, "country=Far+Away%21").when(kind == 5, "x=1?y=2").when(kind == 12, "tt=caf%C3%A9+au+lait"),
    )
    line = F.concat(
        F.when(kind == 9, "1.x.0.1").otherwise(F.col("ip")), F.lit("|"),
        F.when(kind == 11, "yesterday").otherwise(F.col("access_time").cast("string")),
        F.lit("|host|/log.gif?"), query,
    )
    value = (
        F.when(kind == 1, F.concat(line, F.lit("||")))
        .when(kind == 2, F.concat(line, F.lit("|tail")))
        .when(kind == 3, F.lit(" \t "))
        .otherwise(line)
    )
    return computed_once(v, value=value).select("value")


def weblog_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which every tenth arrives again later with another platform, with the places of their lines.

    Lines come in files of a thousand; the second copy of an event is in a file of a later time, in a later file of the
    same time, in a later block of the same file or in a later line of the same block.
    """
    v = visits(spark, sf_dir).withColumn("ingest_seq", F.col("event_id"))
    again = v.filter(F.col("event_id") % 10 == 0).withColumn(
        "ingest_seq", F.col("event_id") + 1_000_000_000
    ).withColumn("pl", F.lit("pc"))
    kind = F.call_function("div", F.col("event_id"), F.lit(10).cast("bigint")) % 4
    late = lambda k: ((F.col("ingest_seq") >= 1_000_000_000) & (kind == k)).cast("bigint")
    file = F.call_function("div", F.col("event_id"), F.lit(1000).cast("bigint"))
    return v.unionByName(again).withColumns({
        "src_time": file + late(0), "src_name": F.concat(F.lit("/logs/part-"), late(1).cast("string")),
        "src_pos": late(2) * 4096, "src_line": late(3),
    })
