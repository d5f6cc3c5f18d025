"""The column functions as temporary SQL functions.

Their bodies are expressions, so the optimizer inlines them like any column.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .ratios import BELOW_HALF

FUNCTIONS = {
    "not_blank(s STRING) RETURNS BOOLEAN": r"coalesce(s RLIKE r'\P{javaWhitespace}', false)",
    "device_class(ua STRING) RETURNS STRING":
        "CASE WHEN contains(lower(ua), 'android') THEN 'android' "
        "WHEN contains(lower(ua), 'iphone') THEN 'iphone' ELSE 'pc' END",
    "ip_to_long(ip STRING) RETURNS BIGINT":
        r"CASE WHEN ip RLIKE r'\A\.+\z' THEN 0L WHEN ip RLIKE r'\A[0-9.+-]+\z' THEN "
        r"aggregate(transform(split(regexp_replace(ip, r'[.]+\z', ''), '[.]'), o -> try_cast(o AS BIGINT)), 0L, "
        r"(acc, o) -> shiftleft(acc, 8) | o) END",
    "is_valid_date(s STRING) RETURNS BOOLEAN":
        r"coalesce(s RLIKE r'\A\d{4}-\d{2}-\d{2}\z' AND substring(s, 1, 4) <> '0000' "
        r"AND try_to_date(s, 'yyyy-MM-dd') IS NOT NULL, false)",
    "event_date(ms BIGINT) RETURNS DATE": "to_date(timestamp_millis(ms))",
    "season(d DATE) RETURNS INT": "quarter(d)",
    "ratio2(k BIGINT, n BIGINT) RETURNS DOUBLE":
        "CASE WHEN n <> 0 THEN ((200 * k + n) div (2 * n) - CASE WHEN (200 * k) % n = 0 AND (200 * k) div n IN ("
        + ", ".join(map(str, BELOW_HALF)) + ") THEN 1 ELSE 0 END) / 100.0D END",
    "packed_field(s STRING, name STRING) RETURNS STRING":
        "substring_index(get(filter(split(s, '[|]'), f -> startswith(f, concat(name, '='))), 0), '=', -1)",
}


def register_functions(spark: SparkSession) -> None:
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
