"""Column names, event codes and labels shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names and codes of the log format -------------------
PARAM_COLUMNS = ["uid", "sid", "en", "pl", "b_n", "pid", "os_n"]
REGION_COLUMNS = ["country", "province", "city"]
EVENT_COLUMNS = ["ip", "access_time", "country", "province", "city",
                 "uid", "sid", "en", "pl", "b_n", "pid", "os_n"]
ANALYSIS_COLUMNS = ["uid", "sid", "access_time", "en", "country", "province",
                    "city", "pl", "b_n", "pid", "os_n"]
LAUNCH = "e_l"
PAGE_VIEW = "e_pv"
PRODUCT_VIEW = "e_bp"
UNKNOWN = "unknown"
ALL = "all"
# -----------------------------------------------------------------------------

VIEW_EVENTS = [PAGE_VIEW, PRODUCT_VIEW]
# where a line came from: time of its file or message, name, offset, and line from there on
SOURCE_COLUMNS = ["src_time", "src_name", "src_pos", "src_line"]


def table(**columns: str) -> T.StructType:
    """A schema from column names and simple type names."""
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in columns.items()])


# The twelve known columns of a stored event, every other parameter in ``params``, and where its line came from.
EVENT_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "access_time" else T.StringType()) for c in EVENT_COLUMNS]
    + [T.StructField("params", T.MapType(T.StringType(), T.StringType()))]
    + [T.StructField(c, T.StringType() if c == "src_name" else T.LongType()) for c in SOURCE_COLUMNS]
)
