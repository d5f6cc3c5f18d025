"""String rules of the log format, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

NON_BLANK = r"\P{javaWhitespace}"

# One k=v item between ampersands: exactly two sides, neither of them blank,
# equals signs at its end not counted.
_SIDE = r"(\p{javaWhitespace}*+[^=&\p{javaWhitespace}][^=&]*+)"
PAIR = rf"(?<![^&]){_SIDE}={_SIDE}=*+(?=&|\z)"


def not_blank(c: Column) -> Column:
    """Holds at least one non-whitespace character (Unicode); NULL counts as blank."""
    return F.coalesce(c.rlike(NON_BLANK), F.lit(False))


def split_trimmed(c: Column, sep: str) -> Column:
    """Split on one literal character, ignoring separators at the end of the text."""
    # an escaped or plain single character is split without a regular expression
    return F.split(F.rtrim(c, F.lit(sep)), re.escape(sep))


def query_text(request: Column) -> Column:
    """What follows the single ``?`` of a request; empty if there is none or a second part follows."""
    return F.regexp_extract(request, r"\A[^?]*\?([^?]+)\?*\z", 1)


def query_pairs(text: Column) -> Column:
    """The well-formed pairs of a query text, in order, still encoded; one search for both sides."""
    return F.regexp_extract_all(text, F.lit(PAIR), F.lit(0))


def pair_keys(pairs: Column) -> Column:
    return F.transform(pairs, lambda p: F.substring_index(p, "=", 1))


def pair_values(pairs: Column) -> Column:
    """Right sides, without the equals signs at the end."""
    return F.transform(pairs, lambda p: F.substring_index(F.rtrim(p, F.lit("=")), "=", -1))


def is_encoded(text: Column) -> Column:
    return text.contains("%") | text.contains("+")


def decode_all(items: Column, encoded: Column) -> Column:
    """URL-decode each item; NULL where the escape is broken. Plain texts skip the work."""
    return F.when(encoded, F.transform(items, F.try_url_decode)).otherwise(items)


def has_null(items: Column) -> Column:
    return F.exists(items, lambda item: item.isNull())


def last_value_map(keys: Column, values: Column, plain: Column) -> Column:
    """Aligned keys and values to a map in which the last value of a key wins; NULL keys are left out.

    ``plain`` says that no key is NULL. Then, and without repeated keys, the
    arrays are the map already. All arguments should be plain columns.
    """
    newest_keys, newest_values = F.reverse(keys), F.reverse(values)
    unique = F.array_compact(F.array_distinct(newest_keys))
    newest = F.transform(
        unique, lambda k: F.element_at(newest_values, F.array_position(newest_keys, k).cast("int"))
    )
    return F.when(
        plain & (F.size(F.array_distinct(keys)) == F.size(keys)), F.map_from_arrays(keys, values)
    ).otherwise(F.map_from_arrays(unique, newest))


def device_class(user_agent: Column) -> Column:
    """android / iphone / pc from a user agent."""
    ua = F.lower(user_agent)
    return (
        F.when(ua.contains("android"), "android")
        .when(ua.contains("iphone"), "iphone")
        .otherwise("pc")
    )


def words(text: Column) -> Column:
    """Space separated words; empty strings between double spaces are kept, at the end dropped."""
    return F.split(F.rtrim(text, F.lit(" ")), " ")
