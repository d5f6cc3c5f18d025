"""Text form of a set of counters: ``name=value|name=value``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pack_fields(fields: dict[str, Column]) -> Column:
    return F.concat_ws("|", *[F.concat(F.lit(name + "="), c.cast("string")) for name, c in fields.items()])


def unpack_fields(text: Column) -> Column:
    return F.str_to_map(text, F.lit("[|]"), F.lit("="))


def get_field(text: Column, name: str) -> Column:
    """Value of the first field of that name, else NULL."""
    items = F.filter(F.split(text, "[|]"), lambda item: item.startswith(name + "="))
    return F.substring_index(F.get(items, F.lit(0)), "=", -1)


def set_field(text: Column, name: str, value: Column) -> Column:
    """Replace the value of the first field of that name; unknown names change nothing."""
    items = F.split(text, "[|]")
    at = F.array_position(F.transform(items, lambda item: F.substring_index(item, "=", 1)), F.lit(name))
    return F.array_join(
        F.transform(
            items,
            lambda item, i: F.when(i + 1 == at, F.concat(F.lit(name + "="), value.cast("string"))).otherwise(item),
        ),
        "|",
    )
