"""IPv4 text and numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import split_trimmed


def ip_to_long(ip: Column) -> Column:
    """Dotted text to a number: eight bits per octet, octets joined by OR.

    NULL for text that is not dotted integers.
    """
    number = F.aggregate(
        split_trimmed(ip, "."),
        F.lit(0).cast("bigint"),
        lambda acc, octet: F.shiftleft(acc, 8).bitwiseOR(octet.try_cast("bigint")),
    )
    return (
        F.when(ip.rlike(r"\A\.+\z"), F.lit(0).cast("bigint"))
        .when(ip.rlike(r"\A[0-9.+-]+\z"), number)
    )


def long_to_ip(number: Column) -> Column:
    return F.concat_ws(
        ".",
        *[F.shiftright(number, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)],
    )
