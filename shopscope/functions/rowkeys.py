"""Sortable text keys of the wide tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LONG_MAX = 2**63 - 1


def reverse_ts(ts: Column | str) -> Column:
    """Text that sorts newest first: 19 digits counting down from the largest
    bigint by the milliseconds since 1970 of the moment as it is written, so
    that a key does not depend on the session time zone."""
    ts = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
    seconds = F.unix_date(F.to_date(ts)).cast("bigint") * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    millis = seconds * 1000 + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return F.lpad((F.lit(LONG_MAX) - millis).cast("string"), 19, "0")


def session_key(user_id: Column | str, start_time: Column | str) -> Column:
    return F.concat(_text(user_id), F.lit("#"), reverse_ts(start_time))


def product_day_key(product_id: Column | str, day: Column | str) -> Column:
    return F.concat(_text(product_id), F.lit("#"), F.date_format(day, "yyyy-MM-dd"))


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")
