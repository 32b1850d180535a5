"""Calendar and epoch expressions (X-2 .. X-7), all JVM-side and zone-free.

Timestamps are ``timestamp_ntz``; epoch arithmetic is done against a zone-less
1970-01-01 so the result does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def epoch() -> Column:
    """The zone-less epoch as a column (built lazily: needs an active session)."""
    return F.lit(EPOCH).cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_parts(ts: Column | str) -> dict[str, Column]:
    """hour, day, ISO week, month (text), year, weekday (text, 0 = Sunday)."""
    ts = _col(ts)
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts).cast("string"),
        "year": F.year(ts),
        "weekday": (F.dayofweek(ts) - 1).cast("string"),
    }


def millis_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds (number) to a zone-less timestamp (X-5)."""
    return F.timestamp_add("MILLISECOND", _col(ms).cast("long"), epoch())


def epoch_millis(ts: Column | str) -> Column:
    """Whole epoch milliseconds, rounded down (floor, also before 1970)."""
    micros = F.timestamp_diff("MICROSECOND", epoch(), _col(ts))
    return ((micros - F.pmod(micros, F.lit(1000))) / 1000).cast("long")


def epoch_seconds(ts: Column | str) -> Column:
    """Fractional epoch seconds, microsecond precision (as a float division)."""
    return F.timestamp_diff("MICROSECOND", epoch(), _col(ts)) / F.lit(1_000_000.0)


def iso_text(ts: Column | str) -> Column:
    """ISO 8601 text; the fraction appears only when it is not zero (X-6)."""
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    has_frac = (F.timestamp_diff("MICROSECOND", epoch(), ts) % 1_000_000) != 0
    return F.when(has_frac, frac).otherwise(whole)


def text_to_epoch_seconds(s: Column | str) -> Column:
    """Timestamp text to fractional epoch seconds (X-7): moved to UTC where the text
    ends in an offset (``+02:00``, ``+0200`` or ``Z``), else read as UTC."""
    text = _col(s)
    colon = F.regexp_replace(text, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    zoned = text.rlike(r"[0-9](?:Z|[+-][0-9]{2}:?[0-9]{2})$") & text.rlike(r":[0-9]{2}")
    moved = F.unix_micros(F.to_timestamp_ltz(F.when(zoned, colon))) / F.lit(1_000_000.0)
    return F.when(zoned, moved).otherwise(epoch_seconds(F.to_timestamp_ntz(F.when(~zoned, text))))
