"""Clock expressions. Instants are TIMESTAMP; the session clock is UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions.text import as_col, let, literal_map, strip

# RFC 822 zone names and their offsets.
_ZONE_OFFSETS = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def _zone_offset(name: Column) -> Column:
    return F.try_element_at(literal_map(_ZONE_OFFSETS), F.upper(name))


def _rfc822(text: Column, default_offset: str | None) -> Column:
    """``[Sun,] 19 Jul 2026 18:50[:00] zone``; NULL when it does not read as one."""
    def read(tokens: Column) -> Column:
        zone = F.substring_index(F.substring_index(tokens, " ", 5), " ", -1)
        offset = (
            F.when(zone.contains(":"), F.lit(default_offset).cast("string"))
            .when(zone.rlike(r"^[+-]\d{4}$"), zone)
            .otherwise(_zone_offset(zone))
        )
        stamp = F.concat(F.substring_index(tokens, " ", 4), F.lit(" "), offset)
        looks_right = tokens.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:")
        return F.when(looks_right, F.try_to_timestamp(stamp, F.lit("d MMM yyyy H:m[:s] Z")))

    return let(F.trim(F.regexp_replace(text, r"^[A-Za-z]+,?\s*|\s+", " ")), read)


def rfc822_to_utc(c) -> Column:
    """RFC 822 date to an instant; no offset, ``-0000`` or anything unreadable is NULL."""
    text = strip(c)
    return F.when(~text.endswith("-0000"), _rfc822(text, None))


def _iso(text: Column) -> Column:
    """``2026-06-12[T ]19:56[:57[.123]][zone]``; a missing zone reads as UTC."""
    full = F.regexp_replace(text, r"^([-\d]+)$", "$1T00:00:00")
    full = F.regexp_replace(full, r"([T ]\d{1,2}:\d{1,2})(?=$|[zZ+-])", "$1:00")
    full = F.regexp_replace(full, r"([+-]\d{2})(\d{2})$", "$1:$2")

    def read(full: Column) -> Column:
        zoned = full.rlike(r"(?:[zZ]|[+-]\d{2}:\d{2})$")
        return F.try_to_timestamp(F.when(zoned, full).otherwise(F.concat(full, F.lit("Z"))))

    looks_right = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?:$|[T ]+\d{1,2}:)")
    return F.when(looks_right, let(full, read))


def feed_time(published, updated, tz_offset) -> Column:
    """Feed entry time: published, else updated.

    A feed with ``tz_offset`` (hours) prints its local clock: the numbers are read
    as UTC first and then moved by the offset, whatever zone the text names.
    """
    def read(c):
        text = strip(c)
        return F.coalesce(_rfc822(text, "+0000"), _iso(text))

    utc = F.coalesce(read(published), read(updated))
    shift = F.coalesce(F.round(as_col(tz_offset) * 3_600_000_000).cast("long"), F.lit(0))
    return F.timestamp_micros(F.unix_micros(utc) - shift)


def zone_to_utc(c, zone: str = C.FIREHOSE_ZONE) -> Column:
    """Clock text of a named zone to an instant, daylight saving included."""
    text = strip(c)
    looks_right = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}(?::\d{1,2})?$")
    stamp = F.concat(text, F.lit(f" {zone}"))
    return F.when(looks_right, F.try_to_timestamp(stamp, F.lit("yyyy-M-d H:m[:s] VV")))


def in_blackout(
    ts, start_hour: int | None, end_hour: int | None, *, zone: str = C.BLACKOUT_ZONE
) -> Column:
    """Local hour in [start, end); never, unless both ends are set."""
    if start_hour is None or end_hour is None:
        return F.lit(False)
    hour = F.hour(F.from_utc_timestamp(as_col(ts), zone))
    return (hour >= start_hour) & (hour < end_hour)


def in_lookback(ts, now, *, days: int = C.LOOKBACK_DAYS) -> Column:
    """UTC date between now minus ``days`` and today, both included.

    The bounds are written as instants so that the filter reaches the scan.
    """
    ts, now = as_col(ts), as_col(now)
    today = F.to_date(now)
    return (ts >= F.date_sub(today, days).cast("timestamp")) & (
        ts < F.date_add(today, 1).cast("timestamp")
    )


def is_weekend(ts) -> Column:
    return F.dayofweek(as_col(ts)).isin(1, 7)


def age_seconds(ts, now) -> Column:
    """Elapsed time in seconds, with fractions."""
    return (F.unix_micros(as_col(now)) - F.unix_micros(as_col(ts))) / F.lit(1_000_000)


def relative_time(ts, now) -> Column:
    """How long ago, in words; the future reads as now."""
    s = F.greatest(F.lit(0), F.floor(age_seconds(ts, now)))
    days, hours, minutes = (F.floor(s / n).cast("string") for n in (86400, 3600, 60))
    return (
        F.when(s < 60, C.AGO_TEXT["now"])
        .when(s < 3600, F.concat(minutes, F.lit(C.AGO_TEXT["minutes"])))
        .when(s < 86400, F.concat(hours, F.lit(C.AGO_TEXT["hours"])))
        .otherwise(F.concat(days, F.lit(C.AGO_TEXT["days"])))
    )
