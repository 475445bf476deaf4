"""Date and time column helpers. `as_of` stands in for the clock everywhere."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from jobloom.fixed_values import CYCLE_HOURS, CYCLE_ZONE


def moment(value: str | dt.datetime | Column) -> Column:
    """An `as_of` argument as a zone-free timestamp column."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_posted_date(text: Column) -> Column:
    """Timestamp of a posting date given as text.

    Digits only (five or more) are epoch milliseconds, DD-MM-YYYY is a day, and
    everything starting with a four-digit year is read as ISO. Anything else,
    days out of range included, is null, and so is the epoch 0.
    """
    digits = F.rlike(text, F.lit(r"^-?\d{5,}$"))
    day_first = F.rlike(text, F.lit(r"^\d{2}-\d{2}-\d{4}$"))
    iso = F.rlike(text, F.lit(r"^\d{4}(?:-|$)"))
    return (
        F.when(digits, F.timestamp_millis(F.nullif(text.try_cast("bigint"), F.lit(0))))
        .when(day_first, F.try_to_timestamp(text, F.lit("dd-MM-yyyy")))
        .when(iso, F.try_to_timestamp(text))
    )


def add_days(ts: Column, days: int) -> Column:
    return ts + F.make_dt_interval(days=F.lit(days))


def hours_since(ts: Column, as_of: Column, mode: str = "elapsed") -> Column:
    """Whole hours from `ts` to `as_of`; mode "component" drops whole days."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    hours = F.floor(micros / F.lit(3_600_000_000)).cast("bigint")
    if mode == "component":
        return F.pmod(hours, F.lit(24))
    if mode != "elapsed":
        raise ValueError(f"unknown mode {mode}")
    return hours


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def day_key(ts: Column) -> Column:
    return F.to_date(ts)


def local_time(ts: Column, zone: str = CYCLE_ZONE) -> Column:
    """Wall-clock time in `zone` of a UTC moment."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def cycle_label(local: Column) -> Column:
    """Cycle of the day a local wall-clock time falls into."""
    hour = F.hour(local)
    return (
        F.when(hour < CYCLE_HOURS["AFTERNOON"], F.lit("MORNING"))
        .when(hour < CYCLE_HOURS["NIGHT"], F.lit("AFTERNOON"))
        .when(hour.isNotNull(), F.lit("NIGHT"))
    )


def cycle_start(label: str, as_of: str | dt.datetime, zone: str = CYCLE_ZONE) -> dt.datetime:
    """UTC start of a cycle on the local day of `as_of`; an unknown label counts as NIGHT."""
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.fromisoformat(as_of)
    local = as_of.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone))
    hour = CYCLE_HOURS.get(label, CYCLE_HOURS["NIGHT"])
    start = local.replace(hour=hour, minute=0, second=0, microsecond=0)
    return start.astimezone(dt.timezone.utc).replace(tzinfo=None)


def render_in_zone(ts: Column, zone: str = CYCLE_ZONE, pattern: str = "d/M/yyyy, h:mm:ss a") -> Column:
    return F.date_format(local_time(ts, zone), pattern)


def from_parts(parts: Column) -> Column:
    """Timestamp from struct(year, month, day, hour, minute, second, nanosecond).

    Year, month and day are needed; the time of day defaults to zero and
    nanoseconds are cut to milliseconds.
    """
    zero = F.lit(0)
    millis = F.floor(F.coalesce(parts["nanosecond"], zero) / F.lit(1_000_000))
    seconds = (
        F.coalesce(parts["second"], zero).cast("decimal(16,6)")
        + (millis / F.lit(1000)).cast("decimal(16,6)")
    )
    return F.try_make_timestamp(
        parts["year"],
        parts["month"],
        parts["day"],
        F.coalesce(parts["hour"], zero),
        F.coalesce(parts["minute"], zero),
        seconds,
    )


# One document date in any of its shapes: plain text, {"$date": …} or date parts.
DATE_SHAPES = (
    "text STRING, wrapped STRUCT<`$date`: STRING>, "
    "parts STRUCT<year: INT, month: INT, day: INT, hour: INT, minute: INT, second: INT, nanosecond: BIGINT>"
)


def any_date(shape: Column) -> Column:
    """ISO text of a DATE_SHAPES struct, the first shape that yields a date."""
    return iso_text(
        F.coalesce(
            parse_posted_date(shape["text"]),
            parse_posted_date(shape["wrapped"]["$date"]),
            from_parts(shape["parts"]),
        )
    )


def unwrap_long(plain: Column, wrapped: Column) -> Column:
    """A number that may come as {"$numberLong": "…"}."""
    return F.coalesce(plain.cast("double"), wrapped["$numberLong"].try_cast("double"))
