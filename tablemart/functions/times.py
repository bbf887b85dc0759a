"""Wall-clock and instant handling on TIMESTAMP_NTZ, so the session zone never matters."""

from pyspark.sql import functions as F

LOCAL_ZONE = "America/Chicago"
# The hour of day that a zone skips in spring, in all of its history. Times of other hours stay as they are.
SKIPPED_HOUR = {LOCAL_ZONE: "02"}

# A date, optionally with a time. Bare clock times ('10:00') and words ('now') depend on the
# day of the run and are refused.
_DATED = r"^\s*[0-9]{4}(-[0-9]{1,2}){0,2}(\s*$|[ T])"
# A time that is followed by anything names its zone: Z, an offset or a region.
ZONED = r"[0-9][ T][0-9]{1,2}(:[0-9]{1,2}){0,2}([.,][0-9]*)?\s*[A-Za-z+-]"
# The usual text: date and time with seconds, without a zone.
_PLAIN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z"
_ZONED_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)\z"
)


def utc_wall_clock(instant):
    """The UTC wall-clock value of an instant, whatever the session zone is."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def local_wall_clock(column, zone=LOCAL_ZONE):
    """Local wall-clock time of timestamp text; NULL when the text is not a timestamp.

    Text with an offset is moved to `zone`. A wall-clock time that the zone skips in spring is
    moved forward by the length of the gap, as every zone-aware reader does. Plain text of an hour that
    the zone never skips, nearly all text, is the time it says and asks neither patterns nor zone rules.
    """
    local = F.lit(zone)
    instant = utc_wall_clock(column.try_cast("timestamp"))
    said = column.try_cast("timestamp_ntz")
    judged = F.when(
        column.rlike(_DATED),
        F.when(column.rlike(ZONED), F.convert_timezone(F.lit("UTC"), local, instant)).otherwise(
            F.convert_timezone(local, local, said)
        ),
    )
    if zone not in SKIPPED_HOUR:
        return judged
    usual = column.rlike(_PLAIN) & (F.substring(column, 12, 2) != SKIPPED_HOUR[zone])
    return F.when(usual, said).otherwise(judged)


def utc_from_iso(column):
    """UTC wall-clock time of extended ISO-8601 text that names its zone; NULL otherwise."""
    full = F.regexp_replace(
        F.translate(column, ",", "."), "^(.{10}[ T][0-9]{2}:[0-9]{2})([Z+-])", "$1:00$2"
    )
    return F.when(column.rlike(_ZONED_ISO), utc_wall_clock(full.try_cast("timestamp")))


def iso_utc_text(stamp):
    """ISO text with +00:00 of a UTC wall-clock value; the fraction only when there is one."""
    return F.concat(F.translate(stamp.cast("string"), " ", "T"), F.lit("+00:00"))


def canonical_iso(column):
    """ISO text with +00:00 of extended ISO-8601 text that names its zone; NULL otherwise.

    Text in UTC with seconds, the usual case, only needs its zeros trimmed once it is known to
    be a date that exists; without its Z that takes no look at zones.
    """
    clock = F.substring(column, F.lit(1), F.length(column) - 1)
    fraction = F.substring(clock, F.lit(20), F.length(clock))
    trimmed = F.concat(F.substring(clock, 1, 19), F.rtrim(F.rtrim(fraction, F.lit("0")), F.lit(".")))
    return F.when(
        column.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?Z\z"),
        F.when(
            clock.try_cast("timestamp_ntz").isNotNull(),
            F.concat(F.when(F.endswith(column, F.lit("0Z")), trimmed).otherwise(clock), F.lit("+00:00")),
        ),
    ).otherwise(iso_utc_text(utc_from_iso(column)))


def outbox_text(stamp):
    """ISO text with microseconds and Z of a UTC wall-clock value."""
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def local_hour_text(stamp):
    """Join key of the hour that holds a local wall-clock value."""
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:00:00")


def hour_of_day_text(day, hour):
    """The same join key of the hour with that number of a day."""
    return local_hour_text(F.timestamp_add("HOUR", hour, day.cast("timestamp_ntz")))


def utc_to_local(stamp, zone=LOCAL_ZONE):
    """Local wall-clock value of a UTC wall-clock value."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), stamp)
