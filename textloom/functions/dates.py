"""Named date formats as expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Named formats and their datetime patterns, tried in order.
_T = "HH:mm:ss"
_Z = "[XXX][XX][X]"
PATTERNS: dict[str, tuple[str, ...]] = {
    "date_optional_time": (f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{_Z}", f"yyyy-MM-dd'T'HH:mm:ss.SSS{_Z}", f"yyyy-MM-dd'T'{_T}{_Z}", f"yyyy-MM-dd'T'HH:mm{_Z}", f"yyyy-MM-dd'T'HH{_Z}", "yyyy-MM-dd", "yyyy-MM", "yyyy"),
    "basic_date": ("yyyyMMdd",),
    "basic_date_time": (f"yyyyMMdd'T'HHmmss.SSS{_Z}",),
    "basic_date_time_no_millis": (f"yyyyMMdd'T'HHmmss{_Z}",),
    "basic_ordinal_date": ("yyyyDDD",),
    "basic_ordinal_date_time": (f"yyyyDDD'T'HHmmss.SSS{_Z}",),
    "basic_ordinal_date_time_no_millis": (f"yyyyDDD'T'HHmmss{_Z}",),
    "basic_time": (f"HHmmss.SSS{_Z}",),
    "basic_time_no_millis": (f"HHmmss{_Z}",),
    "basic_t_time": (f"'T'HHmmss.SSS{_Z}",),
    "basic_t_time_no_millis": (f"'T'HHmmss{_Z}",),
    "date": ("yyyy-MM-dd",),
    "date_hour": ("yyyy-MM-dd'T'HH",),
    "date_hour_minute": ("yyyy-MM-dd'T'HH:mm",),
    "date_hour_minute_second": (f"yyyy-MM-dd'T'{_T}",),
    "date_hour_minute_second_fraction": (f"yyyy-MM-dd'T'{_T}.SSSSSS", f"yyyy-MM-dd'T'{_T}.SSS"),
    "date_hour_minute_second_millis": (f"yyyy-MM-dd'T'{_T}.SSS",),
    "date_time": (f"yyyy-MM-dd'T'{_T}.SSSSSS{_Z}", f"yyyy-MM-dd'T'{_T}.SSS{_Z}"),
    "date_time_no_millis": (f"yyyy-MM-dd'T'{_T}{_Z}",),
    "hour": ("HH",),
    "hour_minute": ("HH:mm",),
    "hour_minute_second": (_T,),
    "hour_minute_second_fraction": (f"{_T}.SSSSSS", f"{_T}.SSS"),
    "hour_minute_second_millis": (f"{_T}.SSS",),
    "ordinal_date": ("yyyy-DDD",),
    "ordinal_date_time": (f"yyyy-DDD'T'{_T}.SSS{_Z}",),
    "ordinal_date_time_no_millis": (f"yyyy-DDD'T'{_T}{_Z}",),
    "time": (f"{_T}.SSSSSS{_Z}", f"{_T}.SSS{_Z}"),
    "time_no_millis": (f"{_T}{_Z}",),
    "t_time": (f"'T'{_T}.SSSSSS{_Z}", f"'T'{_T}.SSS{_Z}"),
    "t_time_no_millis": (f"'T'{_T}{_Z}",),
    "year": ("yyyy",),
    "year_month": ("yyyy-MM",),
    "year_month_day": ("yyyy-MM-dd",),
}
# Week-based formats: does a date part have dashes, a day, and which time follows.
WEEKS: dict[str, tuple[bool, bool, bool, str | None]] = {
    "basic_week_date": (False, True, True, None),
    "basic_week_date_time": (False, True, True, "HHmmss.SSS" + _Z),
    "basic_week_date_time_no_millis": (False, True, True, "HHmmss" + _Z),
    "week_date": (True, True, True, None),
    "week_date_time": (True, True, True, f"{_T}.SSS{_Z}"),
    "week_date_time_no_millis": (True, True, True, f"{_T}{_Z}"),
    "weekyear": (True, False, False, None),
    "weekyear_week": (True, True, False, None),
    "weekyear_week_day": (True, True, True, None),
}
NAMES = sorted(
    {"epoch_millis", "epoch_second", "strict_date_optional_time", "strict_date_optional_time_nanos", *PATTERNS, *WEEKS}
    | {f"strict_{n}" for n in (*PATTERNS, *WEEKS) if not (n.startswith("basic") and "week" not in n)}
)


_MICROS = re.compile("S{3,6}")


def micros(col: Column) -> Column:
    """A time text with its fraction of a second cut or filled to six digits."""
    digits = F.regexp_extract(col, r"\.(\d{1,9})(?:Z|[+-]\d{2}:?\d{2})?$", 1)
    six = F.rpad(F.substring(digits, 1, 6), 6, "0")
    return F.when(digits != "", F.regexp_replace(col, F.lit(r"\.\d{1,9}"), F.concat(F.lit("."), six))).otherwise(col)


def parse_date(col: Column, fmt: str | None = None) -> Column:
    """Text to a timestamp by a named format or a literal pattern; NULL where it does not fit."""
    fmt = fmt or "strict_date_optional_time"
    if fmt == "epoch_millis":
        return F.timestamp_millis(col.try_cast("bigint"))
    if fmt == "epoch_second":
        return F.timestamp_seconds(col.try_cast("bigint"))
    name = fmt.removeprefix("strict_").removesuffix("_nanos")
    if name in WEEKS:
        return _week(col, *WEEKS[name])
    tries = []
    # fractions of 1 to 9 digits are read as microseconds
    plain = micros(col) if name in PATTERNS else col
    for pattern in dict.fromkeys(_MICROS.sub("SSSSSS", p) for p in PATTERNS[name]) if name in PATTERNS else (fmt,):
        value = plain
        if name in PATTERNS and not pattern.startswith("yyyy"):
            # a time of day is a time on the first day of the epoch
            value, pattern = F.concat(F.lit("1970-01-01 "), plain), f"yyyy-MM-dd {pattern}"
        # only this format may leave its zone out
        open_end = ("",) if name == "date_optional_time" else ()
        for zone in (*ZONES, *open_end) if _Z in pattern else ("",):
            full = pattern.replace(_Z, zone)
            parsed = F.try_to_timestamp(value, F.lit(full))
            # named patterns have a fixed shape: test it first, as a failed parse is far dearer than a regex
            tries.append(F.when(value.rlike(shape(full)), parsed) if name in PATTERNS else parsed)
    return F.coalesce(*tries)


# Zone letters and the texts they stand for.
ZONES = {"XXX": r"(?:Z|[+-]\d{2}:\d{2})", "XX": r"[+-]\d{4}"}


def shape(pattern: str) -> str:
    """Regex of the texts that a datetime pattern can read, digit by digit."""
    out, i = "^", 0
    while i < len(pattern):
        c = pattern[i]
        zone = next((z for z in ZONES if pattern.startswith(z, i)), None)
        if zone:
            out, i = out + ZONES[zone], i + len(zone)
        elif c == "'":
            end = pattern.index("'", i + 1)
            out, i = out + pattern[i + 1 : end], end + 1
        else:
            out, i = out + (r"\d" if c.isalpha() else "\\" + c), i + 1
    return out + "$"


def _week(col: Column, dashes: bool, with_week: bool, with_day: bool, time: str | None) -> Column:
    """ISO week dates: week 1 is the week of 4 January, weeks begin on Monday."""
    dash = "-" if dashes else ""
    rx = r"^(\d{4})" + (rf"{dash}W(\d{{2}})" if with_week else "") + (rf"{dash}([1-7])" if with_day else "") + (r"T(.*)$" if time else "$")
    part = lambda i: F.regexp_extract(col, rx, i).try_cast("int")
    year = part(1)
    week = part(2) if with_week else F.lit(1)
    day = part(3) if with_day else F.lit(1)
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(jan4, F.weekday(jan4))
    date = F.date_add(monday, (week - 1) * 7 + (day - 1))
    if time is None:
        return F.when(col.rlike(rx), date.cast("timestamp"))
    clock = F.regexp_extract(col, rx, 4)
    stamp = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" "), micros(clock))
    tries = [F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd " + _MICROS.sub("SSSSSS", time).replace(_Z, z))) for z in ("XXX", "XX")]
    return F.when(col.rlike(rx), F.coalesce(*tries))
