"""Event times written as text."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Zone abbreviations and the offset each one stands for.
DEFAULT_ZONES: Mapping[str, str] = {
    "UTC": "+00:00",
    "GMT": "+00:00",
    "CET": "+01:00",
    "CEST": "+02:00",
    "EET": "+02:00",
    "EEST": "+03:00",
    "MSK": "+03:00",
    "IST": "+05:30",
    "JST": "+09:00",
    "EST": "-05:00",
    "EDT": "-04:00",
    "PST": "-08:00",
    "PDT": "-07:00",
}


def parse_java_date(
    text: Column | str, zones: Mapping[str, str] = DEFAULT_ZONES, on_unknown: str = "null"
) -> Column:
    """Instant of text such as ``Tue Nov 8 09:41:13 IST 2022``, NULL where it cannot be read.

    The day name is not looked at. The zone is an offset (``+05:30``, ``+0530``, ``GMT+05:30``) or goes through
    ``zones``, because an abbreviation by itself is ambiguous. Text that cannot be read, its zone being unknown or
    otherwise, gives NULL, or with ``on_unknown="fail"`` stops the query; ``unreadable_dates`` returns such rows.
    """
    if on_unknown not in ("null", "fail"):
        raise ValueError(f"on_unknown is 'null' or 'fail', not {on_unknown!r}")
    given = F.col(text) if isinstance(text, str) else text
    text = F.trim(F.col(text) if isinstance(text, str) else text)
    space = F.lit(" ")
    clock = F.substring_index(text, " ", 4)
    zone = F.substring_index(F.substring_index(text, " ", -2), " ", 1)
    year = F.substring_index(text, " ", -1)
    number = F.regexp_extract(zone, r"^(?:GMT|UTC)?([+-]\d\d):?(\d\d)$", 1)
    minutes = F.regexp_extract(zone, r"^(?:GMT|UTC)?([+-]\d\d):?(\d\d)$", 2)
    offset = F.when(number != "", F.concat(number, F.lit(":"), minutes))
    for name, value in zones.items():
        offset = F.when(zone == name, value).otherwise(offset)
    # concat is NULL where the zone is unknown.
    without_day = F.substr(clock, F.instr(clock, " ") + 1)
    readable = F.concat(without_day, space, offset, space, year)
    whole = F.concat(clock, space, zone, space, year) == text
    instant = F.when(whole, F.try_to_timestamp(readable, F.lit("MMM d HH:mm:ss XXX yyyy")))
    if on_unknown == "null":
        return instant
    stop = F.raise_error(F.concat(F.lit("no readable time: "), given)).cast("timestamp")
    return F.when(given.isNotNull() & instant.isNull(), stop).otherwise(instant)


def unreadable_dates(df: DataFrame, column: str, zones: Mapping[str, str] = DEFAULT_ZONES) -> DataFrame:
    """Rows with a text in ``column`` that ``parse_java_date`` cannot read."""
    return df.where(F.col(column).isNotNull() & parse_java_date(column, zones).isNull())
