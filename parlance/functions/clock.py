"""Clock arithmetic on conversation timestamps.

Hours and weekdays are those of the session time zone, which should be UTC.
"""
from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column


def offset_seconds(gmt_offset="gmt_offset") -> Column:
    """Seconds of a struct<hours, minutes> offset."""
    o = as_column(gmt_offset)
    return o["hours"].cast("long") * 3600 + o["minutes"].cast("long") * 60


def shifted_by_offset(timestamp="timestamp", gmt_offset="gmt_offset") -> Column:
    """Local time by the stored offset, to the second; NULL without an offset."""
    return (F.unix_timestamp(as_column(timestamp)) + offset_seconds(gmt_offset)).cast("timestamp")


def shifted_by_zone(timestamp="timestamp", zone="timezone") -> Column:
    """Local time by zone name, right on both sides of a daylight-saving change."""
    return F.from_utc_timestamp(as_column(timestamp), as_column(zone))


def month_start(year, month) -> Column:
    """First midnight of a month as a timestamp."""
    return F.make_date(as_column(year), as_column(month), F.lit(1)).cast("timestamp")


def in_hour_bands(hour, bands) -> Column:
    """True inside any of the closed bands, e.g. ``[(20, 23), (0, 7)]``."""
    h = as_column(hour)
    hit = F.lit(False)
    for low, high in bands:
        hit = hit | h.between(low, high)
    return hit
