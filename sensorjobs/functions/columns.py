"""Column functions for keys, text and time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands for a null key part (a fixed value: keys must equal those made elsewhere).
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """Signed 64-bit key: the first 16 hex digits of the md5 of the parts joined by '-'."""
    text = F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_KEY)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")


def key_time(ts: Column) -> Column:
    """The one text form of a time within keys, whatever the session prints."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss'+00'")


def parse_local_timestamp(date: Column, time: Column, offset_hours: int = 3) -> Column:
    """'d-M-yyyy' and 'H:mm' of a wall clock ``offset_hours`` behind UTC, as UTC; null if unreadable."""
    local = F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("d-M-yyyy H:mm"))
    return F.when(date.isNotNull() & time.isNotNull(), local + F.expr(f"INTERVAL {offset_hours} HOURS"))


def is_valid_time(ts: Column, first: str = "2018-01-01 00:00:00") -> Column:
    """Parsed and not before ``first``; never null."""
    return F.coalesce(ts >= F.lit(first).cast("timestamp"), F.lit(False))


def station_code_from_name(table: Column, prefix: str = "fiuna") -> Column:
    """'FIUNA_Estacion7' gives 'fiuna_7'."""
    return F.concat(F.lit(f"{prefix}_"), F.regexp_replace(F.lower(table), f"^{prefix}_estacion", ""))


def blank_to_null(text: Column) -> Column:
    """Empty text as null."""
    return F.nullif(text, F.lit(""))


def bbox_text(lat: Column, lon: Column, km: float = 5.0) -> Column:
    """'min_lon,min_lat,max_lon,max_lat' of a box of ``km`` around a point, six decimals; null without a point."""
    d_lat = F.lit(km / 111.0)
    narrow = F.cos(F.radians(lat))
    d_lon = F.when(narrow == 0, F.lit(0.0)).otherwise(F.lit(km) / (F.lit(111.0) * narrow))
    corners = [lon - d_lon, lat - d_lat, lon + d_lon, lat + d_lat]
    text = F.concat_ws(",", *[c.cast("decimal(18,6)").cast("string") for c in corners])
    return F.when(lat.isNotNull() & lon.isNotNull(), text)


def display_name(name: Column, properties: Column) -> Column:
    """The name, prefixed by the network that the JSON properties name (the networks' names are fixed values of the data)."""
    source = F.lower(F.coalesce(F.get_json_object(properties, "$.source"), F.lit("")))
    return F.when(source == "fiuna", F.concat(F.lit("FIUNA: "), name)).when(source == "airelibre", F.concat(F.lit("AireLibre: "), name)).otherwise(name)


def is_weather(properties: Column) -> Column:
    """Whether the JSON properties name the weather network; missing counts as no."""
    return F.coalesce(F.get_json_object(properties, "$.source"), F.lit("")) == "Meteostat"


def skew_from_moments(m1: Column, m2: Column, m3: Column, std: Column) -> Column:
    """Population skewness from the raw moments; null for a flat series."""
    cube = F.pow(std, F.lit(3.0))
    return (m3 - F.lit(3.0) * m1 * m2 + F.lit(2.0) * F.pow(m1, F.lit(3.0))) / F.nullif(cube, F.lit(0.0))


def steady_avg(value: Column) -> Column:
    """Mean of doubles in an aggregate, the same for any order of the rows: their rounded exact sum by their count.

    Values are added as whole numbers of two parts, above and below 2**-20. If one of them has digits below 2**-62 or is past the range of
    the parts (also NaN), or if a sum of parts overflows, the mean is the plain one.
    """
    v = value.cast("double")
    scaled = v * F.lit(2.0**20)
    upper = F.floor(scaled)
    rest = (scaled - upper.cast("double")) * F.lit(2.0**42)
    lower = F.floor(rest)
    held = (F.abs(scaled) < 2.0**62) & (lower.cast("double") == rest)
    high, low = F.try_sum(F.when(held, upper)), F.try_sum(F.when(held, lower))
    # The carry leaves a lower part under 2**42, so that one addition rounds.
    carry = F.shiftright(low, 42)
    total = (F.try_add(high, carry).cast("double") + (low - F.shiftleft(carry, 42)).cast("double") / F.lit(2.0**42)) / F.lit(2.0**20)
    return F.when(F.count(v) == F.count(F.when(held, v)), F.coalesce(total / F.count(v), F.avg(v))).otherwise(F.avg(v))


def all_of(conditions: list[Column]) -> Column:
    """Conjunction; true for none."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
