"""Air-quality index columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Concentration and index ranges (low, high, index low, index high) of each piece.
PM25_PIECES = (
    ("0.0", "12.0", 0, 50),
    ("12.1", "35.4", 51, 100),
    ("35.5", "55.4", 101, 150),
    ("55.5", "150.4", 151, 200),
    ("150.5", "250.4", 201, 300),
    ("250.5", "350.4", 301, 400),
    ("350.5", "500.4", 401, 500),
)
PM10_PIECES = (
    ("0", "54", 0, 50),
    ("55", "154", 51, 100),
    ("155", "254", 101, 150),
    ("255", "354", 151, 200),
    ("355", "424", 201, 300),
    ("425", "504", 301, 400),
    ("505", "604", 401, 500),
)
#: The highest index of levels 1 to 5; above is level 6.
LEVEL_TOPS = (50, 100, 150, 200, 300)


def aqi_linear(value: Column, c_lo: str, c_hi: str, i_lo: int, i_hi: int) -> Column:
    """The index on one piece, rounded half to even. The slope comes from exact decimals."""
    slope = float(Decimal(i_hi - i_lo) / (Decimal(c_hi) - Decimal(c_lo)))
    return F.rint((value - F.lit(float(c_lo))) * F.lit(slope) + F.lit(float(i_lo))).cast("int")


def _pieces(value: Column, pieces: tuple[tuple[str, str, int, int], ...]) -> Column:
    out = F.when(value.isNull() | (value < 0), F.lit(None).cast("int"))
    for piece in pieces:
        out = out.when(value <= float(piece[1]), aqi_linear(value, *piece))
    return out.otherwise(F.lit(500))


def aqi_pm25(value: Column) -> Column:
    """PM2.5 index; null for null or negative, 500 above the last piece."""
    return _pieces(value, PM25_PIECES)


def aqi_pm10(value: Column) -> Column:
    """PM10 index; null for null or negative, 500 above the last piece."""
    return _pieces(value, PM10_PIECES)


def aqi_level(aqi: Column) -> Column:
    """Level 1 to 6 of an index."""
    out = F.when(aqi.isNull(), F.lit(None).cast("int"))
    for level, top in enumerate(LEVEL_TOPS, 1):
        out = out.when(aqi <= top, F.lit(level))
    return out.otherwise(F.lit(6))


def overall_level(pm25: Column, pm10: Column) -> Column:
    """Level of the greater index; 1 where both are null."""
    return aqi_level(F.greatest(F.coalesce(pm25, F.lit(-1)), F.coalesce(pm10, F.lit(-1))))
