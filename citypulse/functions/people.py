"""Sex, age and age bands from resident ids and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges and labels of the payer age bands, youngest first.
AGE_BAND_EDGES = [10, 20, 30, 40, 50, 60, 70, 200]
AGE_BAND_LABELS = ["10대 이하", "20대", "30대", "40대", "50대", "60대", "70대이상"]
# Resident states that count as living in the city.
RESIDENT_STATES = ["10", "13", "43"]


def sex_from_id(resident_id: Column) -> Column:
    """Odd seventh character is M; anything else, also a missing id, is F."""
    digit = F.substring(resident_id, 7, 1).try_cast("int")
    return F.when(digit % 2 == 1, "M").otherwise("F")


def age_from_id(resident_id: Column, as_of: dt.date) -> Column:
    """Age from the two-digit birth year, 0 to 99, in the year of ``as_of``."""
    birth_year = F.substring(resident_id, 1, 2).try_cast("int")
    return F.pmod(F.lit(as_of.year % 100) - birth_year, F.lit(100))


def age_decade(age: Column) -> Column:
    """Start of the ten-year band, as text."""
    return (F.floor(age / F.lit(10)) * F.lit(10)).cast("bigint").cast("string")


def age_band(age: Column, left_closed: bool = False) -> Column:
    """Band label. Bands exclude their lower and include their upper edge, so 20 is in the first.

    ``left_closed=True`` includes the lower edge instead, so 20 is in the second.
    """
    band = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(AGE_BAND_EDGES, AGE_BAND_EDGES[1:], AGE_BAND_LABELS))):
        inside = (age >= low) & (age < high) if left_closed else (age > low) & (age <= high)
        band = F.when(inside, F.lit(label)).otherwise(band)
    return band
