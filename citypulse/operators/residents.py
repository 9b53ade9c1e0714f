"""Households, movers and residents by cell, from register snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.functions.people import RESIDENT_STATES, age_decade, age_from_id, sex_from_id
from citypulse.functions.values import address_key, is_valid_cell
from citypulse.operators.lookup import compose_lookups, latest_snapshot, map_column
from citypulse.schemas import ADDRESS_PARTS

HEAD_PREFIX, IN_PREFIX, OUT_PREFIX = "jumin_", "jumin_inr_", "jumin_exr_"


def with_address_key(df: DataFrame, prefix: str = HEAD_PREFIX) -> DataFrame:
    road, legal, main, sub, mountain = (F.col(prefix + part) for part in ADDRESS_PARTS)
    return df.withColumn("full_addr_id", address_key(road, legal, main, sub, mountain))


def address_cells(addresses: DataFrame, address_grid: DataFrame) -> DataFrame:
    """Address key to cell: ``addresses(addr_id, address)`` then ``address_grid(address, grid_id)``."""
    return compose_lookups(addresses, "addr_id", "address", address_grid, "address", "grid_id")


def _placed(df: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows whose address leads to a valid cell. ``cells(addr_id, grid_id)``, unique by ``addr_id``."""
    return map_column(df, "full_addr_id", cells, "addr_id", "grid_id", "grid_id").filter(
        is_valid_cell(F.col("grid_id"))
    )


def household_sizes(heads: DataFrame, members: DataFrame, as_of: str | None = None) -> DataFrame:
    """Head rows of the latest snapshot with the number of distinct members of the household.

    A household counts if a head row of the snapshot has a resident state. Members of all
    snapshots count, and a household without members has size 0.
    """
    current = latest_snapshot(heads, "data_crtr_dt", as_of)
    resident = (
        current.filter(F.col("jumin_state_code").isin(RESIDENT_STATES)).select("jumin_head_sid").distinct()
    )
    sizes = members.groupBy("jumin_head_sid").agg(F.countDistinct("jumin_sid").alias("member_count"))
    counted = resident.join(sizes, "jumin_head_sid", "left").select(
        "jumin_head_sid", F.coalesce("member_count", F.lit(0)).cast("bigint").alias("member_count")
    )
    return current.join(counted, "jumin_head_sid")


def households_by_cell(households: DataFrame, cells: DataFrame) -> DataFrame:
    """Households per cell, in total and with 1, 2, 3 and 4 or more members."""
    size = F.col("member_count")
    per_address = (
        with_address_key(households)
        .groupBy("full_addr_id")
        .agg(
            F.count("jumin_head_sid").alias("total_household_cnt"),
            F.count_if(size == 1).alias("mem_cnt1"),
            F.count_if(size == 2).alias("mem_cnt2"),
            F.count_if(size == 3).alias("mem_cnt3"),
            F.count_if(size >= 4).alias("mem_cnt4"),
        )
    )
    counts = ["total_household_cnt", "mem_cnt1", "mem_cnt2", "mem_cnt3", "mem_cnt4"]
    return _placed(per_address, cells).groupBy("grid_id").agg(*[F.sum(c).alias(c) for c in counts])


def _people_by_cell(people: DataFrame, prefix: str, cells: DataFrame) -> DataFrame:
    """Sum of ``people`` per cell, sex and decade; counted per address before the lookup."""
    per_address = (
        with_address_key(people, prefix)
        .groupBy("full_addr_id", "gender", "gens")
        .agg(F.sum("people").alias("people"))
    )
    return (
        _placed(per_address, cells)
        .na.drop(subset=["gender", "gens"])
        .groupBy("grid_id", "gender", "gens")
        .agg(F.sum("people").alias("member_cnt"))
    )


def _attributes(df: DataFrame, as_of_date: dt.date) -> DataFrame:
    resident_id = F.col("jumin_sid")
    return df.withColumns(
        {
            "gender": sex_from_id(resident_id),
            "gens": age_decade(age_from_id(resident_id, as_of_date)),
            "people": F.when(resident_id.isNotNull(), 1).otherwise(0).cast("bigint"),
        }
    )


def movers_by_cell(
    moves: DataFrame, prefix: str, cells: DataFrame, as_of_date: dt.date, as_of: str | None = None
) -> DataFrame:
    """Movers of the latest snapshot per cell, sex and decade; ``prefix`` names the address columns."""
    current = latest_snapshot(moves, "data_crtr_dt", as_of)
    return _people_by_cell(_attributes(current, as_of_date), prefix, cells)


def resident_rows(members: DataFrame, heads: DataFrame, as_of: str | None = None) -> DataFrame:
    """Members in a resident state at the latest snapshot, with their household's address if it has one."""
    current = latest_snapshot(members, "data_crtr_dt", as_of).filter(
        F.col("jumin_state_code").isin(RESIDENT_STATES)
    )
    address = latest_snapshot(heads, "data_crtr_dt", as_of).select(
        "jumin_head_sid", *[HEAD_PREFIX + part for part in ADDRESS_PARTS]
    )
    return current.join(address, "jumin_head_sid", "left")


def residents_by_cell(
    members: DataFrame, heads: DataFrame, cells: DataFrame, as_of_date: dt.date, as_of: str | None = None
) -> DataFrame:
    """Residents per cell, sex and decade.

    Members are counted per household, sex and decade before the join, so a head id with
    many members (a home, a barracks) joins as a few rows.
    """
    current = latest_snapshot(members, "data_crtr_dt", as_of).filter(
        F.col("jumin_state_code").isin(RESIDENT_STATES)
    )
    counted = (
        _attributes(current, as_of_date)
        .groupBy("jumin_head_sid", "gender", "gens")
        .agg(F.sum("people").alias("people"))
    )
    address = latest_snapshot(heads, "data_crtr_dt", as_of).select(
        "jumin_head_sid", *[HEAD_PREFIX + part for part in ADDRESS_PARTS]
    )
    return _people_by_cell(counted.join(address, "jumin_head_sid", "left"), HEAD_PREFIX, cells)
