"""Residents: address keys, households, movers, residents."""

import datetime as dt

from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import query
from citypulse.functions import people
from citypulse.functions.values import is_valid_cell
from citypulse.operators import residents
from citypulse.operators.lookup import latest_snapshot

AS_OF = dt.date(2025, 3, 1)


def key_sql(prefix):
    rd, regn, org, sub, san = (prefix + p for p in ("rd_code", "regn_code", "bdng_orgno", "bdng_subno", "san"))

    def number(c):
        return f"cast(cast(trunc(try_cast({c} AS double)) AS bigint) AS varchar)"

    code = f"CASE WHEN trim(coalesce({rd}, '')) = '' THEN {regn} ELSE {rd} END"
    return f"""CASE WHEN {number(code)} IS NULL OR {number(org)} IS NULL THEN 'undefined' ELSE
  {number(code)} || '-' || CASE WHEN trunc(try_cast({san} AS double)) = 2 THEN 'S' ELSE '' END || {number(org)}
  || coalesce('-' || {number(sub)}, '') END"""


CELL_OF_KEY = f"""
SELECT a.addr_id, g.grid_id FROM ({I.ADDRESSES}) a JOIN ({I.ADDRESS_GRID}) g ON a.address = g.address"""
SEX = "CASE WHEN try_cast(substring(jumin_sid, 7, 1) AS integer) % 2 = 1 THEN 'M' ELSE 'F' END"
AGE = "((25 - cast(substring(jumin_sid, 1, 2) AS integer)) % 100 + 100) % 100"
DECADE = f"cast(cast(floor({AGE} / 10) * 10 AS bigint) AS varchar)"
LATEST = "SELECT * FROM ({0}) t WHERE data_crtr_dt = (SELECT max(data_crtr_dt) FROM ({0}) u)"
LATEST_HEADS, LATEST_MEMBERS = LATEST.format(I.HEADS), LATEST.format(I.MEMBERS)
SIZES = f"""
SELECT h.jumin_head_sid, count(DISTINCT m.jumin_sid) AS member_count FROM ({LATEST_HEADS}) h
LEFT JOIN ({I.MEMBERS}) m ON h.jumin_head_sid = m.jumin_head_sid
WHERE h.jumin_state_code IN ('10', '13', '43') GROUP BY h.jumin_head_sid"""


def _cells(spark, sf_dir):
    return residents.address_cells(I.derived(spark, sf_dir, I.ADDRESSES), I.derived(spark, sf_dir, I.ADDRESS_GRID))


@query(
    "address_keys",
    f"SELECT jumin_head_sid, {key_sql('jumin_')} AS full_addr_id FROM ({I.HEADS}) h",
)
def address_keys(spark, sf_dir):
    return residents.with_address_key(I.derived(spark, sf_dir, I.HEADS)).select("jumin_head_sid", "full_addr_id")


@query(
    "resident_attributes",
    f"SELECT jumin_sid, {SEX} AS gender, {AGE} AS age, {DECADE} AS gens FROM ({I.MEMBERS}) m",
)
def resident_attributes(spark, sf_dir):
    resident_id = F.col("jumin_sid")
    age = people.age_from_id(resident_id, AS_OF)
    return I.derived(spark, sf_dir, I.MEMBERS).select(
        resident_id,
        people.sex_from_id(resident_id).alias("gender"),
        age.alias("age"),
        people.age_decade(age).alias("gens"),
    )


@query("valid_cells", f"SELECT address, grid_id FROM ({I.ADDRESS_GRID}) g WHERE grid_id IS NOT NULL AND length(grid_id) = 8")
def valid_cells(spark, sf_dir):
    return I.derived(spark, sf_dir, I.ADDRESS_GRID).filter(is_valid_cell(F.col("grid_id")))


@query(
    "resident_state_counts",
    f"""
SELECT jumin_state_code, count(*) AS n FROM ({I.MEMBERS}) m WHERE jumin_state_code IN ('10', '13', '43') GROUP BY ALL""",
)
def resident_state_counts(spark, sf_dir):
    rows = I.derived(spark, sf_dir, I.MEMBERS).filter(F.col("jumin_state_code").isin(people.RESIDENT_STATES))
    return rows.groupBy("jumin_state_code").agg(F.count(F.lit(1)).alias("n"))


@query("latest_snapshot", f"SELECT jumin_sid, data_crtr_dt FROM ({LATEST_MEMBERS}) m")
def newest_snapshot(spark, sf_dir):
    members = I.derived(spark, sf_dir, I.MEMBERS)
    return latest_snapshot(members, "data_crtr_dt").select("jumin_sid", "data_crtr_dt")


@query(
    "snapshot_as_of",
    f"SELECT jumin_sid, data_crtr_dt FROM ({I.MEMBERS}) m WHERE data_crtr_dt = '20250201000000'",
)
def snapshot_as_of(spark, sf_dir):
    members = I.derived(spark, sf_dir, I.MEMBERS)
    return latest_snapshot(members, "data_crtr_dt", as_of="20250201000000").select("jumin_sid", "data_crtr_dt")


@query(
    "address_to_cell_lookup",
    CELL_OF_KEY,
)
def address_to_cell_lookup(spark, sf_dir):
    return _cells(spark, sf_dir).select("addr_id", "grid_id")


@query(
    "household_sizes",
    f"""
SELECT h.jumin_head_sid, s.member_count, h.jumin_bdng_orgno FROM ({SIZES}) s
JOIN ({LATEST_HEADS}) h ON s.jumin_head_sid = h.jumin_head_sid""",
)
def household_sizes(spark, sf_dir):
    rows = residents.household_sizes(I.derived(spark, sf_dir, I.HEADS), I.derived(spark, sf_dir, I.MEMBERS))
    return rows.select("jumin_head_sid", "member_count", "jumin_bdng_orgno")


@query(
    "households_by_cell",
    f"""
SELECT c.grid_id, count(h.jumin_head_sid) AS total_household_cnt,
  count(*) FILTER (WHERE member_count = 1) AS mem_cnt1, count(*) FILTER (WHERE member_count = 2) AS mem_cnt2,
  count(*) FILTER (WHERE member_count = 3) AS mem_cnt3, count(*) FILTER (WHERE member_count >= 4) AS mem_cnt4
FROM (SELECT h.*, s.member_count, {key_sql('jumin_')} AS addr FROM ({SIZES}) s
  JOIN ({LATEST_HEADS}) h ON s.jumin_head_sid = h.jumin_head_sid) h
JOIN ({CELL_OF_KEY}) c ON h.addr = c.addr_id WHERE length(c.grid_id) = 8 GROUP BY c.grid_id""",
)
def households_by_cell(spark, sf_dir):
    sizes = residents.household_sizes(I.derived(spark, sf_dir, I.HEADS), I.derived(spark, sf_dir, I.MEMBERS))
    return residents.households_by_cell(sizes, _cells(spark, sf_dir))


def movers_sql(prefix):
    return f"""
SELECT c.grid_id, m.gender, m.gens, count(m.jumin_sid) AS member_cnt
FROM (SELECT jumin_sid, {SEX} AS gender, {DECADE} AS gens, {key_sql(prefix)} AS addr
  FROM ({LATEST.format(I.moves_sql(prefix))}) v) m
JOIN ({CELL_OF_KEY}) c ON m.addr = c.addr_id WHERE length(c.grid_id) = 8 GROUP BY ALL"""


@query("movers_in_by_cell", movers_sql("jumin_inr_"))
def movers_in_by_cell(spark, sf_dir):
    moves = I.derived(spark, sf_dir, I.moves_sql(residents.IN_PREFIX))
    return residents.movers_by_cell(moves, residents.IN_PREFIX, _cells(spark, sf_dir), AS_OF)


@query("movers_out_by_cell", movers_sql("jumin_exr_"))
def movers_out_by_cell(spark, sf_dir):
    moves = I.derived(spark, sf_dir, I.moves_sql(residents.OUT_PREFIX))
    return residents.movers_by_cell(moves, residents.OUT_PREFIX, _cells(spark, sf_dir), AS_OF)


RESIDENT_ROWS = f"""
SELECT m.jumin_sid, h.jumin_rd_code, h.jumin_regn_code, h.jumin_bdng_orgno, h.jumin_bdng_subno, h.jumin_san
FROM ({LATEST_MEMBERS}) m LEFT JOIN ({LATEST_HEADS}) h ON m.jumin_head_sid = h.jumin_head_sid
WHERE m.jumin_state_code IN ('10', '13', '43')"""


@query("resident_rows", RESIDENT_ROWS)
def resident_rows(spark, sf_dir):
    rows = residents.resident_rows(I.derived(spark, sf_dir, I.MEMBERS), I.derived(spark, sf_dir, I.HEADS))
    return rows.select(
        "jumin_sid", "jumin_rd_code", "jumin_regn_code", "jumin_bdng_orgno", "jumin_bdng_subno", "jumin_san"
    )


@query(
    "residents_by_cell",
    f"""
SELECT c.grid_id, r.gender, r.gens, count(r.jumin_sid) AS member_cnt
FROM (SELECT jumin_sid, {SEX} AS gender, {DECADE} AS gens, {key_sql('jumin_')} AS addr FROM ({RESIDENT_ROWS}) x) r
JOIN ({CELL_OF_KEY}) c ON r.addr = c.addr_id WHERE length(c.grid_id) = 8 GROUP BY ALL""",
)
def residents_by_cell(spark, sf_dir):
    return residents.residents_by_cell(
        I.derived(spark, sf_dir, I.MEMBERS), I.derived(spark, sf_dir, I.HEADS), _cells(spark, sf_dir), AS_OF
    )
