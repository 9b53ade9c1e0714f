"""Inputs derived from the given tables. The SQL text is the same for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.session import prepare

# Schemas of the given tables, so that reading them starts no inference job.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; timestamps without zone become UTC timestamps."""
    df = spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in zoneless})


def _band(name: str, factor: int, modulus: int) -> str:
    return f"cast(cast(l_quantity AS bigint) * {factor} % {modulus} AS string) AS {name}"


_PLAIN_BANDS = ",\n  ".join(
    [_band(f"m{b}", i + 3, 13) for i, b in enumerate(range(30, 70, 5))]
    + [_band(f"f{b}", i + 2, 11) for i, b in enumerate(["00", "10", "15"])]
    + [_band(f"f{b}", i + 4, 17) for i, b in enumerate(range(30, 75, 5))]
)
_DAY = "replace(cast(cast({0} AS date) AS string), '-', '')"
_SHIP_DAY = _DAY.format("l_shipdate")

FLOW_RAW = f"""
SELECT cast(10000000 + l_partkey % 50 AS string) AS id, '0' AS x, '0' AS y,
  CASE l_returnflag WHEN 'A' THEN 'resident' WHEN 'N' THEN 'worker' ELSE 'visitor' END AS type,
  cast((l_orderkey * 7 + l_linenumber) % 24 AS string) AS timezn_cd,
  cast(cast(l_quantity AS bigint) * 3 % 11 AS string) AS m00, cast(cast(l_quantity AS bigint) * 5 % 11 AS string) AS m10,
  CASE WHEN l_linenumber = 7 THEN '' ELSE cast(cast(l_quantity AS bigint) * 7 % 11 AS string) END AS m15,
  cast(cast(l_quantity AS bigint) % 13 AS string) AS m20, CASE WHEN l_linenumber = 6 THEN 'x' ELSE '1.5' END AS m25,
  cast(l_linenumber AS string) AS m70, cast(cast(l_quantity AS bigint) % 7 AS string) AS f20, '2' AS f25,
  {_PLAIN_BANDS},
  cast(l_quantity AS string) AS total, cast(46130510 + l_suppkey % 10 AS string) AS admi_cd,
  CASE WHEN l_linenumber = 1 THEN cast(cast(l_shipdate AS date) AS string)
       WHEN l_linenumber = 2 THEN substring({_SHIP_DAY}, 1, 6)
       ELSE {_SHIP_DAY} END AS etl_ymd
FROM lineitem"""

KCB = f"""
SELECT 10000000 + l_partkey % 50 AS QID50, cast(substring({_SHIP_DAY}, 1, 6) AS int) AS BS_YR_MON,
  concat('S', cast(l_suppkey + l_linenumber % 3 * 7 AS string)) AS SIC_CD_LV4, cast(l_quantity AS bigint) AS SHOP_CNT,
  cast(l_linenumber AS bigint) AS OP_CNT, l_orderkey % 5 AS NEW_OPN_CNT, l_orderkey % 3 AS RUN_OUT_CNT,
  l_orderkey % 2 AS RUN_OUT2_CNT, cast(l_extendedprice AS decimal(18,2)) AS TOT_SALE_AMT,
  l_partkey % 4 AS TOT_SALES_AMT0_CNT, l_partkey % 7 AS TOT_SALES_AMT5_CNT, 0.0 AS WGS84_X
FROM lineitem"""

IND_CODE = """
SELECT concat('S', cast(s_suppkey AS string)) AS SIC_CD, concat('major', cast(s_suppkey % 3 AS string)) AS SIC_FST_CLSFY_ITM_NM,
  s_name AS SIC_SCND_CLSFY_ITM_NM FROM supplier"""

LOCAL_PAY = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS pay_no, cast(o_orderdate AS date) AS pay_date,
  concat('shop', cast(o_custkey AS string)) AS merchant, o_orderpriority AS ind_type,
  cast(o_totalprice AS decimal(18,2)) AS amount,
  CASE WHEN o_orderkey % 53 = 0 THEN '20250230'
       ELSE concat(cast(1925 + o_custkey % 75 AS string), lpad(cast(1 + o_custkey % 12 AS string), 2, '0'),
                   lpad(cast(1 + o_custkey % 28 AS string), 2, '0')) END AS birth,
  'private' AS home_address, 'private' AS merchant_address
FROM orders"""

MERCHANT_CELL = """
SELECT concat('shop', cast(c_custkey AS string)) AS merchant,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE cast(10000000 + c_custkey % 50 AS string) END AS grid_id
FROM customer"""

HEADS = """
SELECT concat(lpad(cast(c_custkey % 100 AS string), 2, '0'), '0101', cast(1 + c_custkey % 4 AS string),
              lpad(cast(c_custkey AS string), 6, '0')) AS jumin_head_sid,
  CASE WHEN c_custkey % 11 = 0 THEN '99' WHEN c_custkey % 2 = 0 THEN '10' ELSE '13' END AS jumin_state_code,
  CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE cast(4613000 + c_nationkey AS string) END AS jumin_rd_code,
  cast(9900 + c_nationkey AS string) AS jumin_regn_code,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE lpad(cast(c_custkey % 30 AS string), 4, '0') END AS jumin_bdng_orgno,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '0' ELSE '0002' END AS jumin_bdng_subno,
  CASE WHEN c_custkey % 5 = 0 THEN '2' WHEN c_custkey % 5 = 1 THEN '?' ELSE '1' END AS jumin_san,
  CASE WHEN c_custkey % 9 = 0 THEN '20250201000000' ELSE '20250301000000' END AS data_crtr_dt
FROM customer"""

MEMBERS = """
SELECT concat(lpad(cast(o_orderkey * 3 % 100 AS string), 2, '0'), '0101', cast(1 + o_orderkey % 4 AS string),
              lpad(cast(o_orderkey % 1000000 AS string), 6, '0')) AS jumin_sid,
  concat(lpad(cast(o_custkey % 100 AS string), 2, '0'), '0101', cast(1 + o_custkey % 4 AS string),
              lpad(cast(o_custkey AS string), 6, '0')) AS jumin_head_sid,
  CASE o_orderstatus WHEN 'P' THEN '10' WHEN 'F' THEN '43' ELSE '99' END AS jumin_state_code,
  CASE WHEN o_orderkey % 5 = 0 THEN '20250201000000' ELSE '20250301000000' END AS data_crtr_dt
FROM orders"""


def moves_sql(prefix: str) -> str:
    """Moves: members with their head's address columns under another prefix."""
    return f"""
SELECT m.jumin_sid, m.data_crtr_dt, h.jumin_rd_code AS {prefix}rd_code, h.jumin_regn_code AS {prefix}regn_code,
  h.jumin_bdng_orgno AS {prefix}bdng_orgno, h.jumin_bdng_subno AS {prefix}bdng_subno, h.jumin_san AS {prefix}san
FROM ({MEMBERS}) m JOIN ({HEADS}) h ON m.jumin_head_sid = h.jumin_head_sid"""


# Address register: the keys that heads have, built from the same numbers as HEADS but without
# the key function under test. Address texts repeat per building; every tenth cell id is too short.
ADDRESSES = """
SELECT DISTINCT concat(cast(code AS string), '-', lot, cast(main AS string), sub) AS addr_id,
  concat('street ', cast(code AS string), ' no ', cast(main AS string)) AS address
FROM (
  SELECT CASE WHEN c_custkey % 7 = 0 THEN 9900 + c_nationkey ELSE 4613000 + c_nationkey END AS code,
    CASE WHEN c_custkey % 5 = 0 THEN 'S' ELSE '' END AS lot, c_custkey % 30 AS main,
    CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN '-0' ELSE '-2' END AS sub
  FROM customer) k"""

ADDRESS_GRID = """
SELECT DISTINCT concat('street ', cast(code AS string), ' no ', cast(main AS string)) AS address,
  CASE WHEN main % 10 = 3 THEN concat('100000', cast(main % 10 AS string))
       ELSE cast(10000000 + (code + main) % 50 AS string) END AS grid_id
FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN 9900 + c_nationkey ELSE 4613000 + c_nationkey END AS code,
    c_custkey % 30 AS main FROM customer) k"""

WIFI_LOG = """
SELECT concat('dev', cast(user_id AS string)) AS client_mac_addr, ts AS logging_date, event_id % 5 AS event_id,
  event_type AS event_name, event_id % 197 AS ap_id FROM events"""

EVENT_DIM = """
SELECT DISTINCT event_id % 5 + 1 AS id, concat('kind', cast(event_id % 5 AS string)) AS name FROM events"""

AP_DIM = """
SELECT p_partkey AS ap_id, p_name AS ap_name,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 127500000 + p_partkey * 7919 % 500000 END AS lon_u,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 34600000 + p_partkey * 104729 % 400000 END AS lat_u
FROM part"""

AP_SUMMARY = """
SELECT date_trunc('hour', ts) AS std_date, user_id AS ap_id, cast(sum(cast(floor(value) AS bigint) % 4) AS bigint) AS cnt
FROM events GROUP BY 1, 2"""

AP_CELL = """
SELECT p_partkey AS ap_id, CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE cast(10000000 + p_partkey % 12 AS string) END AS grid_id
FROM part"""

# Flow beside the access-point summary: the cells and January 2024 hours of AP_SUMMARY, two types.
FLOW_SLOTS_RAW = """
SELECT cast(10000000 + o_custkey % 15 AS string) AS id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'resident' ELSE 'visitor' END AS type,
  cast(o_orderkey % 24 AS string) AS timezn_cd, concat('202401', lpad(cast(1 + o_orderkey % 31 AS string), 2, '0')) AS etl_ymd,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE cast(floor(o_totalprice / 1000) AS double) END AS total,
  cast(4613051000 + o_custkey % 10 AS string) AS admi_cd
FROM orders"""

CELLS = """
SELECT cast(10000000 + p_partkey AS string) AS id,
  127500000 + p_partkey % 50 * 10000 AS x0, 34600000 + cast(floor(p_partkey / 50) AS bigint) * 10000 AS y0,
  127510000 + p_partkey % 50 * 10000 AS x1, 34610000 + cast(floor(p_partkey / 50) AS bigint) * 10000 AS y1
FROM part"""

POINTS = """
SELECT c_custkey AS point_id,
  CASE WHEN c_custkey % 20 = 0 THEN 127500000 + c_custkey % 50 * 10000 ELSE 127500000 + c_custkey * 7919 % 520000 END AS lon_u,
  34600000 + c_custkey * 104729 % 420000 AS lat_u
FROM customer"""

# Slanted quadrilaterals, one per nation: corner offsets of their four edges.
_DISTRICT_SIDES = [(0, 0, 90000, 10000), (90000, 10000, 80000, 70000), (80000, 70000, 5000, 75000), (5000, 75000, 0, 0)]
DISTRICT_EDGES = " UNION ALL ".join(
    f"""
SELECT n_nationkey AS poly_id, {k} AS k, 127500000 + n_nationkey % 5 * 100000 + {ax} AS ax,
  34600000 + cast(floor(n_nationkey / 5) AS bigint) * 77000 + {ay} AS ay,
  127500000 + n_nationkey % 5 * 100000 + {bx} AS bx,
  34600000 + cast(floor(n_nationkey / 5) AS bigint) * 77000 + {by} AS by2 FROM nation"""
    for k, (ax, ay, bx, by) in enumerate(_DISTRICT_SIDES)
)

CELL_EDGES = f"""
SELECT id AS poly_id, k, CASE WHEN k IN (0, 3) THEN x0 ELSE x1 END AS ax, CASE WHEN k IN (0, 1) THEN y0 ELSE y1 END AS ay,
  CASE WHEN k IN (0, 1) THEN x1 ELSE x0 END AS bx, CASE WHEN k IN (0, 3) THEN y0 ELSE y1 END AS by2
FROM ({CELLS}) c CROSS JOIN (VALUES (0), (1), (2), (3)) AS e(k)"""

CENTRES = """
SELECT s_name AS center, 127500000 + s_suppkey * 110000 % 500000 AS lon_u, 34650000 + s_suppkey * 70000 % 300000 AS lat_u
FROM supplier"""


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the texts above over the given tables."""
    prepare(spark)
    for name in TABLE_SCHEMAS:
        if name in sql:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)
