"""Flow: load transform and month reports."""

from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import query
from citypulse.functions import dates, values
from citypulse.operators import flow
from citypulse.operators.lookup import unique_lookup
from citypulse.schemas import FIVE_YEAR_COLUMNS, SEXES, TEN_YEAR_BANDS, TEN_YEAR_COLUMNS

MONTH, MONTH_START, NEXT_START = "199712", "1997-12-01", "1998-01-01"


def _num(column):
    return f"coalesce(try_cast({column} AS double), 0)"


_BANDS = ", ".join(
    (f"try_cast({sex}{band} AS double)" if len(parts) == 1 else " + ".join(_num(sex + p) for p in parts))
    + f" AS {sex}{band}"
    for sex in SEXES
    for band, parts in TEN_YEAR_BANDS.items()
)
MART = f"""
SELECT id, type, timezn_cd, {_BANDS}, try_cast(total AS double) AS total,
  cast(cast(admi_cd AS bigint) * 100 AS varchar) AS admi_cd,
  CASE WHEN contains(etl_ymd, '-') THEN cast(etl_ymd AS date)
       WHEN length(etl_ymd) = 8 THEN cast(strptime(etl_ymd, '%Y%m%d') AS date)
       ELSE cast(strptime(concat(etl_ymd, '01'), '%Y%m%d') AS date) END AS etl_ymd
FROM ({I.FLOW_RAW}) r"""
IN_MONTH = f"SELECT * FROM ({MART}) m WHERE etl_ymd >= '{MONTH_START}' AND etl_ymd < '{NEXT_START}'"


def _rounded(expression):
    return f"cast(round(cast({expression} AS decimal(38,10)), 2) AS double)"


def _mart(spark, sf_dir):
    return flow.normalize_flow(I.derived(spark, sf_dir, I.FLOW_RAW))


def _plain(df):
    return df.withColumn("total_population", F.col("total_population").cast("double"))


@query("flow_normalized", f"SELECT * REPLACE (strftime(etl_ymd, '%Y-%m-%d') AS etl_ymd) FROM ({MART}) m")
def flow_normalized(spark, sf_dir):
    return _mart(spark, sf_dir).withColumn("etl_ymd", F.date_format("etl_ymd", "yyyy-MM-dd"))


@query(
    "lenient_numbers",
    f"SELECT {', '.join(f'cast(sum({_num(c)}) AS double) AS {c}' for c in FIVE_YEAR_COLUMNS)} FROM ({I.FLOW_RAW}) r",
)
def lenient_numbers(spark, sf_dir):
    raw = I.derived(spark, sf_dir, I.FLOW_RAW)
    return raw.agg(*[F.sum(values.lenient_double(F.col(c))).alias(c) for c in FIVE_YEAR_COLUMNS])


@query(
    "date_text_normalized",
    f"SELECT strftime(etl_ymd, '%Y-%m-%d') AS day, count(*) AS n FROM ({MART}) m GROUP BY ALL",
)
def date_text_normalized(spark, sf_dir):
    raw = I.derived(spark, sf_dir, I.FLOW_RAW)
    day = F.date_format(dates.date_from_text(F.col("etl_ymd")), "yyyy-MM-dd").alias("day")
    return raw.groupBy(day).agg(F.count(F.lit(1)).alias("n"))


@query(
    "flow_rows_per_month",
    f"SELECT strftime(etl_ymd, '%Y%m') AS crtr_ym, count(*) AS n FROM ({MART}) m GROUP BY ALL",
)
def flow_rows_per_month(spark, sf_dir):
    return flow.with_month(_mart(spark, sf_dir)).groupBy("crtr_ym").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flow_by_sex_age",
    f"""
SELECT '{MONTH}' AS crtr_ym, type, upper(substring(band, 1, 1)) AS gender, substring(band, 2) AS age,
  {_rounded('people')} AS total_population
FROM (SELECT type, {', '.join(f'sum({c}) AS {c}' for c in TEN_YEAR_COLUMNS)} FROM ({IN_MONTH}) m GROUP BY type)
UNPIVOT INCLUDE NULLS (people FOR band IN ({', '.join(TEN_YEAR_COLUMNS)}))""",
)
def flow_by_sex_age(spark, sf_dir):
    return _plain(flow.flow_by_sex_age(_mart(spark, sf_dir), MONTH))


def _report_sql(select, keys):
    return f"SELECT '{MONTH}' AS crtr_ym, {select}, {_rounded('sum(total)')} AS total_population FROM ({IN_MONTH}) m GROUP BY {keys}"


@query("flow_by_hour", _report_sql("timezn_cd, type", "timezn_cd, type"))
def flow_by_hour(spark, sf_dir):
    return _plain(flow.flow_by_hour(_mart(spark, sf_dir), MONTH))


@query("flow_by_weekday", _report_sql("lower(strftime(etl_ymd, '%a')) AS dayname, type", "dayname, type"))
def flow_by_weekday(spark, sf_dir):
    return _plain(flow.flow_by_weekday(_mart(spark, sf_dir), MONTH))


@query(
    "flow_by_district_day",
    f"SELECT * REPLACE (strftime(etl_ymd, '%Y-%m-%d') AS etl_ymd) FROM ({_report_sql('admi_cd, etl_ymd', 'admi_cd, etl_ymd')}) r",
)
def flow_by_district_day(spark, sf_dir):
    rows = _plain(flow.flow_by_district_day(_mart(spark, sf_dir), MONTH))
    return rows.withColumn("etl_ymd", F.date_format("etl_ymd", "yyyy-MM-dd"))


@query(
    "flow_reports_from_month_sums",
    f"SELECT 'hour' AS report, timezn_cd AS part, type, total_population FROM ({_report_sql('timezn_cd, type', 'timezn_cd, type')}) a"
    f" UNION ALL SELECT 'weekday', dayname, type, total_population FROM ({_report_sql(chr(10).join(['lower(strftime(etl_ymd, ', chr(39) + '%a' + chr(39) + ')) AS dayname, type']), 'dayname, type')}) b",
)
def flow_reports_from_month_sums(spark, sf_dir):
    sums = flow.month_sums(_mart(spark, sf_dir), MONTH)
    hours = flow.flow_by_hour(sums, MONTH).select(
        F.lit("hour").alias("report"), F.col("timezn_cd").alias("part"), "type", "total_population"
    )
    days = flow.flow_by_weekday(sums, MONTH).select(
        F.lit("weekday").alias("report"), F.col("dayname").alias("part"), "type", "total_population"
    )
    return _plain(hours.unionByName(days))


@query(
    "flow_extract",
    f"SELECT id, etl_ymd, timezn_cd, admi_cd, sum(cast(total AS double)) AS total FROM ({I.FLOW_RAW}) r GROUP BY ALL",
)
def flow_extract(spark, sf_dir):
    return flow.flow_extract(I.derived(spark, sf_dir, I.FLOW_RAW))


@query(
    "cell_district_lookup",
    f"""
SELECT id, arg_max(admi_cd, ordinal) AS admi_cd FROM (SELECT cast(10000000 + l_partkey % 50 AS varchar) AS id,
  cast(46130510 + l_suppkey % 10 AS varchar) AS admi_cd, l_orderkey * 10 + l_linenumber AS ordinal FROM lineitem) r GROUP BY id""",
)
def cell_district_lookup(spark, sf_dir):
    rows = I.derived(
        spark,
        sf_dir,
        "SELECT cast(10000000 + l_partkey % 50 AS string) AS id, cast(46130510 + l_suppkey % 10 AS string) AS admi_cd,"
        " l_orderkey * 10 + l_linenumber AS ordinal FROM lineitem",
    )
    return unique_lookup(rows, "id", "admi_cd", "ordinal")


@query(
    "slot_timestamps",
    f"""
SELECT strftime(strptime(concat(etl_ymd, lpad(timezn_cd, 2, '0')), '%Y%m%d%H'), '%Y-%m-%d %H:%M:%S') AS slot, count(*) AS n
FROM ({I.FLOW_SLOTS_RAW}) f GROUP BY ALL""",
)
def slot_timestamps(spark, sf_dir):
    raw = I.derived(spark, sf_dir, I.FLOW_SLOTS_RAW)
    slot = dates.slot_timestamp(F.col("etl_ymd"), F.col("timezn_cd"))
    return raw.groupBy(F.date_format(slot, "yyyy-MM-dd HH:mm:ss").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
