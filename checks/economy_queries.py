"""Economy: business statistics and payments."""

from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import query
from citypulse.functions import dates, people
from citypulse.operators import economy
from citypulse.operators.lookup import map_column

AGED = f"""
SELECT p.*, strftime(pay_date, '%Y-%m') AS pay_month, strftime(pay_date, '%Y%m') AS std_ym,
  cast(year(pay_date) - year(born) - CASE WHEN month(pay_date) < month(born)
    OR (month(pay_date) = month(born) AND day(pay_date) < day(born)) THEN 1 ELSE 0 END AS integer) AS age
FROM (SELECT *, cast(try_strptime(birth, '%Y%m%d') AS date) AS born FROM ({I.LOCAL_PAY}) l) p"""
BAND = """CASE WHEN age > 10 AND age <= 20 THEN '10대 이하' WHEN age > 20 AND age <= 30 THEN '20대'
  WHEN age > 30 AND age <= 40 THEN '30대' WHEN age > 40 AND age <= 50 THEN '40대' WHEN age > 50 AND age <= 60 THEN '50대'
  WHEN age > 60 AND age <= 70 THEN '60대' WHEN age > 70 AND age <= 200 THEN '70대이상' END"""


@query(
    "business_stats",
    f"""
SELECT cast(QID50 AS varchar) AS grid_id, cast(BS_YR_MON AS varchar) AS std_ym, SIC_CD_LV4 AS sic_cd_lv4,
  SIC_FST_CLSFY_ITM_NM AS sic_fst_clsfy_itm_nm, SIC_SCND_CLSFY_ITM_NM AS sic_scnd_clsfy_itm_nm, SHOP_CNT AS shop_cnt,
  OP_CNT AS op_cnt, NEW_OPN_CNT AS new_opn_cnt, RUN_OUT_CNT AS run_out_cnt, cast(TOT_SALE_AMT AS double) AS tot_sale_amt,
  TOT_SALES_AMT0_CNT AS tot_sales_amt0_cnt, TOT_SALES_AMT5_CNT AS tot_sales_amt5m_cnt
FROM ({I.KCB}) k JOIN ({I.IND_CODE}) i ON k.SIC_CD_LV4 = i.SIC_CD""",
)
def business_stats(spark, sf_dir):
    rows = economy.business_stats(I.derived(spark, sf_dir, I.KCB), I.derived(spark, sf_dir, I.IND_CODE))
    return rows.withColumn("tot_sale_amt", F.col("tot_sale_amt").cast("double"))


@query(
    "payments_by_cell",
    f"""
SELECT m.grid_id, strftime(p.pay_date, '%Y%m') AS std_ym, p.ind_type, count(p.pay_no) AS pay_cnt,
  cast(sum(p.amount) AS double) AS pay_amt
FROM ({I.LOCAL_PAY}) p JOIN ({I.MERCHANT_CELL}) m ON p.merchant = m.merchant
WHERE m.grid_id IS NOT NULL GROUP BY ALL""",
)
def payments_by_cell(spark, sf_dir):
    rows = economy.payments_by_cell(I.derived(spark, sf_dir, I.LOCAL_PAY), I.derived(spark, sf_dir, I.MERCHANT_CELL))
    return rows.withColumn("pay_amt", F.col("pay_amt").cast("double"))


@query(
    "payments_with_age",
    f"""
SELECT a.merchant, a.ind_type, cast(a.amount AS double) AS amount, strftime(a.pay_date, '%Y-%m-%d') AS pay_date,
  strftime(a.born, '%Y-%m-%d') AS birth, m.grid_id, a.pay_month, a.std_ym, a.age, {BAND} AS age_band
FROM ({AGED}) a LEFT JOIN ({I.MERCHANT_CELL}) m ON a.merchant = m.merchant""",
)
def payments_with_age(spark, sf_dir):
    rows = economy.payments_with_age(I.derived(spark, sf_dir, I.LOCAL_PAY), I.derived(spark, sf_dir, I.MERCHANT_CELL))
    return rows.withColumns(
        {
            "amount": F.col("amount").cast("double"),
            "pay_date": F.date_format("pay_date", "yyyy-MM-dd"),
            "birth": F.date_format("birth", "yyyy-MM-dd"),
        }
    )


@query("payment_ages", f"SELECT pay_no, age FROM ({AGED}) a")
def payment_ages(spark, sf_dir):
    birth = F.try_to_date("birth", "yyyyMMdd")
    return I.derived(spark, sf_dir, I.LOCAL_PAY).select(
        "pay_no", dates.age_on(F.col("pay_date"), birth).alias("age")
    )


@query("payer_age_bands", f"SELECT {BAND} AS age_band, count(*) AS n FROM ({AGED}) a GROUP BY ALL")
def payer_age_bands(spark, sf_dir):
    age = dates.age_on(F.col("pay_date"), F.try_to_date("birth", "yyyyMMdd"))
    rows = I.derived(spark, sf_dir, I.LOCAL_PAY).select(people.age_band(age).alias("age_band"))
    return rows.groupBy("age_band").agg(F.count(F.lit(1)).alias("n"))


@query(
    "payment_month_keys",
    f"""
SELECT strftime(pay_date, '%Y%m') AS std_ym, strftime(pay_date, '%Y-%m') AS pay_month, count(*) AS n
FROM ({I.LOCAL_PAY}) p GROUP BY ALL""",
)
def payment_month_keys(spark, sf_dir):
    day = F.col("pay_date")
    keys = [dates.month_key(day).alias("std_ym"), dates.month_label(day).alias("pay_month")]
    return I.derived(spark, sf_dir, I.LOCAL_PAY).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "merchant_cell_lookup",
    f"SELECT p.pay_no, p.merchant, m.grid_id FROM ({I.LOCAL_PAY}) p LEFT JOIN ({I.MERCHANT_CELL}) m ON p.merchant = m.merchant",
)
def merchant_cell_lookup(spark, sf_dir):
    payments = I.derived(spark, sf_dir, I.LOCAL_PAY).select("pay_no", "merchant")
    return map_column(payments, "merchant", I.derived(spark, sf_dir, I.MERCHANT_CELL), "merchant", "grid_id", "grid_id", split_hot=True)
