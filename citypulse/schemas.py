"""Explicit schemas of the inputs and result tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Five-year age bands in a flow file, per sex, in file order.
FIVE_YEAR_BANDS = ["00", "10", "15", "20", "25", "30", "35", "40", "45", "50", "55", "60", "65", "70"]
# Ten-year bands kept after loading, and the file bands each one sums.
TEN_YEAR_BANDS = {
    "10": ["00", "10", "15"],
    "20": ["20", "25"],
    "30": ["30", "35"],
    "40": ["40", "45"],
    "50": ["50", "55"],
    "60": ["60", "65"],
    "70": ["70"],
}
SEXES = ["m", "f"]

FIVE_YEAR_COLUMNS = [sex + band for sex in SEXES for band in FIVE_YEAR_BANDS]
TEN_YEAR_COLUMNS = [sex + band for sex in SEXES for band in TEN_YEAR_BANDS]


def _fields(kind: T.DataType, names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


_TEXT, _LONG, _DOUBLE, _MONEY = T.StringType(), T.LongType(), T.DoubleType(), T.DecimalType(18, 2)

FLOW_FILE = T.StructType(
    _fields(_TEXT, ["id", "x", "y", "type", "timezn_cd"])
    + _fields(_DOUBLE, [*FIVE_YEAR_COLUMNS, "total"])
    + _fields(_TEXT, ["admi_cd", "etl_ymd"])
)

FLOW_MART = T.StructType(
    _fields(_TEXT, ["id", "type", "timezn_cd"])
    + _fields(_DOUBLE, [*TEN_YEAR_COLUMNS, "total"])
    + [T.StructField("admi_cd", _TEXT), T.StructField("etl_ymd", T.DateType(), False)]
)

BUSINESS_FILE = T.StructType(
    _fields(_LONG, ["QID50", "BS_YR_MON"])
    + _fields(_TEXT, ["SIC_CD_LV4"])
    + _fields(_LONG, ["SHOP_CNT", "OP_CNT", "NEW_OPN_CNT", "RUN_OUT_CNT", "RUN_OUT2_CNT"])
    + _fields(_MONEY, ["TOT_SALE_AMT"])
    + _fields(_LONG, [f"TOT_SALES_AMT{i}_CNT" for i in range(6)])
    + _fields(_DOUBLE, ["WGS84_X", "WGS84_Y", "UTMK_X", "UTML_Y"])
)

INDUSTRY_FILE = T.StructType(_fields(_TEXT, ["SIC_CD", "SIC_FST_CLSFY_ITM_NM", "SIC_SCND_CLSFY_ITM_NM"]))

# Headers of a payment file and the names used here.
PAYMENT_HEADERS = {
    "번호": "pay_no",
    "결제년월일": "pay_date",
    "가맹점명": "merchant",
    "업종": "ind_type",
    "결제금액": "amount",
    "생년월일": "birth",
    "거주지주소": "home_address",
    "가맹점주소": "merchant_address",
}
PAYMENT_FILE = T.StructType(
    [T.StructField(name, _MONEY if name == "결제금액" else _TEXT) for name in PAYMENT_HEADERS]
)

ADDRESS_PARTS = ["rd_code", "regn_code", "bdng_orgno", "bdng_subno", "san"]

HOUSEHOLD_HEADS = T.StructType(
    _fields(
        _TEXT,
        ["jumin_head_sid", "jumin_head_sid_sno", "jumin_state_code"]
        + [f"jumin_{part}" for part in ADDRESS_PARTS]
        + ["jumin_inport_ymd", "data_crtr_dt"],
    )
)
MEMBERS = T.StructType(_fields(_TEXT, ["jumin_sid", "jumin_head_sid", "jumin_state_code", "data_crtr_dt"]))

AP_SUMMARY = T.StructType(
    [
        T.StructField("std_date", T.TimestampType()),
        T.StructField("ap_id", _TEXT),
        T.StructField("cnt", _LONG),
    ]
)

# Result tables with the columns that must not be NULL.
RESULT_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "flow": (FLOW_MART, ["etl_ymd"]),
    "flow_by_sex_age": (
        T.StructType(_fields(_TEXT, ["crtr_ym", "type", "gender", "age"]) + _fields(_MONEY, ["total_population"])),
        [],
    ),
    "flow_by_hour": (
        T.StructType(_fields(_TEXT, ["crtr_ym", "timezn_cd", "type"]) + _fields(_MONEY, ["total_population"])),
        [],
    ),
    "flow_by_weekday": (
        T.StructType(_fields(_TEXT, ["crtr_ym", "dayname", "type"]) + _fields(_MONEY, ["total_population"])),
        [],
    ),
    "flow_by_district_day": (
        T.StructType(
            _fields(_TEXT, ["crtr_ym", "admi_cd"])
            + [T.StructField("etl_ymd", T.DateType())]
            + _fields(_MONEY, ["total_population"])
        ),
        [],
    ),
    "business_stats": (
        T.StructType(
            _fields(
                _TEXT,
                ["grid_id", "std_ym", "sic_cd_lv4", "sic_fst_clsfy_itm_nm", "sic_scnd_clsfy_itm_nm"],
            )
            + _fields(_LONG, ["shop_cnt", "op_cnt", "new_opn_cnt", "run_out_cnt"])
            + _fields(_MONEY, ["tot_sale_amt"])
            + _fields(_LONG, ["tot_sales_amt0_cnt", "tot_sales_amt5m_cnt"])
            + [T.StructField("reg_dttm", T.TimestampType())]
        ),
        ["grid_id", "std_ym"],
    ),
    "payments_by_cell": (
        T.StructType(
            _fields(_TEXT, ["grid_id", "std_ym", "ind_type"])
            + _fields(_LONG, ["pay_cnt"])
            + [T.StructField("pay_amt", T.DecimalType(28, 2)), T.StructField("reg_dttm", T.TimestampType())]
        ),
        ["grid_id"],
    ),
    "cell_predictions": (
        T.StructType(
            [
                T.StructField("grid_id", _TEXT),
                T.StructField("std_date", T.TimestampType()),
                T.StructField("predicted_total", T.IntegerType()),
                T.StructField("acs_cnt", _LONG),
                T.StructField("reg_dttm", T.TimestampType()),
            ]
        ),
        ["grid_id", "std_date", "predicted_total", "acs_cnt"],
    ),
}
