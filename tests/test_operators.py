"""Operators on small frames, and properties that must hold at any partitioning."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citypulse.operators import economy, flow, lookup, paths, presence, residents, sensors, shape
from citypulse.schemas import FIVE_YEAR_COLUMNS, TEN_YEAR_COLUMNS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- presence ----


def log_of(spark, days_per_device):
    """One visit at noon for each device and day."""
    data = [
        (device, dt.datetime.combine(day, dt.time(12)), "join", 1)
        for device, days in days_per_device.items()
        for day in days
    ]
    return spark.createDataFrame(data, "client_mac_addr string, logging_date timestamp, event_name string, ap_id int")


def span(start, n):
    first = dt.date.fromisoformat(start)
    return [first + dt.timedelta(days=i) for i in range(n)]


STREAKS = {
    "one": (span("2025-07-02", 1), 1, presence.ONE_TIME),
    "three": (span("2025-07-02", 3), 3, presence.TOURIST),
    "four": (span("2025-07-02", 4), 4, presence.LONG_STAY),
    "seven": (span("2025-07-02", 7), 7, presence.LONG_STAY),
    "eight": (span("2025-07-02", 8), 8, presence.RESIDENT),
    "month": (span("2025-07-01", 31), 31, presence.ALWAYS_ON),
    "gaps": (span("2025-07-01", 2) + span("2025-07-10", 5) + span("2025-07-31", 1), 5, presence.LONG_STAY),
}


def test_streaks_and_categories(spark):
    visits = presence.visits(log_of(spark, {k: v[0] for k, v in STREAKS.items()}))
    found = {r.client_mac_addr: (r.max_streak, r.category) for r in presence.stay_categories(visits).collect()}
    assert found == {k: (v[1], v[2]) for k, v in STREAKS.items()}
    runs = presence.visit_runs(visits).groupBy("client_mac_addr").agg(F.max("run_days").alias("n"))
    assert {r.client_mac_addr: r.n for r in runs.collect()} == {k: v[1] for k, v in STREAKS.items()}


def test_run_ends_with_its_month(spark):
    visits = presence.visits(log_of(spark, {"d": span("2025-06-28", 6)}))
    assert rows(presence.longest_runs(visits)) == [("d", "2025-06", 3), ("d", "2025-07", 3)]


def test_unknown_events_stay_and_ignored_ones_go(spark):
    log = log_of(spark, {"d": span("2025-07-01", 3)})
    log = log.withColumn(
        "event_name",
        F.when(F.dayofmonth("logging_date") == 1, presence.IGNORED_EVENTS[0]).when(F.dayofmonth("logging_date") == 2, "x"),
    )
    assert presence.daily_counts(presence.visits(log)).count() == 2


def test_device_stats(spark):
    log = log_of(spark, {"d": span("2025-06-30", 2) + span("2025-06-30", 1)})
    daily = presence.daily_counts(presence.visits(log))
    assert rows(presence.device_stats(daily)) == [("d", 2, 3, 1.5, 2)]
    assert rows(presence.device_stats(daily, by_month=True)) == [("d", "2025-06", 1, 2, 2.0, 2), ("d", "2025-07", 1, 1, 1.0, 1)]


def test_category_pivot_leaves_gaps_null(spark):
    visits = presence.visits(log_of(spark, {"a": span("2025-07-01", 1), "b": span("2025-07-02", 1)}))
    found = presence.category_pivot(presence.stay_categories(visits)).first().asDict()
    assert found.pop("month") == "2025-07" and found.pop(presence.ONE_TIME) == 2
    assert set(found) == set(presence.STAY_CATEGORIES[1:]) and not any(found.values())


def test_places_leave_out_always_on_devices(spark):
    visits = presence.visits(log_of(spark, {"all": span("2025-07-01", 9), "some": span("2025-07-03", 1)}))
    placed = visits.withColumns({"lon": F.lit(127.6), "lat": F.lit(34.7)})
    found = presence.visits_by_place(placed, presence.stay_categories(visits))
    assert rows(found) == [(presence.ONE_TIME, 127.6, 34.7, "2025-07", 1)]


def test_described_log_keeps_unmatched(spark):
    log = spark.createDataFrame(
        [("d", dt.datetime(2025, 7, 1), 1, 1), ("d", dt.datetime(2025, 7, 1), 1, 1), ("d", dt.datetime(2025, 7, 1), 9, 9)],
        "client_mac_addr string, logging_date timestamp, event_id int, ap_id int",
    )
    events = spark.createDataFrame([(1, "join")], "id int, name string")
    aps = spark.createDataFrame([(1, "ap")], "id int, name string")
    places = spark.createDataFrame([(1, 127.0, 34.0)], "id int, lon double, lat double")
    found = presence.describe_log(log, events, aps, places).drop("logging_date")
    assert rows(found) == [("d", "join", "ap", 127.0, 34.0, 2), ("d", None, None, None, None, 1)]


def located_log(spark, n, seed=7):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        # Device "hot" has about a third of all rows.
        device = "hot" if rng.random() < 0.33 else f"d{rng.randrange(20)}"
        at = dt.datetime(2025, 7, 1) + dt.timedelta(seconds=rng.randrange(3 * 86400))
        data.append((device, at, float(rng.randrange(5)), float(rng.randrange(5)) if rng.random() > 0.1 else None))
    return data, spark.createDataFrame(data, "client_mac_addr string, logging_date timestamp, lon double, lat double")


@pytest.mark.parametrize("chunk", ["minute", "hour", "day"])
def test_path_points_number_the_whole_history(spark, chunk):
    data, df = located_log(spark, 3000)
    expected = {}
    for device, at, lon, lat in sorted(r for r in data if r[3] is not None):
        expected.setdefault(device, []).append((at, lon, lat))
    found = {}
    for r in paths.path_points(df, chunk).orderBy("client_mac_addr", "seq").collect():
        found.setdefault(r.client_mac_addr, []).append((r.seq, (r.logging_date, r.lon, r.lat)))
    assert {d: [p for _, p in v] for d, v in found.items()} == expected
    assert all([s for s, _ in v] == list(range(1, len(v) + 1)) for v in found.values())


def test_path_parts_overlap_by_one_point_and_lose_nothing(spark):
    _, df = located_log(spark, 800)
    whole = {r.client_mac_addr: [p.seq for p in r.points] for r in paths.path_lines(df).collect()}
    parts = {}
    for r in paths.path_lines(df, points_per_part=7).orderBy("client_mac_addr", "part_no").collect():
        seqs = [p.seq for p in r.points]
        assert len(seqs) <= 8
        known = parts.setdefault(r.client_mac_addr, [])
        assert not known or known[-1] == seqs[0]
        known.extend(seqs[1:] if known else seqs)
    assert parts == whole


@pytest.mark.parametrize("n", [1, 2, 10, 11, 12, 21])
def test_kind_of_a_path_does_not_depend_on_the_size_of_parts(spark, n):
    data = [("d", dt.datetime(2025, 7, 1) + dt.timedelta(seconds=k), float(k), 1.0) for k in range(n)]
    df = spark.createDataFrame(data, "client_mac_addr string, logging_date timestamp, lon double, lat double")
    parts = paths.path_lines(df, points_per_part=10).orderBy("part_no").collect()
    assert {r.kind for r in parts} == {"point" if n == 1 else "line"}
    assert [r.part_no for r in parts] == list(range(max(1, -(-(n - 1) // 10))))


def test_lookup_with_two_values_of_a_key_is_an_error(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    same = spark.createDataFrame([("a", 1), ("a", 1), ("c", 2)], "key string, v int")
    assert rows(lookup.map_column(df, "k", same, "key", "v", "out").na.fill(-1)) == [("a", 1), ("b", -1)]
    two = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "key string, v int, at int")
    with pytest.raises(Exception, match="several values"):
        lookup.map_column(df, "k", two, "key", "v", "out").collect()
    last = lookup.unique_lookup(two, "key", "v", "at")
    assert rows(lookup.map_column(df, "k", last, "key", "v", "out").na.fill(-1)) == [("a", 2), ("b", -1)]


def test_single_place_is_a_point(spark):
    df = spark.createDataFrame([("d", dt.datetime(2025, 7, 1), 1.0, 2.0)], "client_mac_addr string, logging_date timestamp, lon double, lat double")
    assert rows(paths.path_kinds(df)) == [("d", 1, "point")]
    assert paths.path_lines(df).first().kind == "point"


# ---- flow ----


def flow_mart(spark, n=400, seed=3):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        day = dt.date(2024, 11, 28) + dt.timedelta(days=rng.randrange(40))
        bands = [float(rng.randrange(9)) for _ in TEN_YEAR_COLUMNS]
        data.append(
            (f"1000000{rng.randrange(9)}", rng.choice(["a", "b", None]), str(rng.randrange(24)), *bands, sum(bands), "46" + str(rng.randrange(3)), day)
        )
    columns = ", ".join(f"{c} double" for c in TEN_YEAR_COLUMNS)
    schema = f"id string, type string, timezn_cd string, {columns}, total double, admi_cd string, etl_ymd date"
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_month_reports_agree_in_total(spark, partitions):
    mart = flow_mart(spark).repartition(partitions)
    expected = mart.filter("etl_ymd between '2024-12-01' and '2024-12-31'").agg(F.sum("total")).first()[0]
    sums = flow.month_sums(flow.with_month(mart), "202412")
    for source in (mart, flow.with_month(mart), sums):
        for report in flow.MONTH_REPORTS.values():
            assert float(report(source, "202412").agg(F.sum("total_population")).first()[0]) == expected


def test_missing_type_is_a_group(spark):
    assert None in {r.type for r in flow.flow_by_sex_age(flow_mart(spark), "202412").collect()}


def test_text_and_numeric_flow_files_give_the_same_mart(spark):
    names = ["id", "type", "timezn_cd", *FIVE_YEAR_COLUMNS, "total", "admi_cd", "etl_ymd"]
    one = ["10000001", "t", "7"] + [str(i) for i in range(len(FIVE_YEAR_COLUMNS))] + ["12.5", "46130510", "20250101"]
    two = ["10000002", "t", "8"] + ["", "x"] + ["1"] * (len(FIVE_YEAR_COLUMNS) - 2) + ["", "46130510", "2025-01-02"]
    text = spark.createDataFrame([one, two], ", ".join(f"{n} string" for n in names))
    numeric = text.withColumns({n: F.col(n).try_cast("double") for n in [*FIVE_YEAR_COLUMNS, "total"]})
    assert rows(flow.normalize_flow(text)) == rows(flow.normalize_flow(numeric))
    first = flow.normalize_flow(text).filter("id = '10000001'").first()
    assert (first.m10, first.m20, first.m70, first.f10, first.total, first.admi_cd) == (3.0, 7.0, 13.0, 45.0, 12.5, "4613051000")
    second = flow.normalize_flow(text).filter("id = '10000002'").first()
    assert (second.m10, second.total) == (1.0, None)


def test_extract_drops_missing_keys_and_sums_to_zero(spark):
    data = [("c", "20250101", "1", "46", None), ("c", "20250101", "2", None, 3.0), ("c", "20250101", "3", "46", 2.0)]
    df = spark.createDataFrame(data, "id string, etl_ymd string, timezn_cd string, admi_cd string, total double")
    assert rows(flow.flow_extract(df)) == [("c", "20250101", "1", "46", 0.0), ("c", "20250101", "3", "46", 2.0)]


# ---- economy ----


def payments(spark):
    data = [
        (1, "2025-01-05", "a", "food", None, "20000229"),
        (None, "2025-01-06", "a", "food", None, "bad"),
        (3, "2025-02-01", "b", "food", "7.50", None),
        (4, "2025-01-07", "nowhere", "food", "1.00", "19900101"),
        (5, "2025-01-07", "a", None, "1.00", "19900101"),
        (6, "not a day", "b", "food", "1.00", "19900101"),
    ]
    df = spark.createDataFrame(data, "pay_no int, pay_date string, merchant string, ind_type string, amount string, birth string")
    return df.withColumns({"amount": F.col("amount").cast("decimal(18,2)"), "home_address": F.lit("x")})


def merchant_cells(spark):
    return spark.createDataFrame([("a", "10000001"), ("b", "10000001")], "merchant string, grid_id string")


def test_payments_by_cell(spark):
    good = payments(spark).withColumn("pay_date", F.try_to_date("pay_date", "yyyy-MM-dd"))
    found = economy.payments_by_cell(good, merchant_cells(spark))
    assert [(r.grid_id, r.std_ym, r.ind_type, r.pay_cnt, float(r.pay_amt)) for r in found.orderBy("std_ym").collect()] == [
        ("10000001", "202501", "food", 1, 0.0),
        ("10000001", "202502", "food", 1, 7.5),
    ]


def test_payments_with_age(spark):
    found = economy.payments_with_age(payments(spark), merchant_cells(spark))
    assert not {"pay_no", "home_address"} & set(found.columns)
    assert found.count() == 6
    ages = sorted(((r.merchant, r.std_ym, r.age, r.grid_id) for r in found.collect()), key=repr)
    assert ages == sorted(
        [
            ("a", "202501", 24, "10000001"),
            ("a", "202501", None, "10000001"),
            ("a", "202501", 35, "10000001"),
            ("b", "202502", None, "10000001"),
            ("b", None, None, "10000001"),
            ("nowhere", "202501", 35, None),
        ],
        key=repr,
    )


def test_business_stats_repeat_for_duplicate_industry_codes(spark):
    base = {c: 1 for c in economy.BUSINESS_COLUMNS}
    stats = spark.createDataFrame([(10000001, 202501, "S1"), (10000001, 202501, "S9")], "QID50 long, BS_YR_MON int, SIC_CD_LV4 string")
    stats = stats.withColumns({c: F.lit(v) for c, v in base.items() if c not in stats.columns and "CLSFY" not in c})
    codes = spark.createDataFrame([("S1", "m", "n"), ("S1", "m2", "n2")], "SIC_CD string, SIC_FST_CLSFY_ITM_NM string, SIC_SCND_CLSFY_ITM_NM string")
    found = economy.business_stats(stats, codes)
    assert found.count() == 2 and found.columns[:2] == ["grid_id", "std_ym"] and found.columns[-1] == "tot_sales_amt5m_cnt"
    assert found.first().grid_id == "10000001"


# ---- residents ----


def test_household_sizes(spark):
    heads = spark.createDataFrame(
        [("h1", "10", "S2"), ("h1", "99", "S2"), ("h2", "99", "S2"), ("h3", "13", "S2"), ("h4", "10", "S1"), (None, "10", "S2")],
        "jumin_head_sid string, jumin_state_code string, data_crtr_dt string",
    )
    members = spark.createDataFrame(
        [("a", "h1"), ("a", "h1"), ("b", "h1"), ("c", "h2"), ("d", "h4"), (None, "h1"), ("e", None)],
        "jumin_sid string, jumin_head_sid string",
    )
    found = residents.household_sizes(heads, members).select("jumin_head_sid", "jumin_state_code", "member_count")
    # Both current rows of h1 count; h2 is not resident; h3 has nobody; h4 is not in the newest snapshot.
    assert rows(found) == [("h1", "10", 2), ("h1", "99", 2), ("h3", "13", 0)]
    older = residents.household_sizes(heads, members, as_of="S1").select("jumin_head_sid", "member_count")
    assert rows(older) == [("h4", 1)]


ADDRESS = "jumin_rd_code string, jumin_regn_code string, jumin_bdng_orgno string, jumin_bdng_subno string, jumin_san string"


def test_households_by_cell(spark):
    data = [("h%d" % i, n, "46", "9", "1", None, "1") for i, n in enumerate([0, 1, 2, 3, 4, 9])]
    data += [("x", 1, "46", "9", "2", None, "1"), ("y", 1, "46", "9", None, None, "1")]
    households = spark.createDataFrame(data, f"jumin_head_sid string, member_count long, {ADDRESS}")
    cells = spark.createDataFrame([("46-1", "10000001"), ("46-2", "1000002")], "addr_id string, grid_id string")
    assert rows(residents.households_by_cell(households, cells)) == [("10000001", 6, 1, 1, 1, 2)]


def test_residents_counted_before_or_after_the_join(spark):
    heads = spark.createDataFrame(
        [("h1", "S", "46", "9", "1", None, "1"), ("h1", "S", "46", "9", "3", None, "1")],
        f"jumin_head_sid string, data_crtr_dt string, {ADDRESS}",
    )
    members = spark.createDataFrame(
        [("0001011", "h1", "10", "S"), ("0101012", "h1", "10", "S"), ("0001013", "h1", "10", "S"), ("0001011", "zz", "10", "S"), ("0001011", "h1", "77", "S")],
        "jumin_sid string, jumin_head_sid string, jumin_state_code string, data_crtr_dt string",
    )
    cells = spark.createDataFrame([("46-1", "10000001"), ("46-3", "10000003")], "addr_id string, grid_id string")
    found = residents.residents_by_cell(members, heads, cells, dt.date(2025, 1, 1))
    assert rows(found) == [
        ("10000001", "F", "20", 1), ("10000001", "M", "20", 2), ("10000003", "F", "20", 1), ("10000003", "M", "20", 2),
    ]
    assert residents.resident_rows(members, heads).count() == 7


# ---- lookups and shaping ----


def test_last_value_wins_even_if_null(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", None, 2), ("m", "b", 1), (None, "c", 1)], "k string, v string, n int")
    assert rows(lookup.unique_lookup(df, "k", "v", "n")) == [("k", None), ("m", "b")]


def test_two_step_lookup(spark):
    a = spark.createDataFrame([("k", "x"), ("m", "y"), ("n", None)], "k string, via string")
    b = spark.createDataFrame([("x", "10000001")], "via string, cell string")
    assert rows(lookup.compose_lookups(a, "k", "via", b, "via", "cell")) == [("k", "10000001")]


def test_stack_matches_by_name(spark):
    a = spark.createDataFrame([(1, "a")], "n int, s string")
    b = spark.createDataFrame([("b", 2)], "s string, n int")
    c = spark.createDataFrame([(3,)], "n int")
    assert rows(shape.stack_frames([a, b, c])) == [(1, "a"), (2, "b"), (3, None)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3)], "v double, n int")
    assert rows(shape.drop_missing(df)) == [(1.0, 1)]
    assert rows(shape.fill_missing(df, {"v": -1.0})) == [(-1.0, 2), (-1.0, 3), (1.0, 1)]


def test_drop_ignores_absent_columns_and_lowering_renames(spark):
    df = shape.drop_columns(spark.createDataFrame([(1, 2)], "A int, B int"), ["B", "ZZ"])
    assert shape.lower_columns(df, {"a": "c"}).columns == ["c"]


def test_all_missing_sum_is_zero(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert df.agg(shape.sum_or_zero("v").alias("s")).first().s == 0


# ---- sensors ----


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("q", [0.0, 0.51, 0.995, 1.0])
def test_exact_quantile(spark, seed, q):
    rng = np.random.default_rng(seed)
    data = [
        rng.normal(size=3000),
        np.concatenate([np.zeros(2000), np.ones(2001)]),
        np.exp(rng.normal(size=3000) * 20),
        np.concatenate([np.full(2990, 5.0), rng.normal(size=10) * 100]),
    ][seed]
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,), (float("nan"),)], "v double").repartition(6)
    expected = float(np.quantile(data, q))
    assert sensors.exact_quantile(df, "v", q) == pytest.approx(expected, rel=1e-12)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert sensors.exact_quantile(df, "v", 0.5) is None
    assert sensors.trim_upper(df, "v").count() == 0


def test_active_points_equal_the_dense_frame(spark):
    data = [("a", 1, 5), ("a", 26, 0), ("b", 1, None), ("b", 49, 2), ("c", 49, 1)]
    df = spark.createDataFrame(
        [(ap, dt.datetime(2025, 1, 1) + dt.timedelta(hours=h), n) for ap, h, n in data], "ap_id string, std_date timestamp, cnt int"
    )
    dense = sensors.dense_counts(df)
    assert dense.count() == 9 and dense.filter("cnt is null").count() == 0
    assert rows(sensors.active_points(dense)) == rows(sensors.active_points(df))


def test_cell_counts_drop_unmapped_points(spark):
    at = dt.datetime(2025, 1, 1)
    summary = spark.createDataFrame([(at, 1, 2), (at, 2, None), (at, 3, 4), (at, 9, 1), (None, 1, 1)], "std_date timestamp, ap_id int, cnt int")
    cells = spark.createDataFrame([(1, "c1"), (2, "c2"), (3, "c1"), (9, None)], "ap_id int, grid_id string")
    assert rows(sensors.cell_counts(summary, cells).select("grid_id", "acs_cnt")) == [("c1", 6), ("c2", 0)]
