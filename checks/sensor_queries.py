"""Access-point counts, calendar features, active points, trims, and general frame operations."""

from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import query
from citypulse.functions import dates
from citypulse.functions.values import clip_at_zero
from citypulse.operators import sensors, shape
from citypulse.operators.lookup import drop_known, keep_known

CELL_COUNTS = f"""
SELECT c.grid_id, s.std_date, cast(sum(s.cnt) AS bigint) AS acs_cnt FROM ({I.AP_SUMMARY}) s
JOIN ({I.AP_CELL}) c ON s.ap_id = c.ap_id WHERE c.grid_id IS NOT NULL GROUP BY ALL"""
FLOW_SLOTS = f"""
SELECT id AS grid_id, strptime(concat(etl_ymd, lpad(timezn_cd, 2, '0')), '%Y%m%d%H') AS std_date, type, total, admi_cd
FROM ({I.FLOW_SLOTS_RAW}) f"""
CALENDAR = """month(std_date) AS month, dayname(std_date) AS dayname, hour(std_date) AS hour,
  cast(dayname(std_date) IN ('Friday', 'Saturday', 'Sunday') AS integer) AS is_weekend_group"""
SLOT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def slot_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def with_slot_text(df, column="std_date"):
    return df.withColumn(column, slot_text(column))


def cell_counts_of(spark, sf_dir):
    return sensors.cell_counts(I.derived(spark, sf_dir, I.AP_SUMMARY), I.derived(spark, sf_dir, I.AP_CELL))


def flow_of(spark, sf_dir):
    return sensors.flow_slots(I.derived(spark, sf_dir, I.FLOW_SLOTS_RAW))


def training_of(spark, sf_dir, pre_aggregate=False):
    return sensors.training_frame(cell_counts_of(spark, sf_dir), flow_of(spark, sf_dir), pre_aggregate)


@query("cell_slot_counts", f"SELECT * REPLACE ({SLOT.format('std_date')} AS std_date) FROM ({CELL_COUNTS}) c")
def cell_slot_counts(spark, sf_dir):
    return with_slot_text(cell_counts_of(spark, sf_dir))


@query(
    "cell_slot_counts_sorted",
    f"""
SELECT row_number() OVER (ORDER BY grid_id, std_date) AS position, grid_id, {SLOT.format('std_date')} AS std_date
FROM ({CELL_COUNTS}) c""",
)
def cell_slot_counts_sorted(spark, sf_dir):
    ordered = cell_counts_of(spark, sf_dir).orderBy("grid_id", "std_date")
    # The position is read back from the sorted partitions: sizes of those before, plus the place inside.
    marked = ordered.withColumn("_id", F.monotonically_increasing_id())
    return positions(marked).select("position", "grid_id", slot_text("std_date").alias("std_date"))


def positions(marked):
    """1-based position of each row of a sorted frame marked with ``_id``."""
    from pyspark.sql import Window

    from citypulse.session import cut_lineage

    fixed = cut_lineage(marked).withColumn("_part", F.shiftright("_id", 33))
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_id") - F.shiftleft(F.col("_part"), 33) + F.col("_start") + 1
    return fixed.join(starts, "_part").withColumn("position", place)


@query(
    "calendar_features",
    f"SELECT {SLOT.format('std_date')} AS std_date, {CALENDAR} FROM (SELECT DISTINCT std_date FROM ({I.AP_SUMMARY}) s) d",
)
def calendar_features(spark, sf_dir):
    slots = I.derived(spark, sf_dir, I.AP_SUMMARY).select("std_date").distinct()
    return with_slot_text(sensors.with_calendar(slots))


@query(
    "training_frame",
    f"""
SELECT c.grid_id, {SLOT.format('c.std_date')} AS std_date, c.acs_cnt, f.type, f.total, f.admi_cd,
  {CALENDAR.replace('std_date', 'c.std_date')}
FROM ({CELL_COUNTS}) c JOIN ({FLOW_SLOTS}) f ON c.grid_id = f.grid_id AND c.std_date = f.std_date
WHERE f.total IS NOT NULL AND f.admi_cd IS NOT NULL""",
)
def training_frame(spark, sf_dir):
    return with_slot_text(training_of(spark, sf_dir))


@query(
    "training_frame_types_summed",
    f"""
SELECT c.grid_id, {SLOT.format('c.std_date')} AS std_date, c.acs_cnt, f.total, f.admi_cd,
  {CALENDAR.replace('std_date', 'c.std_date')}
FROM ({CELL_COUNTS}) c JOIN (SELECT grid_id, std_date, admi_cd, coalesce(sum(total), 0) AS total FROM ({FLOW_SLOTS}) s GROUP BY ALL) f
ON c.grid_id = f.grid_id AND c.std_date = f.std_date""",
)
def training_frame_types_summed(spark, sf_dir):
    return with_slot_text(training_of(spark, sf_dir, pre_aggregate=True))


@query(
    "flow_of_known_cells",
    f"""
SELECT grid_id, type, count(*) AS n FROM ({FLOW_SLOTS}) f WHERE grid_id IN (SELECT grid_id FROM ({CELL_COUNTS}) c) GROUP BY ALL""",
)
def flow_of_known_cells(spark, sf_dir):
    kept = keep_known(flow_of(spark, sf_dir), "grid_id", cell_counts_of(spark, sf_dir), "grid_id")
    return kept.groupBy("grid_id", "type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flow_of_other_cells",
    f"""
SELECT grid_id, type, count(*) AS n FROM ({FLOW_SLOTS}) f WHERE grid_id NOT IN (SELECT grid_id FROM ({CELL_COUNTS}) c) GROUP BY ALL""",
)
def flow_of_other_cells(spark, sf_dir):
    kept = drop_known(flow_of(spark, sf_dir), "grid_id", cell_counts_of(spark, sf_dir), "grid_id")
    return kept.groupBy("grid_id", "type").agg(F.count(F.lit(1)).alias("n"))


def grained(minutes):
    """Counts per access point and slot of 5, 10 or 60 minutes."""
    return f"""
SELECT time_bucket(INTERVAL '{minutes} minutes', ts) AS std_date, user_id AS ap_id,
  cast(sum(cast(floor(value) AS bigint) % 4) AS bigint) AS cnt FROM events GROUP BY 1, 2"""


def grained_frame(spark, sf_dir, minutes):
    slot = F.window("ts", f"{minutes} minutes")["start"].alias("std_date")
    events = I.derived(spark, sf_dir, "SELECT ts, user_id AS ap_id, value FROM events")
    hits = F.floor("value").cast("bigint") % 4
    return events.groupBy(slot, "ap_id").agg(F.sum(hits).alias("cnt"))


for _minutes in (5, 10, 60):

    @query(
        f"active_points_{_minutes}min",
        f"SELECT {SLOT.format('std_date')} AS std_date, count(*) FILTER (WHERE cnt > 0) AS active_ap"
        f" FROM ({grained(_minutes)}) g GROUP BY std_date",
    )
    def active_points(spark, sf_dir, minutes=_minutes):
        return with_slot_text(sensors.active_points(grained_frame(spark, sf_dir, minutes)))


@query(
    "active_points_in_period",
    f"""
SELECT {SLOT.format('std_date')} AS std_date, count(*) FILTER (WHERE cnt > 0) AS active_ap FROM ({I.AP_SUMMARY}) s
WHERE std_date BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY std_date""",
)
def active_points_in_period(spark, sf_dir):
    rows = sensors.in_period(I.derived(spark, sf_dir, I.AP_SUMMARY), "std_date", "2024-01-05", "2024-01-20")
    return with_slot_text(sensors.active_points(rows))


@query(
    "dense_counts",
    f"""
SELECT a.ap_id, {SLOT.format('t.std_date')} AS std_date, coalesce(s.cnt, 0) AS cnt
FROM (SELECT DISTINCT ap_id FROM ({I.AP_SUMMARY}) s) a CROSS JOIN (SELECT DISTINCT std_date FROM ({I.AP_SUMMARY}) s) t
LEFT JOIN ({I.AP_SUMMARY}) s ON s.ap_id = a.ap_id AND s.std_date = t.std_date""",
)
def dense_counts(spark, sf_dir):
    return with_slot_text(sensors.dense_counts(I.derived(spark, sf_dir, I.AP_SUMMARY)))


@query(
    "upper_quantile_trim",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice <= (SELECT quantile_cont(l_extendedprice, 0.995) FROM lineitem)""",
)
def upper_quantile_trim(spark, sf_dir):
    rows = I.derived(spark, sf_dir, "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
    return sensors.trim_upper(rows, "l_extendedprice")


@query(
    "table_totals",
    f"SELECT count(*) AS row_count, count(DISTINCT grid_id) AS distinct_count, cast(sum(acs_cnt) AS bigint) AS total FROM ({CELL_COUNTS}) c",
)
def table_totals(spark, sf_dir):
    return shape.totals(cell_counts_of(spark, sf_dir), "grid_id", "acs_cnt")


@query(
    "recent_slots_by_text_day",
    f"""
SELECT ap_id, std_date, cnt FROM (SELECT ap_id, {SLOT.format('std_date')} AS std_date, cnt FROM ({I.AP_SUMMARY}) s) t
WHERE cast(left(std_date, 10) AS date) >= DATE '2024-01-20'""",
)
def recent_slots_by_text_day(spark, sf_dir):
    import datetime as dt

    rows = with_slot_text(I.derived(spark, sf_dir, I.AP_SUMMARY)).select("ap_id", "std_date", "cnt")
    return rows.filter(dates.text_day_from(F.col("std_date"), dt.date(2024, 1, 20)))


@query(
    "text_contains_and_range",
    """
SELECT p_partkey, p_name, p_size FROM part WHERE contains(p_name, 'ring') AND p_size BETWEEN 10 AND 40 AND p_brand = 'Brand#1'
UNION ALL SELECT p_partkey, p_name, p_size FROM part WHERE contains(p_type, 'ECO') AND p_size BETWEEN 1 AND 25""",
)
def text_contains_and_range(spark, sf_dir):
    part = I.derived(spark, sf_dir, "SELECT * FROM part")
    first = part.filter(F.col("p_name").contains("ring") & F.col("p_size").between(10, 40) & (F.col("p_brand") == "Brand#1"))
    second = part.filter(F.col("p_type").contains("ECO") & F.col("p_size").between(1, 25))
    return shape.stack_frames([first, second]).select("p_partkey", "p_name", "p_size")


@query(
    "missing_dropped_and_filled",
    f"""
SELECT ap_id, ap_name, coalesce(lon_u, -1) AS lon_u, coalesce(lat_u, -1) AS lat_u, 'filled' AS how FROM ({I.AP_DIM}) a
UNION ALL SELECT ap_id, ap_name, lon_u, lat_u, 'dropped' FROM ({I.AP_DIM}) a WHERE lon_u IS NOT NULL AND lat_u IS NOT NULL""",
)
def missing_dropped_and_filled(spark, sf_dir):
    aps = I.derived(spark, sf_dir, I.AP_DIM)
    filled = shape.fill_missing(aps, {"lon_u": -1, "lat_u": -1}).withColumn("how", F.lit("filled"))
    dropped = shape.drop_missing(aps, ["lon_u", "lat_u"]).withColumn("how", F.lit("dropped"))
    return shape.stack_frames([filled, dropped])


@query(
    "clipped_at_zero",
    "SELECT c_custkey, greatest(c_acctbal, 0.0) AS balance FROM customer",
)
def clipped_at_zero(spark, sf_dir):
    rows = I.derived(spark, sf_dir, "SELECT c_custkey, c_acctbal FROM customer")
    return rows.select("c_custkey", clip_at_zero(F.col("c_acctbal")).alias("balance"))


@query(
    "first_rows_preview",
    f"SELECT client_mac_addr, epoch_us(logging_date) AS at_us, ap_id FROM ({I.WIFI_LOG}) l ORDER BY logging_date, client_mac_addr, ap_id LIMIT 5",
)
def first_rows_preview(spark, sf_dir):
    rows = shape.preview(I.derived(spark, sf_dir, I.WIFI_LOG), ["logging_date", "client_mac_addr", "ap_id"])
    return rows.select("client_mac_addr", F.unix_micros("logging_date").alias("at_us"), "ap_id")


@query(
    "stacked_frames",
    f"""
SELECT 'in' AS side, full_id, n FROM (SELECT concat('k', cast(c_custkey AS varchar)) AS full_id, 1 AS n FROM customer) a
UNION ALL SELECT 'out', concat('k', cast(o_custkey AS varchar)), 2 FROM orders""",
)
def stacked_frames(spark, sf_dir):
    a = I.derived(spark, sf_dir, "SELECT concat('k', cast(c_custkey AS string)) AS full_id, 1 AS n FROM customer")
    b = I.derived(spark, sf_dir, "SELECT 2 AS n, concat('k', cast(o_custkey AS string)) AS full_id FROM orders")
    return shape.stack_frames([a.withColumn("side", F.lit("in")), b.withColumn("side", F.lit("out"))]).select(
        "side", "full_id", "n"
    )


@query("distinct_pairs", f"SELECT DISTINCT client_mac_addr, ap_id FROM ({I.WIFI_LOG}) l")
def distinct_pairs(spark, sf_dir):
    return I.derived(spark, sf_dir, I.WIFI_LOG).select("client_mac_addr", "ap_id").distinct()
