"""Presence: visits, daily counts, runs, stay categories, places, paths."""

from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import query
from citypulse.functions.values import not_in_keep_nulls
from citypulse.operators import paths, presence
from citypulse.operators.lookup import attach, unique_lookup

IGNORED = ["view"]
NOTHING_IGNORED = ["no such event"]

VISITS = f"""
SELECT *, cast(logging_date AS date) AS access_date, strftime(logging_date, '%Y-%m') AS month FROM ({I.WIFI_LOG}) l
WHERE event_name NOT IN ('view') OR event_name IS NULL"""
# The whole log, where a device is a user and a kind of event, or for a tenth of the users the kind alone: runs
# of all lengths and all categories occur.
KIND_LOG = f"""
SELECT CASE WHEN client_mac_addr LIKE '%0' THEN coalesce(event_name, '-')
    ELSE concat(client_mac_addr, '/', coalesce(event_name, '-')) END AS client_mac_addr, logging_date, event_id, event_name, ap_id
FROM ({I.WIFI_LOG}) w"""
KINDS = f"""
SELECT *, cast(logging_date AS date) AS access_date, strftime(logging_date, '%Y-%m') AS month FROM ({KIND_LOG}) l"""
DAILY = f"""
SELECT client_mac_addr, month, access_date, count(*) AS daily_count FROM ({VISITS}) v GROUP BY ALL"""


def streaks_sql(visits_sql):
    return f"""
SELECT client_mac_addr, month, cast(max(n) AS integer) AS max_streak FROM (
  SELECT client_mac_addr, month, island, count(*) AS n FROM (
    SELECT client_mac_addr, month, access_date - cast(row_number() OVER (
        PARTITION BY client_mac_addr, month ORDER BY access_date) AS integer) AS island
    FROM (SELECT DISTINCT client_mac_addr, month, access_date FROM ({visits_sql}) v) d) i
  GROUP BY ALL) r GROUP BY ALL"""


def categories_sql(visits_sql):
    return f"""
WITH v AS ({visits_sql}),
daily AS (SELECT client_mac_addr, month, access_date, count(*) AS n FROM v GROUP BY ALL),
stats AS (SELECT client_mac_addr, month, count(*) AS total_days, cast(sum(n) AS bigint) AS total_events,
  avg(n) AS avg_daily, max(n) AS max_daily FROM daily GROUP BY ALL),
period AS (SELECT month, count(DISTINCT access_date) AS days_seen FROM daily GROUP BY month),
streak AS ({streaks_sql(visits_sql)})
SELECT client_mac_addr, month, total_days, total_events, round(avg_daily, 6) AS avg_daily, max_daily, max_streak,
  CASE WHEN max_streak = 1 THEN '{presence.ONE_TIME}' WHEN max_streak <= 3 THEN '{presence.TOURIST}'
    WHEN max_streak <= 7 THEN '{presence.LONG_STAY}' WHEN max_streak < days_seen THEN '{presence.RESIDENT}'
    ELSE '{presence.ALWAYS_ON}' END AS category
FROM stats JOIN period USING (month) JOIN streak USING (client_mac_addr, month)"""


def _visits(spark, sf_dir, ignored=IGNORED, log=I.WIFI_LOG):
    return presence.visits(I.derived(spark, sf_dir, log), ignored)


def _places(spark, sf_dir):
    aps = I.derived(spark, sf_dir, I.AP_DIM)
    return aps.select(F.col("ap_id").alias("id"), F.col("lon_u").alias("lon"), F.col("lat_u").alias("lat"))


def _placed_visits(spark, sf_dir, ignored=IGNORED, log=I.WIFI_LOG):
    place = _places(spark, sf_dir).withColumnRenamed("id", "ap_id")
    return attach(_visits(spark, sf_dir, ignored, log), place, ["ap_id"])


@query("presence_stay_category", categories_sql(KINDS))
def stay_category(spark, sf_dir):
    rows = presence.stay_categories(_visits(spark, sf_dir, NOTHING_IGNORED, KIND_LOG))
    return rows.withColumn("avg_daily", F.round("avg_daily", 6))


@query("presence_stay_category_all_kinds", categories_sql(VISITS))
def stay_category_all(spark, sf_dir):
    rows = presence.stay_categories(_visits(spark, sf_dir))
    return rows.withColumn("avg_daily", F.round("avg_daily", 6))


@query(
    "visit_filter_keeps_unknown_events",
    f"""
SELECT event_name, count(*) AS n FROM (SELECT CASE WHEN event_id = 3 THEN NULL ELSE event_name END AS event_name
  FROM ({I.WIFI_LOG}) l) k WHERE event_name IS NULL OR event_name NOT IN ('view') GROUP BY event_name""",
)
def visit_filter(spark, sf_dir):
    log = I.derived(spark, sf_dir, I.WIFI_LOG)
    log = log.withColumn("event_name", F.when(F.col("event_id") != 3, F.col("event_name")))
    kept = log.filter(not_in_keep_nulls(F.col("event_name"), IGNORED))
    return kept.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "log_described",
    f"""
SELECT client_mac_addr, epoch_us(logging_date) AS logged_us, e.name AS event_name, a.ap_name, a.lon_u AS lon, a.lat_u AS lat,
  count(*) AS cnt
FROM ({I.WIFI_LOG}) l LEFT JOIN ({I.EVENT_DIM}) e ON l.event_id = e.id LEFT JOIN ({I.AP_DIM}) a ON l.ap_id = a.ap_id
GROUP BY ALL""",
)
def log_described(spark, sf_dir):
    log = I.derived(spark, sf_dir, I.WIFI_LOG)
    events = I.derived(spark, sf_dir, I.EVENT_DIM)
    aps = I.derived(spark, sf_dir, I.AP_DIM).select(F.col("ap_id").alias("id"), F.col("ap_name").alias("name"))
    rows = presence.describe_log(log, events, aps, _places(spark, sf_dir))
    return rows.withColumn("logging_date", F.unix_micros("logging_date")).withColumnRenamed(
        "logging_date", "logged_us"
    )


@query(
    "device_daily_counts",
    f"SELECT client_mac_addr, month, strftime(access_date, '%Y-%m-%d') AS day, daily_count FROM ({DAILY}) d",
)
def device_daily_counts(spark, sf_dir):
    rows = presence.daily_counts(_visits(spark, sf_dir))
    return rows.select(
        "client_mac_addr", "month", F.date_format("access_date", "yyyy-MM-dd").alias("day"), "daily_count"
    )


def _stats_sql(keys):
    return f"""
SELECT {keys}, count(DISTINCT access_date) AS total_days, cast(sum(daily_count) AS bigint) AS total_events,
  round(avg(daily_count), 6) AS avg_daily, max(daily_count) AS max_daily FROM ({DAILY}) d GROUP BY {keys}"""


@query("device_stats_all_time", _stats_sql("client_mac_addr"))
def device_stats_all_time(spark, sf_dir):
    rows = presence.device_stats(presence.daily_counts(_visits(spark, sf_dir)))
    return rows.withColumn("avg_daily", F.round("avg_daily", 6))


@query("device_stats_monthly", _stats_sql("client_mac_addr, month"))
def device_stats_monthly(spark, sf_dir):
    rows = presence.device_stats(presence.daily_counts(_visits(spark, sf_dir)), by_month=True)
    return rows.withColumn("avg_daily", F.round("avg_daily", 6))


@query("device_longest_streak", streaks_sql(VISITS))
def device_longest_streak(spark, sf_dir):
    return presence.longest_runs(_visits(spark, sf_dir))


@query(
    "device_visit_runs",
    f"""
SELECT client_mac_addr, month, strftime(min(access_date), '%Y-%m-%d') AS first_day,
  strftime(max(access_date), '%Y-%m-%d') AS last_day, count(*) AS run_days
FROM (SELECT *, access_date - cast(row_number() OVER (PARTITION BY client_mac_addr, month ORDER BY access_date) AS integer) AS island
  FROM (SELECT DISTINCT client_mac_addr, month, access_date FROM ({KINDS}) v) d) i
GROUP BY client_mac_addr, month, island""",
)
def device_visit_runs(spark, sf_dir):
    rows = presence.visit_runs(_visits(spark, sf_dir, NOTHING_IGNORED, KIND_LOG))
    return rows.select(
        "client_mac_addr",
        "month",
        F.date_format("first_day", "yyyy-MM-dd").alias("first_day"),
        F.date_format("last_day", "yyyy-MM-dd").alias("last_day"),
        "run_days",
    )


@query("month_days_with_data", f"SELECT month, count(DISTINCT access_date) AS period_days FROM ({DAILY}) d GROUP BY month")
def month_days_with_data(spark, sf_dir):
    return presence.days_with_data(presence.daily_counts(_visits(spark, sf_dir)))


@query(
    "stay_category_pivot",
    f"SELECT month, "
    + ", ".join(
        f"nullif(count(*) FILTER (WHERE category = '{c}'), 0) AS \"{c}\"" for c in presence.STAY_CATEGORIES
    )
    + f" FROM ({categories_sql(KINDS)}) c GROUP BY month",
)
def stay_category_pivot(spark, sf_dir):
    return presence.category_pivot(presence.stay_categories(_visits(spark, sf_dir, NOTHING_IGNORED, KIND_LOG)))


@query(
    "stats_with_streak_joined",
    f"""
SELECT s.client_mac_addr, s.month, s.total_days, k.max_streak FROM ({_stats_sql('client_mac_addr, month')}) s
LEFT JOIN ({streaks_sql(VISITS)}) k ON s.client_mac_addr = k.client_mac_addr AND s.month = k.month""",
)
def stats_with_streak(spark, sf_dir):
    visit_rows = _visits(spark, sf_dir)
    stats = presence.device_stats(presence.daily_counts(visit_rows), by_month=True)
    joined = attach(stats, presence.longest_runs(visit_rows), ["client_mac_addr", "month"])
    return joined.select("client_mac_addr", "month", "total_days", "max_streak")


@query(
    "visits_by_category_and_place",
    f"""
SELECT c.category, a.lon_u AS lon, a.lat_u AS lat, v.month, count(*) AS size
FROM ({KINDS}) v JOIN ({I.AP_DIM}) a ON v.ap_id = a.ap_id
JOIN ({categories_sql(KINDS)}) c ON v.client_mac_addr = c.client_mac_addr AND v.month = c.month
WHERE a.lon_u IS NOT NULL AND c.category <> '{presence.ALWAYS_ON}' GROUP BY ALL""",
)
def visits_by_category_and_place(spark, sf_dir):
    rows = _placed_visits(spark, sf_dir, NOTHING_IGNORED, KIND_LOG)
    categories = presence.stay_categories(_visits(spark, sf_dir, NOTHING_IGNORED, KIND_LOG))
    return presence.visits_by_place(rows, categories)


PATH_ROWS = f"""
SELECT v.client_mac_addr, v.logging_date AS ts, a.lon_u AS lon, a.lat_u AS lat FROM ({VISITS}) v
JOIN ({I.AP_DIM}) a ON v.ap_id = a.ap_id WHERE a.lon_u IS NOT NULL"""


@query(
    "device_path_points",
    f"""
SELECT client_mac_addr, row_number() OVER (PARTITION BY client_mac_addr ORDER BY ts, lon, lat) AS seq,
  epoch_us(ts) AS at_us, lon, lat FROM ({PATH_ROWS}) p""",
)
def device_path_points(spark, sf_dir):
    rows = paths.path_points(_placed_visits(spark, sf_dir))
    return rows.select("client_mac_addr", "seq", F.unix_micros("logging_date").alias("at_us"), "lon", "lat")


@query(
    "device_path_kinds",
    f"""
SELECT client_mac_addr, count(*) AS n_points, CASE WHEN count(*) > 1 THEN 'line' ELSE 'point' END AS kind
FROM ({PATH_ROWS}) p GROUP BY client_mac_addr""",
)
def device_path_kinds(spark, sf_dir):
    return paths.path_kinds(_placed_visits(spark, sf_dir))


@query(
    "device_path_lines",
    f"""
SELECT client_mac_addr, part_no, CASE WHEN count(*) > 1 THEN 'line' ELSE 'point' END AS kind,
  string_agg(concat(cast(lon AS varchar), ' ', cast(lat AS varchar)), ', ' ORDER BY seq) AS coords
FROM (SELECT client_mac_addr, seq, lon, lat, (seq - 1) // 50 AS part_no FROM (
    SELECT *, row_number() OVER (PARTITION BY client_mac_addr ORDER BY ts, lon, lat) AS seq FROM ({PATH_ROWS}) p) q
  UNION ALL
  SELECT client_mac_addr, seq, lon, lat, (seq - 1) // 50 - 1 FROM (
    SELECT *, row_number() OVER (PARTITION BY client_mac_addr ORDER BY ts, lon, lat) AS seq FROM ({PATH_ROWS}) p) q
  WHERE (seq - 1) % 50 = 0 AND seq > 1) r
GROUP BY client_mac_addr, part_no HAVING count(*) > 1 OR part_no = 0""",
)
def device_path_lines(spark, sf_dir):
    lines = paths.path_lines(_placed_visits(spark, sf_dir), points_per_part=50)
    coords = F.transform("points", lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string")))
    return lines.select("client_mac_addr", "part_no", "kind", F.array_join(coords, ", ").alias("coords"))


@query(
    "place_mean_centre",
    f"SELECT round(avg(lat), 3) AS lat, round(avg(lon), 3) AS lon FROM ({PATH_ROWS}) p",
)
def place_mean_centre(spark, sf_dir):
    centre = paths.mean_centre(_placed_visits(spark, sf_dir))
    return centre.select(F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon"))


@query(
    "last_value_lookup",
    f"SELECT client_mac_addr, arg_max(ap_id, logging_date) AS ap_id FROM ({I.WIFI_LOG}) l GROUP BY client_mac_addr",
)
def last_value_lookup(spark, sf_dir):
    return unique_lookup(I.derived(spark, sf_dir, I.WIFI_LOG), "client_mac_addr", "ap_id", "logging_date")
