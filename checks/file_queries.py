"""Round trips: what sinks write, sources read back. Every query writes below the shared folder."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import inputs as I
from checks.registry import ORACLE, query
from citypulse.functions.points import wkb_point
from citypulse.session import prepare, shared_dir
from citypulse.sources import editions, files, sinks


def fresh(spark, name):
    """A folder that is not there yet."""
    prepare(spark)
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fields(**kinds):
    return T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in kinds.items()])


LINES = "SELECT l_orderkey AS k, l_linenumber AS n, l_returnflag AS flag, l_quantity AS qty FROM lineitem"
SHOPS = "SELECT c_custkey AS k, concat('가게 ', cast(c_custkey AS string)) AS shop, c_acctbal AS balance, c_custkey % 2 AS side FROM customer"


@query("delimited_read_by_header", LINES)
def delimited_read_by_header(spark, sf_dir):
    path = fresh(spark, "by-header")
    rows = I.derived(spark, sf_dir, LINES).withColumn("extra", F.lit("x"))
    sinks.write_csv(rows.select("qty", "extra", "flag", "n", "k").repartition(4, "k"), path, sep="|")
    return files.read_delimited(spark, path, fields(k="bigint", n="int", flag="string", qty="double"))


@query("delimited_korean_code_page", "SELECT c_custkey AS k, concat('가게 ', c_custkey) AS shop, c_acctbal AS balance FROM customer")
def delimited_korean_code_page(spark, sf_dir):
    path = fresh(spark, "korean")
    rows = I.derived(spark, sf_dir, SHOPS).select("shop", "balance", "k")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows.repartition(3, "k").write.option("header", True).option("encoding", files.KOREAN).csv(path)
    return files.read_delimited(spark, path, fields(k="bigint", shop="string", balance="double"), sep=",", encoding=files.KOREAN)


@query(
    "delimited_tree_of_two_code_pages",
    "SELECT c_custkey AS k, concat('가게 ', c_custkey) AS shop, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS balance FROM customer",
)
def delimited_tree_of_two_code_pages(spark, sf_dir):
    root = fresh(spark, "tree")
    rows = I.derived(spark, sf_dir, SHOPS)
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    even, odd = rows.filter("side = 0"), rows.filter("side = 1")
    sinks.write_csv(even.select("balance", "side", "k", "shop"), f"{root}/a/2024", sep="|")
    odd.select("shop", "k").write.option("header", True).option("sep", "|").option("encoding", files.KOREAN).csv(f"{root}/b")
    return files.read_delimited_tree(spark, root, "*.csv", fields(k="bigint", shop="string", balance="double"))


_SQUARE = "array(array(x0 + {0}, y0), array(x0 + {1}, y0), array(x0 + {1}, y1), array(x0 + {0}, y1), array(x0 + {0}, y0))"
SHAPES = f"""
SELECT id, CASE WHEN k = 0 THEN array(0) WHEN k = 1 THEN array(0, 0) ELSE array(0, 1) END AS ring_parts,
  CASE WHEN k = 0 THEN array({_SQUARE.format(0, 9)}) ELSE array({_SQUARE.format(0, 9)}, {_SQUARE.format(20, 30)}) END AS rings
FROM (SELECT cast(10000000 + p_partkey AS string) AS id, p_partkey % 3 AS k, cast(p_partkey % 50 AS double) AS x0,
  cast(p_partkey AS double) / 4 AS y0, cast(p_partkey AS double) / 4 + 1 AS y1 FROM part) p"""


@query(
    "polygons_written_and_read",
    """
SELECT cast(10000000 + p_partkey AS varchar) AS id, ring_no, CASE WHEN p_partkey % 3 = 2 THEN ring_no ELSE 0 END AS part,
  cast(p_partkey % 50 + ring_no * 20 AS double) AS x, p_partkey / 4 + 1 AS top, 5::bigint AS corners
FROM part CROSS JOIN (VALUES (0), (1)) AS r(ring_no) WHERE ring_no = 0 OR p_partkey % 3 <> 0""",
)
def polygons_written_and_read(spark, sf_dir):
    path = fresh(spark, "shapes")
    sinks.write_geojson(I.derived(spark, sf_dir, SHAPES), path, ["id"])
    return _corners(files.read_geojson(spark, path, ["id"], one_feature_per_line=True))


@query("polygons_of_one_line_read", ORACLE["polygons_written_and_read"])
def polygons_of_one_line_read(spark, sf_dir):
    """A whole collection on one line, read by ranges of bytes."""
    path = fresh(spark, "line")
    sinks.write_geojson(I.derived(spark, sf_dir, SHAPES), f"{path}/features", ["id"])
    features = F.array_join(F.array_sort(F.collect_list("value")), ",")
    line = F.concat(F.lit('{"type":"FeatureCollection","name":"a } [ \\" {","crs":{"type":"name","properties":{"name":"x"}},"features":['), features, F.lit("]}"))
    spark.read.text(f"{path}/features").agg(line.alias("value")).write.text(f"{path}/collection")
    return _corners(files.read_geojson(spark, f"{path}/collection", ["id"]))


def _corners(found):
    rings = found.select("id", F.posexplode(F.arrays_zip("rings", "ring_parts")).alias("ring_no", "r"))
    ring = F.col("r.rings")
    return rings.select(
        "id", "ring_no", F.col("r.ring_parts").alias("part"), ring[0][0].alias("x"), ring[2][1].alias("top"),
        F.size(ring).cast("bigint").alias("corners"),
    )


@query("lookup_written_and_read", "SELECT merchant AS key, grid_id AS value FROM (" + I.MERCHANT_CELL + ") m")
def lookup_written_and_read(spark, sf_dir):
    path = fresh(spark, "lookup")
    sinks.write_lookup(I.derived(spark, sf_dir, I.MERCHANT_CELL), "merchant", "grid_id", path)
    return files.read_parquet(spark, path)


@query(
    "lookup_read_from_json",
    "SELECT concat('n', c_nationkey) AS key, cast(count(*) AS varchar) AS value FROM customer GROUP BY c_nationkey",
)
def lookup_read_from_json(spark, sf_dir):
    path = fresh(spark, "json")
    sql = "SELECT concat('n', cast(c_nationkey AS string)) AS k, cast(count(*) AS string) AS v FROM customer GROUP BY c_nationkey"
    entries = F.map_from_entries(F.collect_list(F.struct("k", "v")))  # one entry per nation
    I.derived(spark, sf_dir, sql).agg(F.to_json(entries).alias("value")).write.text(path)
    return files.read_lookup_json(spark, path)


MONTHS = """
SELECT o_orderkey AS k, concat('2025', lpad(cast(1 + o_orderkey % 12 AS string), 2, '0')) AS crtr_ym, o_totalprice AS v FROM orders"""
MONTH_ROWS = "k bigint, v double, crtr_ym string"


@query("month_replaced_alone", f"SELECT k, crtr_ym, CASE WHEN crtr_ym = '202503' THEN -v ELSE v END AS v FROM ({MONTHS.replace('AS string', 'AS varchar')}) m")
def month_replaced_alone(spark, sf_dir):
    path = fresh(spark, "months")
    rows = I.derived(spark, sf_dir, MONTHS)
    sinks.write_months(rows, path, sort=["k"])
    again = rows.filter("crtr_ym = '202503'").withColumn("v", -F.col("v"))
    for _ in range(2):
        sinks.write_months(again, path)
    return spark.read.schema(MONTH_ROWS).parquet(path)


@query(
    "months_replaced_together",
    f"""
SELECT 'single' AS name, k, crtr_ym, v FROM ({MONTHS.replace('AS string', 'AS varchar')}) m
UNION ALL SELECT 'double', k, crtr_ym, 2 * v FROM ({MONTHS.replace('AS string', 'AS varchar')}) m""",
)
def months_replaced_together(spark, sf_dir):
    root = fresh(spark, "together")
    rows = I.derived(spark, sf_dir, MONTHS)
    frames = {"single": rows, "double": rows.withColumn("v", 2 * F.col("v"))}
    for _ in range(2):
        sinks.write_months_together(frames, root)
    single, double = (
        spark.read.schema(MONTH_ROWS).parquet(f"{root}/{name}").withColumn("name", F.lit(name)) for name in frames
    )
    return single.unionByName(double)


_TOGETHER = " UNION ALL ".join(
    f"SELECT '{seen}' AS seen, '{name}' AS name, k, crtr_ym, {sign}{times} * v AS v FROM ({MONTHS.replace('AS string', 'AS varchar')}) m"
    for seen, sign in (("before", ""), ("stopped", ""), ("after", "-"))
    for times, name in enumerate(("single", "double", "triple", "fourfold"), 1)
)


@query("months_published_together", f"SELECT seen, name, k, crtr_ym, CASE WHEN seen = 'after' AND crtr_ym <> '202503' THEN -v ELSE v END AS v FROM ({_TOGETHER}) t")
def months_published_together(spark, sf_dir):
    """Four tables as readers see them: published, after a run that stopped before its manifest, and after one that finished."""
    root = fresh(spark, "editions")
    rows = I.derived(spark, sf_dir, MONTHS)
    frames = {name: rows.withColumn("v", times * F.col("v")) for times, name in enumerate(("single", "double", "triple", "fourfold"), 1)}
    march = {name: df.filter("crtr_ym = '202503'").withColumn("v", -F.col("v")) for name, df in frames.items()}

    def seen(label):
        parts = [editions.read(spark, root, name, "k bigint, v double").select(F.lit(label).alias("seen"), F.lit(name).alias("name"), "k", "crtr_ym", "v") for name in frames]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])

    editions.write_months(frames, root)
    before = seen("before")
    written = editions.write_edition({name: march[name] for name in ("single", "double")}, root)
    stopped = seen("stopped")
    written |= editions.write_edition({name: march[name] for name in ("triple", "fourfold")}, root)
    editions.publish(spark, root, written)
    return before.unionByName(stopped).unionByName(seen("after"))


@query(
    "tables_replaced_appended_created",
    """
SELECT name, k, CASE WHEN name = 'appended' THEN 2 ELSE 1 END::bigint AS copies
FROM (SELECT o_orderkey AS k FROM orders) o CROSS JOIN (VALUES ('replaced'), ('appended'), ('created')) AS t(name)""",
)
def tables_replaced_appended_created(spark, sf_dir):
    root = fresh(spark, "tables")
    rows = I.derived(spark, sf_dir, "SELECT o_orderkey AS k FROM orders")
    for _ in range(2):
        sinks.replace(rows, f"{root}/replaced")
        sinks.append(rows, f"{root}/appended")
    sinks.create_new(rows, f"{root}/created")
    tables = [spark.read.parquet(f"{root}/{name}").withColumn("name", F.lit(name)) for name in ("replaced", "appended", "created")]
    together = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return together.groupBy("name", "k").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "rows_conformed_and_stamped",
    "SELECT cast(o_orderkey AS varchar) AS k, NULL::double AS later, cast(o_custkey AS integer) AS cust, true AS stamped FROM orders",
)
def rows_conformed_and_stamped(spark, sf_dir):
    path = fresh(spark, "conformed")
    rows = I.derived(spark, sf_dir, "SELECT o_custkey AS cust, o_orderstatus AS left_out, o_orderkey AS k FROM orders")
    target = fields(k="string", later="double", cust="int", reg_dttm="timestamp")
    sinks.append(sinks.conform(sinks.stamp(sinks.require(rows, ["k", "cust"])), target), path)
    stored = spark.read.parquet(path)
    return stored.select("k", "later", "cust", F.col("reg_dttm").isNotNull().alias("stamped"))


def _one_file(df, target):
    """A delimited file with a name of its own."""
    spark = df.sparkSession
    sinks.write_csv(df.coalesce(1), f"{target}-parts")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = place(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    (part,) = [f.getPath() for f in system.listStatus(place(f"{target}-parts")) if f.getPath().getName().startswith("part-")]
    system.rename(part, place(target))
    system.delete(place(f"{target}-parts"), True)


@query("newest_file_read", "SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 2")
def newest_file_read(spark, sf_dir):
    """Of the files of several months the one whose name sorts last; other names do not count."""
    root = fresh(spark, "newest")
    rows = I.derived(spark, sf_dir, "SELECT o_orderkey AS k FROM orders")
    for part, name in enumerate(("sales_202411", "sales_202412", "sales_202501", "other_202609")):
        _one_file(rows.filter(F.col("k") % 3 == part % 3), f"{root}/{name}.csv")
    return files.read_delimited(spark, files.newest_file(spark, root, "sales_*.csv"), fields(k="bigint"), sep=",")


@query("table_created_once", "SELECT o_orderkey AS k, CAST(strftime(o_orderdate, '%Y%m') AS varchar) AS ym, 1::bigint AS copies FROM orders")
def table_created_once(spark, sf_dir):
    """A table that is created if it is missing: the second call leaves its rows alone."""
    path = fresh(spark, "created")
    name = f"orders_{uuid.uuid4().hex}"
    rows = I.derived(spark, sf_dir, "SELECT o_orderkey AS k, date_format(o_orderdate, 'yyyyMM') AS ym FROM orders")
    for _ in range(2):
        sinks.create_table(spark, name, fields(k="bigint", ym="string"), path, ["ym"])
        if spark.table(name).isEmpty():
            rows.write.insertInto(name, overwrite=False)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    stored = spark.read.schema("k bigint, ym string").parquet(path)
    return stored.groupBy("k", "ym").agg(F.count(F.lit(1)).alias("copies"))


#: Rows for which there is one archive of each flag.
ARCHIVE_ROWS = 2_000_000


@query("zipped_members_read", "SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS qty, l_returnflag AS archive FROM lineitem")
def zipped_members_read(spark, sf_dir):
    """Archives of each return flag with a member for each line number, in either code page, beside what is not wanted.

    One archive a flag for up to ``ARCHIVE_ROWS`` rows in all, as many times more as there are rows, so that no task packs more than a part of them.
    """
    root = fresh(spark, "zips")
    rows = I.derived(spark, sf_dir, "SELECT l_returnflag AS flag, l_linenumber AS n, l_orderkey AS k, l_quantity AS qty FROM lineitem")
    parts = -(-rows.count() // ARCHIVE_ROWS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("k", "n", "qty"), F.lit(max(parts, 1))))

    def pack(key, table):
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import compute, csv, fs

        system, folder = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        system.create_dir(folder)
        with system.open_output_stream(f"{folder}/{key[1].as_py()}-{key[0].as_py()}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "no rows")
            archive.writestr("other.csv", "k|n|qty\n0|0|0\n")
            for n in sorted(set(table.column("n").to_pylist())):
                part = table.filter(compute.equal(table.column("n"), n)).select(["qty", "k", "n"])
                text = io.BytesIO()
                csv.write_csv(part, text, csv.WriteOptions(delimiter="|"))
                archive.writestr(f"in/Flow_{n}.csv", text.getvalue().decode().encode("cp949" if n % 2 else "utf-8"))
        return pa.table({"flag": pa.array([key[0].as_py()])})

    rows.groupBy("flag", "part").applyInArrow(pack, "flag string").count()
    found = files.read_zipped(spark, root, "flow_", fields(k="bigint", n="int", qty="double"))
    return found.select("k", "n", "qty", F.regexp_extract("archive", r"([A-Z])\.zip$", 1).alias("archive"))


# Points whose coordinates are whole 2^-20 degrees, so that the bits of their doubles follow from integers:
# longitudes of 127 and more in [64, 128), latitudes of 34 and more in [32, 64).
_LON = "127 + c_custkey * 7919 % 1048576 / 1048576.0"
_LAT = "34 + c_custkey * 104729 % 1048576 / 1048576.0"
WKB = """
SELECT k, CASE WHEN k % 10 = 0 THEN NULL WHEN k % 2 = 0 THEN concat('00', '00000001', lon, lat)
  ELSE concat('01', '01000000', array_join(transform(sequence(15, 1, -2), i -> substring(lon, i, 2)), ''),
    array_join(transform(sequence(15, 1, -2), i -> substring(lat, i, 2)), '')) END AS location
FROM (SELECT c_custkey AS k, hex(1029 * 4503599627370496 + (63 * 1048576 + c_custkey * 7919 % 1048576) * 67108864) AS lon,
  hex(1028 * 4503599627370496 + (2 * 1048576 + c_custkey * 104729 % 1048576) * 134217728) AS lat FROM customer) c"""


@query(
    "points_decoded_from_wkb",
    f"""
SELECT c_custkey AS k, CASE WHEN c_custkey % 10 <> 0 THEN cast({_LON} AS double) END AS lon,
  CASE WHEN c_custkey % 10 <> 0 THEN cast({_LAT} AS double) END AS lat FROM customer""",
)
def points_decoded_from_wkb(spark, sf_dir):
    rows = I.derived(spark, sf_dir, WKB).withColumn("p", F.when(F.col("k") % 2 == 0, F.lower("location")).otherwise(F.col("location")))
    point = wkb_point(F.col("p"))
    return rows.select("k", point["lon"].alias("lon"), point["lat"].alias("lat"))
