"""Sources and sinks on small files."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as spark_entry
from checks import file_queries
from citypulse.operators import flow, spatial
from citypulse.schemas import FLOW_FILE, FLOW_MART, RESULT_TABLES
from citypulse.sources import editions, files, json_ranges, sinks

NAMES = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("nm", T.StringType()), T.StructField("v", T.DoubleType())]
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_delimited_keeps_rows_with_a_bad_field(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id|nm|v\n1|a|2.5\n2|b|x\n3||\n", encoding="utf-8")
    assert rows(files.read_delimited(spark, str(path), NAMES).na.fill({"v": -1.0, "nm": "none"})) == [
        ("1", "a", 2.5),
        ("2", "b", -1.0),
        ("3", "none", -1.0),
    ]


def test_comma_file_with_korean_text(spark, tmp_path):
    path = tmp_path / "pay.csv"
    path.write_text("id,nm,v\n1,가게,2\n", encoding="utf-8")
    assert rows(files.read_delimited(spark, str(path), NAMES, sep=",")) == [("1", "가게", 2.0)]


def test_delimited_columns_go_by_the_header(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("v|extra|nm|id\n2.5|q|a|1\n", encoding="utf-8")
    assert rows(files.read_delimited(spark, str(path), NAMES)) == [("1", "a", 2.5)]
    path.write_text("id|nm\n1|a\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no column v"):
        files.read_delimited(spark, str(path), NAMES)
    both = tmp_path / "both"
    both.mkdir()
    (both / "1.csv").write_text("id|nm|v\n1|a|1\n")
    (both / "2.csv").write_text("nm|id|v\na|1|1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_delimited(spark, str(both), NAMES).collect()


def test_geojson_parts_survive_a_round_trip(spark, tmp_path):
    source = tmp_path / "s.geojson"
    source.write_text("\n".join(json.dumps(f) for f in features()))
    read = files.read_geojson(spark, str(source), ["id"], one_feature_per_line=True)
    sinks.write_geojson(read, str(tmp_path / "out"), ["id"])
    written = [json.loads(line) for p in (tmp_path / "out").glob("part-*") for line in p.read_text().splitlines()]
    want = {f["properties"]["id"]: f["geometry"] for f in features() if f["geometry"]["type"] != "Point"}
    assert {f["properties"]["id"]: f["geometry"] for f in written} == want


def test_tree_of_files_mixed_code_pages_and_column_orders(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "f_age_1.csv").write_bytes("id|nm|v\n1|서울|1\n".encode("utf-8"))
    (tmp_path / "x" / "y" / "f_age_2.csv").write_bytes("id|nm|v\n2|순천|2\n".encode("cp949"))
    (tmp_path / "x" / "f_age_3.csv").write_bytes("v|extra|id\n3|q|3\n".encode("utf-8"))
    (tmp_path / "x" / "other.csv").write_bytes(b"id|nm|v\n9|no|9\n")
    found = files.read_delimited_tree(spark, str(tmp_path), "*age*.csv", NAMES)
    assert sorted(map(tuple, found.na.fill({"nm": "-"}).collect())) == [
        ("1", "서울", 1.0),
        ("2", "순천", 2.0),
        ("3", "-", 3.0),
    ]


def test_tree_without_matches_is_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id|nm|v\n")
    assert files.read_delimited_tree(spark, str(tmp_path), "*zzz*.csv", NAMES).count() == 0


def test_newest_file_by_name(spark, tmp_path):
    for name in ("s_202501.csv", "s_202503.csv", "s_202502.csv", "t_202509.csv"):
        (tmp_path / name).write_text("id|nm|v\n")
    assert files.newest_file(spark, str(tmp_path), "s_*").endswith("s_202503.csv")
    with pytest.raises(FileNotFoundError):
        files.newest_file(spark, str(tmp_path), "none_*")


def test_zip_members(spark, tmp_path):
    def archive(name, members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for member, data in members.items():
                z.writestr(member, data)

    archive("a.zip", {"in/Flow_Age_Time_1.csv": "id|nm|v\n1|가|1\n2|나|x\n".encode("cp949"), "readme.txt": b"no"})
    archive("b.zip", {"flow_age_time_2.csv": "v|id|nm\n5|3|다\n".encode("utf-8")})
    archive("d.zip", {"flow_age_time_3.csv": b"id|nm|v\n6|x|6\n", "flow_age_time_4.csv": b"id|nm|v\n7|y|7\n"})
    archive("c.zip", {"nothing.csv": b"id|nm|v\n8|z|8\n"})
    found = files.read_zipped(spark, str(tmp_path), "flow_age_time", NAMES).drop("archive")
    assert sorted(map(tuple, found.na.fill(-1.0).collect())) == [("1", "가", 1.0), ("2", "나", -1.0), ("3", "다", 5.0), ("6", "x", 6.0), ("7", "y", 7.0)]


def test_lookup_json_plain_and_double_encoded(spark, tmp_path):
    doc = {"a": "10000001", "b": None, "c": 7}
    (tmp_path / "plain.json").write_text(json.dumps(doc, indent=4), encoding="utf-8")
    (tmp_path / "twice.json").write_text(json.dumps(json.dumps(doc)), encoding="utf-8")
    for name in ("plain.json", "twice.json"):
        found = files.read_lookup_json(spark, str(tmp_path / name)).na.fill("none")
        assert rows(found) == [("a", "10000001"), ("b", "none"), ("c", "7")]


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


ODD = ['plain', 'br}ace{', 'com,ma', 'quo"te', 'back\\slash', 'both\\"', '가게, "나"', '', '[}]{,', 'end\\\\']


def test_lookup_json_by_ranges(spark, tmp_path, small_splits):
    doc = {f"k{i} {ODD[i % 10]}": ODD[i % 7] * (i % 5 + 1) for i in range(400)} | {"long, one": "x,y}" * 3000}
    for name, text in (("line", json.dumps(doc)), ("indented", json.dumps(doc, indent=3, ensure_ascii=False)), ("tight", json.dumps(doc, separators=(",", ":")))):
        path = tmp_path / f"{name}.json"
        path.write_text(text, encoding="utf-8")
        found = files.read_lookup_json(spark, str(path))
        assert {r.key: r.value for r in found.collect()} == doc and found.count() == len(doc)
        assert json_ranges._fragments(spark, str(path), ",").rdd.getNumPartitions() > 10


def test_one_line_collection_by_ranges(spark, tmp_path, small_splits):
    ring = [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]]
    long_ring = [[float(i), float(i * i % 97)] for i in range(1200)]
    made = [
        {"type": "Feature", "properties": {"id": f"{i} {ODD[i % 10]}", "more": {"a": [1, {"b": "}"}]}},
         "geometry": {"type": "Polygon", "coordinates": [long_ring if i == 57 else ring]}}
        for i in range(150)
    ]
    doc = {"type": "FeatureCollection", "name": ODD[5], "crs": {"type": "name", "properties": {"name": "x"}}, "features": made, "bbox": [0, 0, 2, 2]}
    for name, text in (("line", json.dumps(doc)), ("indented", json.dumps(doc, indent=1)), ("tail", json.dumps(doc) + "\n\n")):
        path = tmp_path / f"{name}.geojson"
        path.write_text(text, encoding="utf-8")
        found = files.read_geojson(spark, str(path), ["id"])
        assert sorted((r.id, r.rings) for r in found.collect()) == sorted((f["properties"]["id"], f["geometry"]["coordinates"]) for f in made)
    (tmp_path / "several").mkdir()
    for k in range(3):
        (tmp_path / "several" / f"{k}.json").write_text(json.dumps({"features": made[k * 50 : k * 50 + 50]}))
    assert files.read_geojson(spark, str(tmp_path / "several"), ["id"]).count() == 150
    (tmp_path / "none.json").write_text('{"type":"FeatureCollection","features":[]}')
    assert files.read_geojson(spark, str(tmp_path / "none.json"), ["id"]).count() == 0


def test_members_of_one_archive_are_several_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(6):
            z.writestr(f"flow_{k}.csv", "id|nm|v\n" + "".join(f"{k}|a|{i}\n" for i in range(200)))
    found = files.read_zipped(spark, str(tmp_path), "flow_", NAMES)
    assert found.count() == 1200
    by_task = found.select("id", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r.task for r in by_task}) == len(by_task) == 6


SQUARE = [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]
HOLED = SQUARE + [[[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 1.5], [0.5, 0.5]]]


def features():
    def feature(name, kind, coordinates):
        return {"type": "Feature", "properties": {"id": name, "n": 1}, "geometry": {"type": kind, "coordinates": coordinates}}

    return [
        feature("1", "Polygon", HOLED),
        feature("2", "MultiPolygon", [[[[5, 5], [6, 5], [6, 6], [5, 5]]], [[[8, 8], [9, 8], [9, 9], [8, 8]]]]),
        feature("3", "Point", [1, 1]),
    ]


def test_geojson_document_and_lines(spark, tmp_path):
    document = tmp_path / "d.geojson"
    document.write_text(json.dumps({"type": "FeatureCollection", "features": features()}))
    lines = tmp_path / "l.geojson"
    body = ",\n".join(json.dumps(f) for f in features())
    lines.write_text('{"type": "FeatureCollection", "features": [\n' + body + "\n]}\n")
    for path, per_line in ((document, False), (lines, True)):
        found = files.read_geojson(spark, str(path), ["id"], one_feature_per_line=per_line)
        edges = spatial.edges_from_rings(found, "id")
        counts = edges.groupBy("poly_id", "ring_no").count().orderBy("poly_id", "ring_no").collect()
        assert [tuple(r) for r in counts] == [("1", 0, 4), ("1", 1, 4), ("2", 0, 3), ("2", 1, 3)]
        inside = spark.createDataFrame([(0.2, 0.2), (1.0, 1.0), (0.5, 1.0), (8.9, 8.5), (7.0, 7.0)], "x double, y double")
        located = {(r.x, r.y): r.grid_id for r in spatial.locate(inside, edges, 1.0).collect()}
        # The middle of the hole is outside, its rim inside.
        assert located == {(0.2, 0.2): "1", (1.0, 1.0): None, (0.5, 1.0): "1", (8.9, 8.5): "2", (7.0, 7.0): None}


def test_geojson_written_is_read_back(spark, tmp_path):
    source = tmp_path / "d.geojson"
    source.write_text(json.dumps({"type": "FeatureCollection", "features": features()[:1]}))
    found = files.read_geojson(spark, str(source), ["id"])
    sinks.write_geojson(found, str(tmp_path / "out"), ["id"])
    again = files.read_geojson(spark, str(tmp_path / "out"), ["id"], one_feature_per_line=True)
    assert again.collect() == found.collect()


def test_jdbc_options_read_in_ranges():
    options = files.jdbc_options("jdbc:x://h/db", "SELECT * FROM t;", "day", ("2025-01-01", "2025-02-01"), 8)
    assert options["dbtable"] == "(SELECT * FROM t) q"
    assert (options["partitionColumn"], options["numPartitions"]) == ("day", "8")
    with pytest.raises(ValueError):
        files.jdbc_options("jdbc:x://h/db", "SELECT 1", "day")


def flow_text(day_texts):
    names = [f.name for f in FLOW_FILE.fields]
    out = io.StringIO()
    out.write("|".join(names) + "\n")
    for i, day in enumerate(day_texts):
        row = {n: "1" for n in names} | {"id": f"1000000{i}", "type": "t", "timezn_cd": "7", "admi_cd": "46", "etl_ymd": day}
        out.write("|".join(row[n] for n in names) + "\n")
    return out.getvalue()


def test_months_are_replaced_and_rows_go_by_their_own_day(spark, tmp_path):
    source, target = tmp_path / "f.csv", str(tmp_path / "mart")
    source.write_text(flow_text(["20241231", "2025-01-01", "202501"]))
    mart = flow.with_month(flow.normalize_flow(files.read_delimited(spark, str(source), FLOW_FILE)))
    for _ in range(2):
        sinks.write_months(mart, target, sort=["etl_ymd", "timezn_cd", "id"])
    stored = spark.read.parquet(target)
    assert {r.crtr_ym: r["count"] for r in stored.groupBy("crtr_ym").count().collect()} == {202412: 1, 202501: 2}
    sinks.write_months(mart.filter("crtr_ym = '202501'").limit(1), target)
    assert spark.read.parquet(target).count() == 2
    first = stored.filter("crtr_ym = 202412").first()
    assert (first.m10, first.m20, first.m70, first.total, first.admi_cd) == (3.0, 2.0, 1.0, 1.0, "4600")


def test_month_tables_written_together(spark, tmp_path):
    a = spark.createDataFrame([("202501", 1)], "crtr_ym string, n int")
    bad = a.select("crtr_ym", F.raise_error(F.lit("stop")).cast("int").alias("n"))
    root = str(tmp_path / "marts")
    sinks.write_months_together({"a": a, "b": a}, root)
    with pytest.raises(Exception, match="stop"):
        sinks.write_months_together({"a": a.withColumn("n", F.lit(9)), "b": bad}, root)
    assert spark.read.parquet(root + "/a").select("n").first()[0] == 1
    sinks.write_months_together({"a": a, "b": a}, root)
    assert spark.read.parquet(root + "/b").count() == 1


def seen(spark, root, names=("a", "b")):
    return {n: sorted((r.crtr_ym, r.n) for r in editions.read(spark, root, n, "n int").collect()) for n in names}


def test_editions_are_seen_together(spark, tmp_path):
    root = str(tmp_path / "marts")
    first = spark.createDataFrame([("202501", 1), ("202502", 2)], "crtr_ym string, n int")
    assert seen(spark, root) == {"a": [], "b": []}
    editions.write_months({"a": first, "b": first}, root)
    old = {n: [("202501", 1), ("202502", 2)] for n in "ab"}
    assert seen(spark, root) == old
    again = spark.createDataFrame([("202502", 7)], "crtr_ym string, n int")
    bad = again.select("crtr_ym", F.raise_error(F.lit("stop")).cast("int").alias("n"))
    with pytest.raises(Exception, match="stop"):
        editions.write_months({"a": again, "b": bad}, root)
    assert seen(spark, root) == old
    for _ in range(2):
        editions.write_months({"a": again, "b": again}, root)
        assert seen(spark, root) == {n: [("202501", 1), ("202502", 7)] for n in "ab"}
    assert editions.remove_old(spark, root) == []
    gone = editions.remove_old(spark, root, older_than_s=0)
    assert len(gone) == 6 and len(list((tmp_path / "marts" / "_editions").glob("*.json"))) == 1
    assert seen(spark, root) == {n: [("202501", 1), ("202502", 7)] for n in "ab"}


def test_a_manifest_number_is_taken_once(spark, tmp_path):
    root = str(tmp_path / "marts")
    one = spark.createDataFrame([("202501", 1)], "crtr_ym string, n int")
    editions.write_months({"a": one}, root)
    assert not editions._add(spark, root, 1, {"a": {}})
    assert seen(spark, root, "a") == {"a": [("202501", 1)]}
    written = editions.write_edition({"b": one}, root)
    editions.write_months({"c": one}, root)
    editions.publish(spark, root, written)
    assert seen(spark, root, "abc") == {n: [("202501", 1)] for n in "abc"}


def test_append_replace_create(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    sinks.create_new(df, path)
    with pytest.raises(Exception, match="exists"):
        sinks.create_new(df, path)
    sinks.append(df, path)
    assert spark.read.parquet(path).count() == 6
    sinks.replace(df, path)
    assert spark.read.parquet(path).count() == 3


def test_result_table_shape_and_required_columns(spark):
    schema, required = RESULT_TABLES["payments_by_cell"]
    df = spark.createDataFrame([("c", "202501", 3)], "grid_id string, std_ym string, pay_cnt int")
    shaped = sinks.conform(sinks.stamp(df), schema)
    assert shaped.columns == [f.name for f in schema.fields]
    assert sinks.require(shaped, required).count() == 1
    missing = sinks.require(shaped.withColumn("grid_id", F.lit(None).cast("string")), required)
    with pytest.raises(Exception, match="must not be NULL"):
        missing.collect()


def test_create_table_if_missing(spark, tmp_path):
    for _ in range(2):
        sinks.create_table(spark, "flow_mart_t", FLOW_MART, str(tmp_path / "fm"), ["etl_ymd"])
    assert set(spark.table("flow_mart_t").columns) == {f.name for f in FLOW_MART.fields}
    spark.sql("DROP TABLE flow_mart_t")


def test_csv_and_lookup(spark, tmp_path):
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).collect() == df.collect()
    sinks.write_lookup(df, "key", "value", str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).collect() == df.collect()


def test_zipped_rows_are_packed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(file_queries, "ARCHIVE_ROWS", 1500)
    found = file_queries.zipped_members_read(spark, spark_entry.SMOKE_DIR)
    lines = spark.read.parquet(f"{spark_entry.SMOKE_DIR}/lineitem.parquet")
    want = lines.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("qty"), F.col("l_returnflag").alias("archive"))
    assert found.count() == want.count() and found.exceptAll(want).count() == 0
