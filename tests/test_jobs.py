"""Jobs end to end, model storage, streaming."""

import datetime as dt
import json

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from citypulse import __main__ as command
from citypulse.ml import model
from citypulse.ml.quantile import QuantileToNormal
from citypulse.operators import sensors
from citypulse.operators.spatial import cell_edges
from citypulse.plans import jobs, lookups
from citypulse.schemas import FLOW_FILE
from citypulse.sources import files
from citypulse.streaming import counts


def write_flow(path, days):
    names = [f.name for f in FLOW_FILE.fields]
    lines = ["|".join(names)]
    for i, day in enumerate(days):
        row = {n: "1" for n in names}
        row |= {"id": f"1000000{i % 9}", "type": "t", "timezn_cd": str(i % 24), "total": "2.125", "admi_cd": "46", "etl_ymd": day}
        lines.append("|".join(row[n] for n in names))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_flow_job_through_the_command_line(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write_flow(source / "a_flow_age_time_202412_v1.csv", ["20241201"])
    write_flow(source / "a_flow_age_time_202412_v2.csv", ["20241201", "20241231", "2024-12-31", "20250101"])
    for _ in range(2):
        command.main(["--root", root, "flow", "202412", "--source", str(source)])
    stored = spark.read.parquet(f"{root}/flow")
    assert {r.crtr_ym: r["count"] for r in stored.groupBy("crtr_ym").count().collect()} == {202412: 3, 202501: 1}
    hours = jobs.read_report(spark, root, "flow_by_hour")
    assert sorted((r.timezn_cd, float(r.total_population), r.crtr_ym) for r in hours.collect()) == [
        ("0", 2.13, "202412"), ("1", 2.13, "202412"), ("2", 2.13, "202412"),
    ]
    bands = {(r.gender, r.age): float(r.total_population) for r in jobs.read_report(spark, root, "flow_by_sex_age").collect()}
    assert len(bands) == 14 and bands["M", "10"] == 9.0 and bands["F", "70"] == 3.0
    days = jobs.read_report(spark, root, "flow_by_district_day")
    assert sorted((r.etl_ymd.isoformat(), float(r.total_population)) for r in days.collect()) == [("2024-12-01", 2.13), ("2024-12-31", 4.25)]


def test_month_scan_prunes_partitions(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write_flow(source / "flow_age_time_202412.csv", ["20241201", "20250101"])
    jobs.load_flow(spark, str(source), "202412", root)
    from citypulse.operators.flow import flow_by_hour

    plan = flow_by_hour(jobs.read_flow(spark, root), "202412")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(crtr_ym" in plan and "PushedFilters: [IsNotNull(etl_ymd)" in plan
    assert "m10" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_economy_job(spark, tmp_path):
    root = str(tmp_path / "out")
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "local_grid_id.json").write_text(json.dumps({"가게": "10000001", "집": None}), encoding="utf-8")
    (tmp_path / "CITY_SOHO_STAT_2507.txt").write_text(
        "QID50|BS_YR_MON|SIC_CD_LV4|SHOP_CNT|OP_CNT|NEW_OPN_CNT|RUN_OUT_CNT|RUN_OUT2_CNT|TOT_SALE_AMT|" + "|".join(f"TOT_SALES_AMT{i}_CNT" for i in range(6))
        + "|WGS84_X|WGS84_Y|UTMK_X|UTML_Y\n10000001|202501|S1|1|2|3|4|5|10.5|0|1|2|3|4|5|1|1|1|1\n", encoding="utf-8"
    )
    (tmp_path / "CITY_IND_CODE.txt").write_text("SIC_CD|SIC_FST_CLSFY_ITM_NM|SIC_SCND_CLSFY_ITM_NM\nS1|big|small\n")
    (tmp_path / "local_pay_2501.csv").write_text(
        "번호,결제년월일,가맹점명,업종,결제금액,생년월일,거주지주소,가맹점주소\n1,2025-01-02,가게,음식,1000,20000101,x,y\n"
        "2,2025-01-03,가게,음식,500,,x,y\n3,2025-01-03,집,음식,500,,x,y\n", encoding="utf-8"
    )
    for target in ("all", "local2"):
        jobs.economy_tables(spark, str(tmp_path), target, root)
    stats = spark.read.parquet(f"{root}/business_stats").first()
    assert (stats.grid_id, stats.std_ym, stats.sic_fst_clsfy_itm_nm, stats.tot_sales_amt5m_cnt) == ("10000001", "202501", "big", 5)
    cells = spark.read.parquet(f"{root}/payments_by_cell").collect()
    assert [(r.grid_id, r.std_ym, r.pay_cnt, int(r.pay_amt)) for r in cells] == [("10000001", "202501", 2, 1500)]
    assert spark.read.parquet(f"{root}/payments").count() == 3
    with pytest.raises(ValueError):
        jobs.economy_tables(spark, str(tmp_path), "other", root)


def test_resident_job_through_the_command_line(spark, tmp_path):
    address = {"rd_code": "46", "regn_code": "9", "bdng_orgno": "1", "bdng_subno": None, "san": "1"}

    def frame(rows, columns, prefix=None):
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
        return df.withColumns({prefix + k: F.lit(v).cast("string") for k, v in address.items()}) if prefix else df

    tables = {
        "heads": frame([("h", "10", "S")], ["jumin_head_sid", "jumin_state_code", "data_crtr_dt"], "jumin_"),
        "members": frame([("0001011", "h", "10", "S")], ["jumin_sid", "jumin_head_sid", "jumin_state_code", "data_crtr_dt"]),
        "moves_in": frame([("0001012", "S")], ["jumin_sid", "data_crtr_dt"], "jumin_inr_"),
        "moves_out": frame([("0001013", "S")], ["jumin_sid", "data_crtr_dt"], "jumin_exr_"),
        "addresses": frame([("46-1", "here")], ["addr_id", "address"]),
        "address_grid": frame([("here", "10000001")], ["address", "grid_id"]),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/in/{name}")
    root = str(tmp_path / "out")
    command.main(["--root", root, "residents", "--tables", f"{tmp_path}/in", "--as-of-date", "2025-06-01"])
    read = {n: [tuple(r) for r in spark.read.parquet(f"{root}/{n}").collect()] for n in
            ("households_by_cell", "movers_in_by_cell", "movers_out_by_cell", "residents_by_cell")}
    assert read == {
        "households_by_cell": [("10000001", 1, 1, 0, 0, 0)],
        "movers_in_by_cell": [("10000001", "F", "20", 1)],
        "movers_out_by_cell": [("10000001", "M", "20", 1)],
        "residents_by_cell": [("10000001", "M", "20", 1)],
    }


def test_presence_job(spark, tmp_path):
    data = [("d", dt.datetime(2025, 7, day, 12), "join", "ap", 127.6, 34.7, 1) for day in (1, 2, 5)]
    log = spark.createDataFrame(data, "client_mac_addr string, logging_date timestamp, event_name string, ap_name string, lon double, lat double, cnt long")
    jobs.presence_tables(log, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/device_months").first().max_streak == 2
    assert spark.read.parquet(f"{tmp_path}/visits_by_place").first()["size"] == 3
    assert spark.read.parquet(f"{tmp_path}/paths").count() == 3
    assert spark.read.parquet(f"{tmp_path}/path_kinds").first().kind == "line"


def squares(spark, n=4):
    return spark.createDataFrame(
        [(f"1000000{i}", float(i), 0.0, float(i + 1), 1.0) for i in range(n)], "id string, x0 double, y0 double, x1 double, y1 double"
    )


def test_lookup_jobs(spark):
    import struct

    def point(lon, lat):
        return (b"\x01" + struct.pack("<I", 1) + struct.pack("<dd", lon, lat)).hex()

    aps = spark.createDataFrame([("a", point(0.5, 0.5)), ("b", point(9.0, 9.0)), ("c", None), ("d", point(1.0, 0.5))], "ap_id string, location string")
    grid = cell_edges(squares(spark))
    assert {r.ap_id: r.grid_id for r in lookups.ap_cells(aps, grid, 1.5).collect()} == {"a": "10000000", "b": None, "c": None, "d": "10000001"}
    shops = spark.createDataFrame([("s", 0.5, 0.5, 1), ("s", 2.5, 0.5, 2), ("t", 500.0, 0.5, 1)], "merchant string, lon double, lat double, n int")
    found = lookups.points_to_cells(shops, "merchant", "lon", "lat", grid, 1.5, "n")
    assert {r.merchant: r.grid_id for r in found.collect()} == {"s": "10000002", "t": None}
    register = spark.createDataFrame(
        [("46", None, "1", None, "1", "here", 0.5, 0.5, 1), ("46", None, "2", "3", "2", "there", 3.5, 0.5, 2)],
        "JUMIN_RD_CODE string, JUMIN_REGN_CODE string, JUMIN_BDNG_ORGNO string, JUMIN_BDNG_SUBNO string, JUMIN_SAN string, ADDR string, LON double, LAT double, N int",
    )
    names, cells = lookups.address_lookups(register, "addr", "lon", "lat", grid, 1.5, "n")
    assert {r.addr_id: r.address for r in names.collect()} == {"46-1": "here", "46-S2-3": "there"}
    assert {r.address: r.grid_id for r in cells.collect()} == {"here": "10000000", "there": "10000003"}


def test_grid_jobs(spark, tmp_path):
    def ring(x0, y0, x1, y1):
        return [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]

    grid = spark.createDataFrame([(f"1000000{i}", ring(i * 1.0, 0.0, i + 1.0, 1.0)) for i in range(6)], "id string, rings array<array<array<double>>>")
    regions = spark.createDataFrame([("City A", ring(0.5, 0.2, 1.5, 0.8)), ("Town B", ring(4.2, 0.2, 4.8, 0.8))], "name string, rings array<array<array<double>>>")
    jobs.filter_grid(grid, regions, "name", "City", 1.0, str(tmp_path / "kept"))
    kept = files.read_geojson(spark, str(tmp_path / "kept"), ["id"], one_feature_per_line=True)
    assert sorted(r.id for r in kept.collect()) == ["10000000", "10000001"]
    jobs.grid_with_districts(grid, regions, "name", 1.0, str(tmp_path / "districts"))
    found = {r.id: r.admin_cd for r in spark.read.parquet(str(tmp_path / "districts")).collect()}
    assert found == {f"1000000{i}": "City A" if i < 3 else "Town B" for i in range(6)}
    with pytest.raises(Exception, match="exists"):
        jobs.grid_with_districts(grid, regions, "name", 1.0, str(tmp_path / "districts"))


def sample_inputs(spark, hours=24 * 14):
    start = dt.datetime(2025, 1, 1)
    summary = [(start + dt.timedelta(hours=h), f"ap{a}", (h * 7 + a * 13) % 50) for h in range(hours) for a in range(4)]
    flow = [
        (f"1000000{a}", "t", str(h % 24), (start + dt.timedelta(hours=h)).strftime("%Y%m%d"), float((h * 7 + a * 13) % 50 * 3 + h % 24), "46")
        for h in range(hours) for a in range(4)
    ]
    return (
        spark.createDataFrame(summary, "std_date timestamp, ap_id string, cnt int"),
        spark.createDataFrame([(f"ap{a}", f"1000000{a}") for a in range(4)], "ap_id string, grid_id string"),
        spark.createDataFrame(flow, "id string, type string, timezn_cd string, etl_ymd string, total double, admi_cd string"),
    )


def test_training_and_scoring(spark, tmp_path):
    summary, cells, flow_raw = sample_inputs(spark)
    path = str(tmp_path / "model")
    metrics = jobs.train_model(summary, cells, flow_raw, path, {"maxIter": [6], "maxDepth": [5], "stepSize": [0.4]})
    assert metrics["r2"] > 0.8
    fitted, entry = model.load_bundle(spark, path)
    assert isinstance(fitted, PipelineModel) and entry["r2"] == pytest.approx(metrics["r2"])
    assert json.loads(entry["best_params"])["maxIter"] == 6
    summary.write.parquet(str(tmp_path / "summary"))
    cells.write.parquet(str(tmp_path / "cells"))
    command.main(["--root", str(tmp_path / "out"), "score", "--summary", str(tmp_path / "summary"), "--ap-cells", str(tmp_path / "cells"), "--model", path])
    scored = spark.read.parquet(str(tmp_path / "out" / "cell_predictions")).collect()
    assert len(scored) == 4 and {r.std_date for r in scored} == {dt.datetime(2025, 1, 14, 23)}
    assert all(isinstance(r.predicted_total, int) and r.predicted_total >= 0 and r.reg_dttm for r in scored)
    assert model.score_since(summary, cells, fitted, "2025-01-14").count() == 96


def test_models_and_importance(spark):
    summary, cells, flow_raw = sample_inputs(spark, 24 * 7)
    rows = model.model_rows(sensors.training_frame(sensors.cell_counts(summary, cells), sensors.flow_slots(flow_raw)))
    train, test = model.split_by_key(rows, ["grid_id", "std_date"])
    again = model.split_by_key(rows.repartition(13), ["grid_id", "std_date"])[0]
    assert train.count() == again.count() and train.count() + test.count() == rows.count()
    bases = {"by_forest": model.forest(numTrees=5, maxDepth=5), "by_boosted": model.boosted("absolute", maxIter=5)}
    stacked = model.stack(train, model.scaled_features(), bases, ["grid_id", "std_date"], model.forest(numTrees=10), folds=3)
    trees, _ = model.tune(train, model.scaled_features(), model.forest(numTrees=5), {"maxDepth": [5]})
    table = model.comparison(spark, {"stacked": model.predict(stacked, test), "forest": model.predict(trees, test)}).collect()
    assert [r.r2 for r in table] == sorted((r.r2 for r in table), reverse=True) and table[0].r2 > 0.5
    boosted = Pipeline(stages=[*model.quantile_features(), model.boosted(maxIter=5)]).fit(train)
    importance = model.feature_importance(spark, boosted, train).collect()
    assert importance[0].feature == "acs_cnt_score" and sum(r.importance for r in importance) == pytest.approx(1.0)


def test_unseen_values_do_not_stop_scoring(spark):
    df = spark.createDataFrame([("Monday", 0.0), ("Friday", 1.0)], "dayname string, is_weekend_group double")
    new = spark.createDataFrame([("Sunday", 2.0)], "dayname string, is_weekend_group double")
    fitted = Pipeline(stages=[model.day_index(), model._category()]).fit(df)
    found = fitted.transform(new).first()
    assert found.dayname_encoded == 2.0 and list(found.is_weekend_group_hot.toArray()) == [0.0, 0.0]
    assert [r.dayname_encoded for r in fitted.transform(df).collect()] == [1.0, 0.0]


def test_normal_scores_are_stored(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 40), float(i)) for i in range(400)], "a double, b double")
    fitted = QuantileToNormal(inputCols=["a", "b"], outputCols=["za", "zb"], maxKnots=50).fit(df)
    before = fitted.transform(df).agg(F.avg("za"), F.avg("zb"), F.stddev("zb")).first()
    assert abs(before[0]) < 0.2 and abs(before[1]) < 0.2 and 0.8 < before[2] < 1.3
    path = str(tmp_path / "q")
    PipelineModel(stages=[fitted]).save(path)
    again = PipelineModel.load(path).transform(df)
    assert again.exceptAll(fitted.transform(df)).count() == 0


def test_stream_counts_equal_their_batch_twin(spark, tmp_path):
    start = dt.datetime(2025, 1, 1)
    data = [(start + dt.timedelta(seconds=37 * i), i % 5) for i in range(400)]
    schema = "ts timestamp, ap_id int"
    for part in range(4):
        spark.createDataFrame(data[part * 100 : part * 100 + 100], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    query = counts.to_table(counts.window_counts(stream, 5), out, str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    last = max(t for t, _ in data)
    batch = counts.window_counts(spark.createDataFrame(data, schema), 5)
    closed = batch.filter(F.col("std_date") + F.expr("INTERVAL 5 MINUTES") <= F.lit(last) - F.expr("INTERVAL 10 MINUTES"))
    found = spark.read.parquet(out)
    assert found.exceptAll(closed).count() == 0 and closed.exceptAll(found).count() == 0 and closed.count() > 0


def test_stream_scorer_sums_points_of_a_cell(spark):
    summary, cells, flow_raw = sample_inputs(spark, 48)
    rows = model.model_rows(sensors.training_frame(sensors.cell_counts(summary, cells), sensors.flow_slots(flow_raw)))
    fitted = Pipeline(stages=[*model.scaled_features(), model.boosted(maxIter=2)]).fit(rows)
    at = dt.datetime(2025, 1, 5)
    batch = spark.createDataFrame([(at, "ap0", 3), (at, "ap9", 4), (at, "zz", 5)], "std_date timestamp, ap_id string, cnt long")
    both = spark.createDataFrame([("ap0", "c"), ("ap9", "c")], "ap_id string, grid_id string")
    found = counts.slot_scorer(both, fitted)(batch).collect()
    assert [(r.grid_id, r.acs_cnt) for r in found] == [("c", 7)] and found[0].predicted_total >= 0


def test_late_rows_of_a_scored_slot_are_added(spark, tmp_path):
    schema = "std_date timestamp, ap_id long, cnt long"
    at = lambda h: dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)
    score = lambda rows: rows.groupBy("std_date").agg(F.sum("cnt").alias("acs_cnt")).withColumn("predicted_total", F.col("acs_cnt") * 2.0)

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        writer = counts.merge_scores(stream, score, str(tmp_path / "out"), str(tmp_path / "state"))
        writer.trigger(availableNow=True).start().awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out" / "scores")).collect()
        return sorted(((r.std_date - at(0)).total_seconds() // 3600, r.acs_cnt, r.predicted_total) for r in found)

    assert run([(at(0), 1, 5), (at(0), 2, 1), (at(30), 1, 2), (None, 1, 9)]) == [(0, 6, 12.0), (30, 2, 4.0)]
    late = [(0, 10, 20.0), (1, 7, 14.0), (30, 2, 4.0)]
    assert run([(at(0), 3, 4), (at(1), 1, 7)]) == late
    # A batch that is given again under its number replaces its own rows.
    again = spark.createDataFrame([(at(0), 3, 4), (at(1), 1, 7)], schema)
    taken = []
    holder = type("Frame", (), {"writeStream": type("W", (), {"outputMode": lambda s, m: s, "option": lambda s, k, v: s, "foreachBatch": lambda s, f: taken.append(f)})()})()
    counts.merge_scores(holder, score, str(tmp_path / "out"), str(tmp_path / "state"))
    taken[0](again, 1)
    found = spark.read.parquet(str(tmp_path / "out" / "scores")).collect()
    assert sorted(((r.std_date - at(0)).total_seconds() // 3600, r.acs_cnt, r.predicted_total) for r in found) == late


def test_streamed_scores_replace_just_their_own_slots(spark, tmp_path):
    schema = "std_date timestamp, grid_id string, acs_cnt long"
    score = lambda batch: batch.withColumn("predicted_total", F.col("acs_cnt") * 2.0)

    def run(name, rows, state):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / name))
        writer = counts.score_slots(stream, score, str(tmp_path / "out"), str(tmp_path / state))
        writer.trigger(availableNow=True).start().awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r.std_date.hour, r.grid_id, r.acs_cnt) for r in found)

    at = lambda h: dt.datetime(2025, 1, 1, h)
    first = run("a", [(at(h), f"c{i}", h + i) for h in range(2) for i in range(2)], "state_a")
    assert first == [(0, "c0", 0), (0, "c1", 1), (1, "c0", 1), (1, "c1", 2)]
    # New input under a new checkpoint: slot 1 is filled again, slot 2 is new, slot 0 stays.
    second = run("b", [(at(1), "c0", 9), (at(2), "c0", 7)], "state_b")
    assert second == [(0, "c0", 0), (0, "c1", 1), (1, "c0", 9), (2, "c0", 7)]
    with pytest.raises(Exception, match="2 rows for grid_id"):
        run("c", [(at(3), "c0", 1), (at(3), "c0", 2)], "state_c")
