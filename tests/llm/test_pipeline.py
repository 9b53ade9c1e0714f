"""The pipeline and the registered queries."""

from __future__ import annotations

import duckdb
import pandas as pd

import __spark_entry__ as entry
import corpus_pipeline
from citypulse.llm import pieces
from citypulse.llm.registry import ORACLE, QUERIES
from tests.llm import brute

DIR = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13
    assert set(QUERIES) <= set(names) and "pipeline" in names


def test_secrets_oracle(spark):
    name = "op6_secret_scans"
    got = QUERIES[name](spark, DIR).toPandas()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DIR}/documents.parquet'")
    want = con.execute(ORACLE[name]).df()
    order = sorted(want.columns)
    got, want = (x[order].sort_values(order).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def rows_of(path: str, columns: str) -> list[tuple]:
    return duckdb.sql(f"select {columns} from '{path}'").fetchall()


def test_stages(spark, tmp_path):
    """Each stage against brute force on what the one before it kept."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, None, None, None), (9001, "1234 !!", None, None, None), (None, "no number here at all", "en", None, 3), (9002, "The same row again and again here", "en", "s", 1), (9002, "The same row again and again here", "en", "s", 1)], docs.schema)
    docs = docs.unionByName(odd)
    bench = rows_of(f"{DIR}/benchmark.parquet", "item_id, text")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        path = f"{tmp_path}/{name}"
        stage(spark, docs, DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name != "tokens":
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "language":
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == {9000, 9001}
        elif name == "near_duplicates":
            groups = brute.similar([(r.doc_id, r.text) for r in before if r.doc_id is not None], 5, 80)
            assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(d for d, (_, c) in groups.items() if d == c)
            assert sum(r.doc_id is None for r in after) == 1
        elif name == "contamination":
            bad = brute.contamination([(r.doc_id, r.text) for r in before], bench)
            assert {r.doc_id for r in after} == {d for d, v in bad.items() if not v[-1]}
        elif name == "secrets":
            texts = {r.doc_id: r.text for r in before}
            assert len(after) == len(before)
            assert all((r.text == texts[r.doc_id]) == (not brute.secrets(texts[r.doc_id])) and not brute.secrets(r.text) for r in after)
        else:
            own = pieces.encoder(pieces.default_model()).library
            texts = {r.doc_id: r.text for r in before}
            assert all(list(r.ids) == own.encode(texts[r.doc_id]) and r.decoded_sha256 == brute.sha(own.decode(list(r.ids))) for r in after)


def test_stages_on_empty(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DIR).count() == 0


def test_contamination_stage_by_row(spark, tmp_path):
    """A contaminated text without an id takes no clean one with it, and a long clean one hides none."""
    bench = " ".join(f"b{k}" for k in range(20))
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, bench), (None, " ".join(["clean"] * 900)), (None, None), (3, bench), (3, "another clean text")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted((str(d), str(t)) for d, t in (rows[1], rows[2], rows[4]))


def test_near_duplicates_stage_by_row(spark):
    """Unlike texts under one doc_id all stay; of copies one does, with a doc_id if any has one; nothing is said of empty texts."""
    one, two, three, four = (" ".join(f"{c}{k}" for k in range(40)) for c in "abcd")
    rows = [(1, one), (1, two), (2, three), (3, one + " end"), (None, two), (2, three), (None, four), (None, four + " x"), (9, ""), (9, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    nameless = [k for k in kept if k[0] is None and k[1]]
    assert sorted((k for k in kept if k[0] is not None)) == sorted([(1, one), (1, two), (2, three), (9, ""), (9, "")])
    assert len(nameless) == 1 and nameless[0][1].startswith(four) and kept.count((None, None)) == 1
