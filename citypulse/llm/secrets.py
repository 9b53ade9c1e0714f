"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of every file is addressed by the SHA-256 of its text. The ledger holds which
(blob, rule, rule version) pairs have been scanned and what was found; a run scans only pairs that
it does not hold yet, appends them, and joins the findings back to all versions. A text that
returns under many paths or in many versions is scanned once; a changed rule is rescanned alone.

Defined results: a null text is an empty text; repeated rows are versions of their own and each is
returned; an empty input gives an empty result; columns of the input other than its text are kept,
and columns with the names of the results are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citypulse.llm.registry import query
from citypulse.llm.storage import shared_folder, stored, table


class Rule(NamedTuple):
    """``pattern`` finds candidates, leftmost and non-overlapping; those whose ``group`` is too short are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The base patterns. A run that is too short cannot hold a long enough one, so the two
# run patterns state their least length themselves.
RULES = (
    Rule("assign", 1, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """Add the content address of every version."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; one that does not exist yet is empty."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def _found(text: Column, rule: Rule) -> Column:
    """Candidates of a rule in a text: length of what stands before each, of itself and of its group."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.when(
        F.size(hits) > 0,
        F.arrays_zip(
            F.slice(F.transform(F.split(text, rule.pattern, -1), F.length), 1, F.size(hits)).alias("gap"),
            F.transform(hits, F.length).alias("size"),
            F.transform(hits, lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.group))).alias("held"),
        ),
    )


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text", path: str = "path") -> DataFrame:
    """Scan the unseen (blob, rule version) pairs of ``versions`` and append them to ``ledger``.

    ``versions`` needs ``blob`` (see ``addressed``). Returns the findings of the ledger, one row per
    blob, kind and version of ``rules`` that has any.
    """
    spark = versions.sparkSession
    known = _ledger(spark, ledger)
    asked = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    # The least path stands for its blob: a minimum combines before the shuffle, however many copies there are.
    pending = (
        versions.groupBy("blob").agg(F.min(path).alias("at"))
        .select("blob", "at", F.inline(asked))
        .join(known.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
        .groupBy("blob", "at").agg(F.collect_set("kind").alias("kinds"))
        .withColumnRenamed("blob", "own")
    )
    unseen = versions.select("blob", path, F.coalesce(F.col(text), F.lit("")).alias("text")).join(
        pending, (F.col("blob") == F.col("own")) & F.col(path).eqNullSafe(F.col("at"))
    )
    results = F.filter(
        F.array(
            *(
                F.when(
                    F.array_contains("kinds", r.kind),
                    F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"), _found(F.col("text"), r).alias("found")),
                )
                for r in rules
            )
        ),
        lambda result: result.isNotNull(),
    )
    scanned = stored(unseen.select("blob", F.inline(results)), "scanned")
    one = Window.partitionBy("blob", "kind", "version")
    before = one.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        scanned.filter(F.col("found").isNotNull()).dropDuplicates(["blob", "kind", "version"])
        .select("blob", "kind", "version", "least", F.posexplode("found").alias("pos", "hit"))
        .withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.size")).over(before).cast("int"))
        .filter(F.col("hit.held") >= F.col("least"))
        .groupBy("blob", "kind", "version")
        .agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("hit.size")).alias("start"), "end"))).alias("spans"))
    )
    pairs = scanned.select("blob", "kind", "version").distinct().join(found, ["blob", "kind", "version"], "left")
    pairs.select("blob", "kind", "version", F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans")).write.mode("append").parquet(ledger)
    current = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(i).alias("place")) for i, r in enumerate(rules)))
    return (
        _ledger(spark, ledger).filter(F.size("spans") > 0).withColumn("rule", F.explode(current))
        .filter((F.col("kind") == F.col("rule.kind")) & (F.col("version") == F.col("rule.version")))
        .select("blob", "kind", F.col("rule.place").alias("place"), "spans")
    )


def findings(versions: DataFrame, found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Join findings back to every version: ``secrets`` holds its spans by start, then rule; the text is left out."""
    each = found.select("blob", "kind", "place", F.inline("spans")).groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "end", "kind"))).alias("secrets")
    )
    return versions.join(each, "blob", "left").withColumn(
        "secrets", F.coalesce("secrets", F.expr("cast(array() as array<struct<start:int,place:int,end:int,kind:string>>)"))
    )


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with a mask in place of each run of touching spans. ``spans`` as ``findings`` gives them."""
    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))

    def put(state: Column, span: Column) -> Column:
        clear = span["start"] >= state["at"]
        piece = F.concat(F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mask))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(clear, F.concat(state["parts"], F.array(piece))).otherwise(state["parts"]).alias("parts"),
        )

    return F.aggregate(spans, begin, put, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))))


_BASE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, 'assign' AS kind, 0 AS place, 8 AS least, regexp_extract_all(text, {assign}) AS hits,
         regexp_extract_all(text, {assign}, 2) AS held, regexp_split_to_array(text, {assign}) AS gaps FROM d
  UNION ALL
  SELECT doc_id, 'access', 1, 16, regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_split_to_array(text, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL
  SELECT doc_id, 'hex', 2, 32, regexp_extract_all(text, '[0-9a-f]{{32,}}'),
         regexp_extract_all(text, '[0-9a-f]{{32,}}'), regexp_split_to_array(text, '[0-9a-f]{{32,}}') FROM d
),
h AS (
  SELECT doc_id, kind, place, least, unnest(range(1, len(hits) + 1)) AS i, hits, held, gaps FROM m WHERE len(hits) > 0
),
p AS (
  SELECT doc_id, kind, place, least, length(held[i]) AS held, length(hits[i]) AS size,
         sum(length(gaps[i]) + length(hits[i])) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM h
),
s AS (SELECT doc_id, kind, place, stop - size AS start, stop FROM p WHERE held >= least),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
""".format(assign="'" + RULES[0].pattern.replace("'", "''") + "'")


@query("op6_secret_scans", _BASE_SQL)
def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    folder = shared_folder(spark)
    versions = addressed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = scan(versions, f"{folder}/ledger", path="doc_id")
    secrets = findings(versions.select("doc_id", "blob"), found)
    spans = F.concat_ws(",", F.transform("secrets", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secrets.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))
