"""A corpus pipeline of five stages, each on all rows that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a frame with the columns of documents; the last
one returns its tokens. What a stage returns is written as Parquet before the next one is called, and read
again as its docs; intermediate tables of a stage are removed when the next one begins. Rows are documents, whatever their doc_id: it may be null or that of other rows, too.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm import contamination, jaccard, language, pieces, secrets
from citypulse.llm.storage import deleted, scope, shared_folder, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MASK = "[secret]"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents in one of the labelled languages; those it cannot tell go."""
    texts = language.sample(docs)
    return language.identify(docs.select(COLUMNS), texts).filter(F.col("lang_pred") != language.UNKNOWN).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each component of similar documents (five words, 0.8) the one with the least doc_id stays.

    Of rows that are alike in doc_id and text one stays; rows with one doc_id and unlike texts are documents of their own,
    and so are rows without a doc_id, which stay only if nothing with one is similar. Texts without words all stay.
    """
    groups = jaccard.similar(docs, Fraction(4, 5), 5)
    first = groups.filter("n_shingles > 0").select("first.r1", "first.r2").distinct()
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = docs.filter(worded).select(*COLUMNS, *jaccard.row_hash(F.col("doc_id"), F.col("text")))
    kept = kept.join(first, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"])
    return kept.select(COLUMNS).unionByName(docs.filter(~worded).select(COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents of which less than a twentieth are benchmark windows."""
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    # By the text and not by the id, which may be null or repeated: a verdict depends on nothing else.
    bad = found.filter("contaminated").select("text_sha256").distinct()
    return docs.join(bad, contamination.text_digest(docs["text"]) == bad["text_sha256"], "left_anti").select(COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: each secret of a document becomes a mask; the document stays."""
    versions = secrets.addressed(docs.select(COLUMNS))
    found = secrets.scan(versions, f"{shared_folder(spark)}/ledger", path="doc_id")
    marked = secrets.findings(versions, found)
    masked = secrets.masked(F.col("text"), F.col("secrets"), MASK)
    changed = F.size("secrets") > 0
    return marked.select(
        "doc_id", F.when(changed, masked).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(changed, F.length(masked).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: tokens of each document and digests of its round trip."""
    return pieces.tokenized(docs.select(COLUMNS), pieces.default_model(), outputs="all").drop("text", "decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders that the last stage left behind.
_LEFT: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, which first removes what the one before it kept on disk: that one's result is written by now."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        deleted(spark, _LEFT)
        _LEFT.clear()
        with scope() as made:
            out = stage(spark, docs, sf_dir)
        _LEFT.extend(made)
        return out

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language", _tidy(known_language)),
    ("near_duplicates", _tidy(near_duplicates)),
    ("contamination", _tidy(decontaminated)),
    ("secrets", _tidy(without_secrets)),
    ("tokens", _tidy(encoded)),
]

# Similarity components, suffix automata and token merges have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
