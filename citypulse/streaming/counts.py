"""Access counts per access point and window as a stream, and scoring of each new slot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from citypulse.ml.model import score_counts
from citypulse.operators.sensors import cell_counts
from citypulse.session import cut_lineage

# The window lengths in minutes the counts are kept at.
GRAINS = [5, 10, 60]
LATENESS = "10 minutes"


def window_counts(events: DataFrame, minutes: int, ts: str = "ts", ap: str = "ap_id", lateness: str = LATENESS) -> DataFrame:
    """Events per access point and tumbling window: ``std_date, ap_id, cnt``. Batch or stream.

    On a stream a window is given out once, after the watermark has passed its end; state is one
    row per open window and access point.
    """
    timed = events.withWatermark(ts, lateness) if events.isStreaming else events
    counted = timed.groupBy(F.window(ts, f"{minutes} minutes"), F.col(ap).alias("ap_id")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counted.select(F.col("window.start").alias("std_date"), "ap_id", "cnt")


def to_table(counts: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer that appends closed windows to parquet; files are committed once per batch."""
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def slot_scorer(ap_cells: DataFrame, model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """Scoring of window counts per access point: summed per cell, then predicted.

    A window closes for all access points in the same batch, so the sums of a cell are complete.
    """
    return lambda batch: score_counts(cell_counts(batch, ap_cells), model)


def score_slots(
    counts: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    slot: str = "std_date",
    key: str = "grid_id",
) -> DataStreamWriter:
    """Writer that scores every closed slot and keeps one row per cell and slot.

    Output is partitioned by slot (``slot_key``, its UTC seconds). A slot is given out in one batch only, once
    its window has closed, so a batch that is retried, a restart and a later fill each replace just
    the slots they hold. Two rows of one cell and slot are an error.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = cut_lineage(score(batch).withColumn("slot_key", F.unix_timestamp(F.col(slot).cast("timestamp"))))
        double = scored.groupBy(key, slot).count().filter("count > 1").first()
        if double is not None:
            raise ValueError(f"batch {batch_id}: {double['count']} rows for {key} {double[key]} at {double[slot]}")
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot_key").parquet(path)

    return counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)


def merge_scores(
    summary: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, slot: str = "std_date"
) -> DataStreamWriter:
    """Writer that scores every slot a batch brings rows for, from all rows of that slot so far.

    For counts that arrive as files, also late: rows of a slot that was scored before are added to it and its
    scores are replaced, so there is one row a cell and slot however the rows were dealt over batches. The rows
    of a batch are stored under their day and its number, ``<path>/counts``, where a batch that is retried replaces its
    own; the scores by day, ``<path>/scores``. Only the days of the batch are read and scored again.
    """
    day = F.to_date(F.col(slot).cast("timestamp")).alias("day")

    def replace(df: DataFrame, folder: str, *parts: str) -> None:
        # All rows of a part in one place first: a file each, not one for each task.
        rows = df.repartition(*parts)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = cut_lineage(batch.filter(F.col(slot).isNotNull()).select("*", day, F.lit(batch_id).alias("batch")))
        days = rows.select("day").distinct()
        if days.isEmpty():
            return
        replace(rows, f"{path}/counts", "day", "batch")
        kept = spark.read.schema(rows.schema).parquet(f"{path}/counts").filter(F.col("batch") <= batch_id)
        whole = kept.join(days, "day", "left_semi").drop("day", "batch")
        replace(score(whole).withColumn("day", day), f"{path}/scores", "day")

    return summary.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
