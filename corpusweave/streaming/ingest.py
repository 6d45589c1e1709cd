"""Incremental ingestion: counts of arriving facts, kept up to date batch by batch.

The stream is aggregated by Spark's own stateful operators under a watermark, so state for closed windows is dropped. Each
batch writes the windows it changed under its batch number; a batch that is run again replaces its own rows, and readers
take the latest row of a window, so a restart neither loses nor doubles counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_counts(stream: DataFrame, at: str, keys: list[str], value: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Number and sum of values per key and window; rows later than ``late`` behind the newest are dropped by the watermark."""
    g = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, size).alias("w"), *keys)
    return g.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def run_available(counts: DataFrame, out: str, state: str) -> None:
    """All data that is there now, in batches; resumes from ``state``."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    counts.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def current(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The latest counts of every window and key."""
    df = spark.read.parquet(out)
    rest = [c for c in df.columns if c not in (*keys, "window_start", "batch")]
    best = df.groupBy("window_start", *keys).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return best.select("window_start", *keys, "r.*")
