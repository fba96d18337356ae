"""Streams: the stateless operators run on them unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from limpid.operators import filters
from limpid.plans import pipelines


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_stream(rows: DataFrame, coefficients: dict[str, float], medium: str = "water", low: float | None = None, high: float | None = None) -> DataFrame:
    """Filter and score a stream of measurements: filters and projections only, so it keeps no state."""
    x = filters.in_range(filters.equals(rows, "solvent", medium), "temp_C", low, high, keep_null=True)
    none = F.lit(None).cast("double")
    return pipelines.execute(x, coefficients, none, none)


def windowed_counts(rows: DataFrame, at: str = "ingested_at", width: str = "1 day", late: str = "30 days") -> DataFrame:
    """(window, source, n, mean_logS) per window of event time; rows later than the watermark are left out."""
    x = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return x.groupBy(F.window(at, width), "source").agg(F.count("*").alias("n"), F.avg("logS").alias("mean_logS"))


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Starts writing to Parquet; stops by itself when the files at hand are done."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
