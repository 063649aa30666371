"""Scaling new data with saved training statistics, as a stream.

Name normalisation, filters, transforms and scaling with *precomputed*
statistics are per-row projections, so they run unchanged on a streaming
DataFrame.  This is the inference path: statistics fitted once on the
training split are applied to fields as they arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Variable
from ..functions.expr import transform_column
from ..operators.aggregate import Stats
from ..operators.scale import scaling_column
from ..sources.grids import null_nans


def scale_stream(stream: DataFrame, var: Variable, stats: Stats, value: str | None = None) -> DataFrame:
    """Transform then scale every arriving row with the train statistics."""
    value = value or var.name
    out = null_nans(stream)
    if var.transforms():
        out = out.withColumn(value, transform_column(out[value], var.transforms()))
    if var.apply_standardize or var.apply_normalize:
        out = out.withColumn(value, scaling_column(var.name, value, stats, var.apply_standardize,
                                                   var.apply_normalize))
    return out


def read_field_stream(spark: SparkSession, source_dir: str, schema: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def start_scaling(spark: SparkSession, source_dir: str, schema: str, var: Variable, stats: Stats,
                  sink_dir: str, checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """Parquet in → scaled Parquet out; the checkpoint makes restarts exactly-once."""
    stream = scale_stream(read_field_stream(spark, source_dir, schema), var, stats)
    writer = (stream.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
