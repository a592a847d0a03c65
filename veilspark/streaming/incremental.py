"""STR-1: incremental protection of newly arrived landing files.

A file stream over the landing folder goes through the same hash
projection as the batch vault load and into Spark's parquet file sink.
The sink's commit log (``_spark_metadata``) and the query checkpoint
make the append exactly-once: a batch retried after a lost executor or a
restarted driver neither loses nor duplicates rows, and readers of the
output folder only see committed files. The salt subquery is planned
with each micro-batch, so the stream always uses the current wrapped
keys. ``trigger(availableNow=True)`` processes what has arrived and
stops, so the job can be scheduled like a batch job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from veilspark.operators.protect import hash_projection, plan_for_frame
from veilspark.session import scratch_path


def protect_stream(spark: SparkSession, source_path: str, schema: StructType, *,
                   sensitive: Mapping[str, str], unwrapped_keys: DataFrame,
                   transform: Callable[[DataFrame], DataFrame] | None = None,
                   out_path: str | None = None, checkpoint: str | None = None,
                   num_bits: int = 512, max_files_per_trigger: int | None = None,
                   file_glob: str | None = None, partition_by: list[str] | None = None) -> str:
    """Run the stream until all available files are protected; return ``out_path``.

    ``source_path`` is the landing folder; ``file_glob`` limits the files
    taken from it. Re-running with the same ``checkpoint`` and
    ``out_path`` picks up only files that arrived since the last run.
    """
    out_path = out_path or scratch_path(spark, "protected")
    checkpoint = checkpoint or scratch_path(spark, "protect-checkpoint")
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)
    if transform is not None:
        stream = transform(stream)
    protected = hash_projection(stream, plan_for_frame(stream, sensitive), unwrapped_keys, num_bits)
    writer = (
        protected.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    q = writer.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return out_path


def read_protected(spark: SparkSession, out_path: str) -> DataFrame:
    """All committed protected rows (the sink's commit log is honoured)."""
    return spark.read.parquet(out_path)
