"""Bronze from a folder that grows: every file lands once.

A file stream with ``availableNow`` takes the files that its checkpoint has not
seen, so a run lands what is new and nothing twice. Each micro-batch is a bronze
batch of its own, written to its ``_batch_id`` folder: a micro-batch that runs again
replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.plans.medallion import land


def land_new_files(spark: SparkSession, source: str, bronze: str, checkpoint: str, schema: StructType | str,
                   run_ts: str, prefix: str = "files", fmt: str = "parquet", hash_columns: Sequence[str] | None = None,
                   max_files_per_batch: int | None = None) -> None:
    """Lands the files of ``source`` that are not in ``bronze`` yet, with the bronze
    metadata columns; ``_batch_id`` is ``<prefix>-<number of the micro-batch>``.

    ``schema`` is the files' (a stream does not guess it). Files that are being written must
    appear under their final name only when complete, as Spark's own do."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    rows = reader.load(source)
    columns = list(hash_columns or rows.columns)
    named = rows.withColumn("_source_file", F.col("_metadata.file_path"))

    def write(batch: DataFrame, batch_id: int) -> None:
        landed = land(batch, f"{prefix}-{batch_id}", run_ts, source_file=F.col("_source_file"), hash_columns=columns)
        (landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("_batch_id").parquet(bronze))

    q = (named.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


__all__ = ["land_new_files"]
