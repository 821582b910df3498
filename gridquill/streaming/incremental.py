"""Incremental runs: new files as micro-batches, each added durably once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_new_files(spark: SparkSession, source: str, ddl: str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d, fmt: str = "parquet", glob: str | None = None, files_per_batch: int = 1000) -> int:
    """Read files that the checkpoint hasn't seen, write their transformed rows to target, stop; returns the batches run.

    The source's log keeps what was read. A batch is written to a folder of its own number, so a batch that is run
    again after a failure replaces itself rather than adding rows twice.
    """
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        stream = stream.option("pathGlobFilter", glob)
    done = []

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")
        done.append(number)

    query = stream.format(fmt).load(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def read_runs(spark: SparkSession, target: str) -> DataFrame:
    """Rows of all batches, with the batch number."""
    return spark.read.option("basePath", target).parquet(target)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key's rows those of the latest batch: a file that came again replaces what it gave before."""
    newest = rows.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return rows.join(newest, [*keys, "batch"], "left_semi")

