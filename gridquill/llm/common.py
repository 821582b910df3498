"""What the corpus operators share: scratch tables, hashing columns, input reading."""

from __future__ import annotations

import atexit
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import hadoop

#: Word characters of every word count and shingle here: all but ASCII white space.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_see_package(spark: SparkSession) -> None:
    """Python workers on this host find the package wherever the driver was started, and get batches of fewer rows.

    On a cluster the package is installed or passed with ``--py-files``.
    """
    # Rows here are whole texts: Spark's default of 10,000 rows would be batches of many megabytes on both sides.
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *[p for p in paths if p]])


class Scratch:
    """Intermediate tables as Parquet in the folder that the cluster names in spark.checkpoint.dir.

    Writing a table cuts the lineage: lost executors cost the running step only. A cluster without that setting
    is an error; on one machine (tests) its temporary folder takes the setting's place. Results are plans
    over these tables, so the tables stay until clear() or the end of the driver's program.
    """

    def __init__(self, spark: SparkSession, label: str):
        workers_see_package(spark)
        self.spark, self.root, self.count = spark, hadoop.shared_folder(spark, label), 0
        atexit.register(self.clear)

    def table(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        # Shuffle files of a step go as soon as its table is written; else they would stay until the driver collects its garbage.
        before = self.spark.conf.get(FREE_SHUFFLES, None)
        try:
            self.spark.conf.set(FREE_SHUFFLES, True)
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(FREE_SHUFFLES) if before is None else self.spark.conf.set(FREE_SHUFFLES, before)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for df in tables:
            hadoop.delete(self.spark, df._scratch_path)

    def clear(self) -> None:
        """Delete all tables."""
        if self.count and self.spark.sparkContext._jsc is not None:
            hadoop.delete(self.spark, self.root)


#: A table goes to every task only below this size.
BROADCAST_BYTES = 32 << 20


def fits(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Are the rows, at 16 bytes and what their values take, below most bytes? A few more rows than could fit are looked at."""
    sizes = F.lit(16 + 8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes = sizes + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            sizes = sizes + 8 * F.greatest(F.size(F.col(f"`{field.name}`")), F.lit(0))
    seen = df.select(sizes.cast("long").alias("b")).limit(most // 24 + 1).agg(F.coalesce(F.sum("b"), F.lit(0))).first()[0]
    return seen <= most


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df to be broadcast if it fits, else as it is: joins then shuffle."""
    return F.broadcast(df) if fits(df, most) else df


def hashed_rows(rows: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """rows (doc_id, text, source, others) with skey and h, a hash that no two rows of a source share but by chance.

    h comes from the id. Rows of one source that share an id are hashed by their text too, and equal ones by
    their number among each other, so null and repeated ids are spread like others. Numbers come from counts
    by file of a written table and places inside a file: no task sees all copies of a row.
    """
    keyed = rows.withColumns({"skey": source_key(F.col("source")), "h": hash60(F.lit(seed), F.col("doc_id"))})
    again = scratch.table(keyed.groupBy("skey", "h").agg(F.count("*").alias("n")).where("n > 1").select("skey", "h"), "repeated")
    if not again.limit(1).count():
        return keyed
    again = small(again)
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    repeated = scratch.table(keyed.join(again, ["skey", "h"], "left_semi").withColumn("_text", text), "rows")
    placed = repeated.select("*", F.col("_metadata.file_path").alias("_file"))
    key = ["skey", "h", "_text"]
    counts = placed.groupBy(*key, "_file").agg(F.count("*").alias("_n"))
    before = counts.select(*key, "_file", (F.sum("_n").over(W.partitionBy(*key).orderBy("_file")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(W.partitionBy(*key, "_file").orderBy(F.lit(0))) - 1
    numbered = placed.withColumn("_place", place).join(before, [*key, "_file"])
    told = numbered.withColumn("h", hash60(F.col("h"), F.col("_text"), F.col("_before") + F.col("_place")))
    single = keyed.join(again, ["skey", "h"], "left_anti")
    return single.unionByName(told.select(*single.columns))


def hash60(*cols: Column) -> Column:
    """First 60 bits of the MD5 of the columns as text, a non-negative BIGINT (nulls as an empty field)."""
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def source_key(col: Column) -> Column:
    """A never-null key that keeps null apart from every text; nulls sort last."""
    return F.when(col.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), col))


def held_out(doc_id: Column, buckets: int, bucket: int) -> Column:
    """True where crc32 of the id's decimal text falls in the held-out bucket; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(buckets)) == bucket
