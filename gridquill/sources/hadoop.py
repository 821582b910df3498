"""Paths through Hadoop's file systems: what Spark reads from, these functions see too."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _opened(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where, system = _opened(spark, path)
    system.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str | bytes) -> None:
    """A small file from the driver."""
    where, system = _opened(spark, path)
    out = system.create(where, True)
    out.write(bytearray(text.encode() if isinstance(text, str) else text))
    out.close()


def numbered(spark: SparkSession, path: str, prefix: str = "run=") -> list[int]:
    """Sorted numbers of the finished folders prefix<number> below path; none if path isn't there."""
    where, system = _opened(spark, path)
    if not system.exists(where) or not system.getFileStatus(where).isDirectory():
        return []
    jvm = spark.sparkContext._jvm
    found = (s.getPath() for s in system.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith(prefix))
    return sorted(int(p.getName()[len(prefix) :]) for p in found if system.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's path below spark.checkpoint.dir, which all executors share.

    Without that setting a cluster has no folder that is safe to write to, so this raises; with a local master
    the machine's own temporary folder is shared by all there is.
    """
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/gridquill-checkpoints"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
