"""Small file-system checks through the session's Hadoop FileSystem
(works for any scheme the cluster is configured for: hdfs, s3a, file …)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` ([] when it does not exist)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def batch_ids(spark: SparkSession, root: str, column: str = "batch_id") -> list[int]:
    """Batch ids present under ``root`` as ``<column>=<n>`` folders."""
    prefix = column + "="
    out = []
    for name in list_names(spark, root):
        if name.startswith(prefix):
            try:
                out.append(int(name[len(prefix):]))
            except ValueError:
                pass
    return sorted(out)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of ``text``, replacing one that is there."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
