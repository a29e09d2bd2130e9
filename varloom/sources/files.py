"""Names of files, by Spark's own file systems."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

#: Bytes of files that a task reads at least, where there are more files than tasks.
TASK_BYTES = 32_000_000


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files of a folder and those below it, sorted, without hidden ones; empty files aren't listed."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs, out = top.getFileSystem(spark._jsc.hadoopConfiguration()), []
    if not fs.exists(top):
        raise ValueError(f"no such file or folder: {path}")
    found = fs.listFiles(top, True)
    root = fs.makeQualified(top).toString()
    while found.hasNext():
        status = found.next()
        name = status.getPath().toString()
        if status.getLen() and not any(x.startswith(("_", ".")) for x in name[len(root) :].split("/")):
            out.append(name)
    return sorted(out)


def packed(read: DataFrame) -> DataFrame:
    """A scan of many small files in fewer tasks: Spark counts each file as some MB, so by itself it reads a few files a task.
    Tasks follow the bytes of the files then, and are four times the cores at least."""
    size = int(read._jdf.queryExecution().analyzed().stats().sizeInBytes())
    tasks = max(4 * read.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    return read.coalesce(tasks) if read.rdd.getNumPartitions() > 2 * tasks else read
