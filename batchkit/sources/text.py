"""Text-line scans."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from batchkit.operators.partitions import num_partitions


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line, column ``value``; a line ends at \\n, \\r\\n or \\r.

    Files are split by ``spark.sql.files.maxPartitionBytes``.  With ``min_partitions`` the
    byte ranges are planned for that number instead, as ``textFile(path, n)`` does: a
    range is at most total bytes / n, so there are at least n of them (fewer only if there are fewer
    bytes, and compressed files stay whole), and no row is shuffled.  Where the JVM isn't at hand
    (Spark Connect) rows are dealt out anew if the scan has too few partitions.
    """
    if not min_partitions:
        return spark.read.text(path)
    try:
        lines = spark.sparkContext._jsc.textFile(path, min_partitions)
        jvm = spark.sparkContext._jvm
        return DataFrame(spark._jsparkSession.createDataset(lines.rdd(), jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)
    except (AttributeError, PySparkException):  # no SparkContext in this session
        df = spark.read.text(path)
        return df if num_partitions(df) >= min_partitions else df.repartition(min_partitions)
