"""Small helpers of the text operators: table reading, shared storage, word patterns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only where it is unset (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files every executor can read, and gives the planner
    the table's true size: a join against it is a broadcast only while that
    size is under ``spark.sql.autoBroadcastJoinThreshold``, a shuffle beyond.
    The files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(word: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII words take the built-in fast path."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, UPPER.lower()))


def row_key(*cols: str) -> Column:
    """128-bit key of a row's content, as text: rows equal in ``cols`` share it, and among 1e11 others an accidental pair has odds of about 1e-17."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in cols]
    return F.concat_ws("-", F.hex(F.xxhash64(*values)), F.hex(F.xxhash64(F.lit("second"), *values)))
