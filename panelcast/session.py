"""Session construction and lineage cutting.

On a cluster the session is created by the platform; ``get_session`` is
for tests, the bench and local runs. It sets only what is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every run of this library expects. AQE re-plans joins from the
# materialised shuffle sizes (runtime broadcast only under the threshold),
# coalesces small partitions and splits skewed sort-merge join partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "panelcast") -> SparkSession:
    master = master or os.environ.get("PANELCAST_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", os.environ.get("PANELCAST_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = tempfile.mkdtemp(prefix="panelcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used before iterative loops (hyper-parameter search, per-fold fits) so a
    lost executor re-reads the checkpoint instead of recomputing the chain.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
