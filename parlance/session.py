"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "parlance") -> SparkSession:
    """Build (or reuse) a session with the settings this engine relies on.

    * AQE on: runtime coalescing of small shuffles, skew-join splitting and
      the runtime switch of a shuffle join to a broadcast join when one side
      turns out to be below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
      (the size check behind every data-derived broadcast in this package).
    * ANSI stays on (Spark 4 default); expressions use ``get`` /
      ``try_element_at`` / ``try_divide`` so absent values are NULL, not errors.
    * The UI is off: no server is opened.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (distributed) folder and is used
    as is; without it this raises, since a folder of the driver's machine would be
    lost to the executors.  Only a local master (tests) gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="parlance-ckpt-", dir=os.environ.get("PARLANCE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def persisted(df: DataFrame) -> DataFrame:
    """``df`` computed once, by a reliable checkpoint in the shared folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
