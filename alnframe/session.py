"""Session helpers.

Library code never creates its own session; it takes the caller's. ``local_session``
is for tests, the bench and scripts. ``shared_dir`` resolves the cluster's shared
folder (``spark.checkpoint.dir``) used to cut lineage or stage written tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "alnframe") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("ALNFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and is left
    as it is. Only an unconfigured session of one machine (tests, local scripts) gets a
    folder under the system temp directory; elsewhere an unset folder is an error."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no SparkContext on the client)
        sc = None
    if sc is None:
        if conf_dir:
            return conf_dir
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    current = sc.getCheckpointDir() or conf_dir
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="alnframe-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """As ``cut_lineage``, for wide rows: stored as Parquet with zstd, where a checkpoint holds rows as they lie in memory.
    Later stages read only the columns that they use."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
