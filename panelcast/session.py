"""Session helpers: sane defaults for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether an execution's shuffle files are deleted as soon as it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "panelcast") -> SparkSession:
    """Builder with AQE on. On a cluster, pass master=None and let spark-submit decide."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", os.environ.get("PANELCAST_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent *and* Spark runs in local mode (tests) do
    we create our own folder; on a cluster a missing setting is an error,
    because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        configured = tempfile.mkdtemp(prefix="panelcast-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint: it would be lost with its executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage and survives lost executors. The folder is removed
    when the driver's JVM ends; the shuffle files of the write go when it is
    done, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).deleteOnExit(folder)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete what ``shared_table`` wrote for these tables; nothing that is still to be computed may read them."""
    for df in tables:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.shared_path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
