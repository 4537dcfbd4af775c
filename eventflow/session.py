"""Session helpers: settings the engine relies on, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "eventflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs.

    On a cluster, use the cluster's session and call :func:`configure`.
    """
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("EVENTFLOW_DRIVER_MEM", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every eventflow plan assumes.

    * UTC session time zone: the reference coerces all instants to UTC.
    * AQE with skew-join splitting: propagation joins aggregates back to rows
      on the series key, and one series may hold a third of all rows.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # small scans of heavy rows still use every core; large ones have more splits anyway
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests, local
    runs) a fresh scratch folder is created; on a cluster a missing setting
    is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="eventflow-ckpt-")  # local mode only (tests, local runs)
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialise ``df`` in the shared checkpoint folder.

    Used where a plan must see exactly the same rows twice (partition-offset
    numbering) or where iterative re-labelling would grow the lineage.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df: DataFrame, schema=None) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back
    (with ``schema``, if other than its own): lineage is cut, and a lost executor
    only costs a reread."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
