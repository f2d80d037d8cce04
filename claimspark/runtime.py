"""Session, checkpoint and partition helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "claimspark", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (tests, one local JVM) a temporary folder is used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), "claimspark-checkpoints")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage and survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.sparkContext.defaultParallelism), 1)


def partitions(df: DataFrame) -> int:
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def spread(df: DataFrame) -> DataFrame:
    """Give a scan that has fewer partitions than there are cores one for each core.

    Only small inputs (one row group, one file) are affected: with as many
    splits as cores or more the frame is returned as it is, without a shuffle.
    """
    n = parallelism(df.sparkSession)
    return df.repartition(n) if partitions(df) < n else df


_SHIPPED = "_claimspark_shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each SparkContext."""
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    setattr(sc, _SHIPPED, True)
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="claimspark-"), "claimspark.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("claimspark", os.path.relpath(path, root)))
    sc.addPyFile(target)


_LOCAL: dict = {}


def once(key: str, make):
    """make() once for each Python worker and key: tables that take long to build outlive a task."""
    if key not in _LOCAL:
        if len(_LOCAL) >= 4:
            _LOCAL.clear()
        _LOCAL[key] = make()
    return _LOCAL[key]
