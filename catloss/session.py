"""Session helpers: a local session for tests and the checkpoint folder rule."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "catloss") -> SparkSession:
    """Local session as used by tests and the bench (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session names; set one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is used
    as is. Only a local-mode session without one (tests, bench) gets a fresh
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookups raise on unknown keys
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="catloss-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


class Scratch:
    """Intermediate tables of one run, as Parquet below the shared checkpoint folder.

    What is written is read back from files that all executors see, so that a lost executor
    costs its running tasks only; ``close`` removes them all.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/catloss-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        stream = [c for c in df.columns if c == "_stream"]
        df.write.partitionBy(*stream).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def close(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
