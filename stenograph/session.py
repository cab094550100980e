"""Sessions, the shared folder, and cutting lineage without losing fault tolerance."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def build_session(app: str = "stenograph", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators expect: UTC, adaptive execution, Arrow.

    Cluster settings (master, memory, shared folder) come from spark-submit; nothing here overrides
    them unless it is passed explicitly.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session (one machine) may lack the setting; it then gets a temporary folder. A
    cluster without a shared folder is an error, since a machine-local path would lose data.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        keep = tempfile.TemporaryDirectory(prefix="stenograph-")
        atexit.register(keep.cleanup)
        _LOCAL[app] = f"file://{keep.name}"
    return _LOCAL[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/stenograph-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the context has usually gone by now; the folder belongs to the application
        pass


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where a result feeds several branches: the lineage is cut, a lost executor costs only its
    own tasks, and each branch reads just the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
