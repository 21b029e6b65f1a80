"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "soldscope", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; ``conf`` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": os.environ.get("SOLDSCOPE_DRIVER_MEMORY", "8g"),
    }
    settings.update(conf)
    return build_session(master=f"local[{cores}]", **settings)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver was started.

    Functions of a package reach a worker by name only, so a worker must be able to import it.
    """
    context = spark.sparkContext
    if getattr(context, "_soldscope_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="soldscope-"), "soldscope.zip")
    with zipfile.ZipFile(archive, "w") as held:
        for path in sorted(package.rglob("*.py")):
            held.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)  # Spark's own file server hands it to the executors
    context._soldscope_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the session.

    Only a local session without ``spark.checkpoint.dir`` (a test) gets a folder of its own: on a
    cluster the executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="soldscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def reliable_checkpoint(spark: SparkSession, df):
    """``df`` written to the shared checkpoint folder, so that lost executors cost no recomputation."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint()


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends, not when the driver happens to collect its garbage.

    What was written is what later steps read; without this every step's shuffles add up on disk.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df, name: str, *by: str):
    """``df`` as a table in the shared checkpoint folder, read back with its columns prunable; ``by`` makes folders."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with brief_shuffles(spark):
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of written tables below the shared checkpoint folder; nothing may read them any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/{folder}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
