"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job should start with. Sizes (memory, cores, shuffle
# partitions) belong to the cluster and are left to spark-submit.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

PACKAGE_ZIP = "themeweave-workers.zip"


def local_session(cores: int | str = "*", app: str = "themeweave", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``.

    Not needed where the cluster has it installed or gets it by ``--py-files``.
    """
    if PACKAGE_ZIP in spark.sparkContext._python_includes:
        return
    root = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="themeweave-zip-")) / PACKAGE_ZIP.removesuffix(".zip")
    spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", root.parent, root.name))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    already_set = spark.sparkContext.getCheckpointDir()
    if already_set:
        return already_set
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="themeweave-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and go on from the files.

    This cuts the lineage of iterative jobs, survives lost executors, and gives
    the next stage exact size statistics to choose its joins by.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
