"""Session helpers: a tuned builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .errors import TransferError


def build_session(app: str = "ferryline", cpus: int | str = "*", memory: str = "8g",
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording a call site per column expression slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def one_row(spark: SparkSession) -> DataFrame:
    """A row that Spark evaluates while it plans: literals are computed without a job."""
    return spark.sql("VALUES (1)")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    base = context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise TransferError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/ferryline/{label}-{uuid.uuid4().hex}"
