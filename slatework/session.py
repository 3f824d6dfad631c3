"""Session defaults and the staging area used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_STAGE: dict[str, str] = {}


def local_session(app: str = "slatework", cores: str | int = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local master (tests) may fall back to a temporary folder, because
    on a cluster other machines could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.applicationId not in _LOCAL_STAGE:
        _LOCAL_STAGE[sc.applicationId] = tempfile.mkdtemp(prefix="slatework-stage-")
    return _LOCAL_STAGE[sc.applicationId]


def stage_path(spark: SparkSession, label: str) -> str:
    return os.path.join(stage_root(spark), f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as parquet (zstd) in the staging area and read it back.

    Used where one expensive table feeds several passes: the later passes get a
    columnar, prunable scan, and a lost executor only re-reads files.
    """
    path = stage_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
