"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The two 64-byte key pads of a token print as 128 hex digits in plan texts.
_KEY_PAD_PATTERN = r"0x[0-9A-Fa-f]{128}|[0-9A-F]{128}"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.redaction.string.regex": _KEY_PAD_PATTERN,
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job here relies on to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "txnflow", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only where the setting is absent and all runs in one process, as in tests,
    a folder is made. On a cluster each machine would write its own disk, so
    the setting is required there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="txnflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` as Parquet to the shared folder and go on from the written rows.

    Values that depend on how rows were partitioned stay as they were written
    even when an executor is lost later.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
