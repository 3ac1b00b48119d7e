"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary folder only on a local master without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix="tradewatch-llm-")


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and go on from that copy.

    Later actions read the copy, also after executors are lost, and row ids made before it stay.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows as Parquet below the checkpoint folder and read them, so Spark knows their size."""
    folder = f"{checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of all executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tradewatch-code-")) / "tradewatch_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
