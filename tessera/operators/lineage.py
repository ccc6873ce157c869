"""Cutting a plan's lineage where a loop needs it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, the folder that driver and executors share.

    Only a local session without that setting gets a folder of its own; a cluster without it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[.*)?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows written once to the shared folder as Parquet and read back; clear the folder between applications."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def held(rows: DataFrame) -> DataFrame:
    """rows as a checkpoint in the shared folder."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()
