"""Tables written on the way, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session may do without the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = found.get() if found.isDefined() else None
    if root is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sievewright-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read back: the lineage ends at files that outlive lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
