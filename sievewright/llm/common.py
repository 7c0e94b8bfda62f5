"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Words as every contract of this subpackage counts them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Folders that :func:`cut` wrote inside the innermost :func:`sweeping`.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder; elsewhere a missing setting is an error.
    """
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


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, in the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage at a point that outlives lost executors and gives the
    planner true sizes.  Returns the reread frame and its path.
    """
    path = scratch_path(df.sparkSession, label)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder written by :func:`cut` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def sweeping(spark: SparkSession) -> Iterator[set[str]]:
    """Discard all that :func:`cut` writes inside the block but the paths put into the yielded set.

    What stays is what the block's result still reads; an enclosing block decides on it.
    """
    made: list[str] = []
    token, keep = _made.set(made), set()
    try:
        yield keep
    finally:
        _made.reset(token)
        for path in made:
            if path not in keep:
                discard(spark, path)
        outer = _made.get()
        if outer is not None:
            outer.extend(p for p in made if p in keep)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that ``df`` does not have (in any case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name
