"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where it is unset (tests on one machine) a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="helixframe-"))
    return _own[0]


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The copy outlives lost executors and cuts the lineage, so later readers neither
    recompute ``df`` nor depend on any executor's local files.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._helixframe_path = path
    return back


def release(df: DataFrame | None) -> None:
    """Delete the files of a table that ``materialize`` made and nobody reads any more."""
    path = getattr(df, "_helixframe_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def spread(rows: DataFrame) -> DataFrame:
    """``rows``, dealt out evenly where they come straight from a scan of fewer tasks than there are cores."""
    if "AdaptiveSparkPlan" in rows._jdf.queryExecution().executedPlan().toString():
        return rows  # dealt out by an exchange of its own
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def fresh(df: DataFrame, name: str) -> str:
    """A name for a helper column that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bound_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Prepare a session for Python operators: bound their Arrow batches where it leaves Spark's defaults, and send the package.

    Texts may be long, so the default of 10,000 rows a batch is no bound on memory.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b") or 0) >= 1 << 28:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    _ship(spark)


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    handle, name = tempfile.mkstemp(prefix="helixframe-", suffix=".zip")
    with os.fdopen(handle, "wb") as f:
        f.write(held.getvalue())
    context.addPyFile(name)
    _shipped.add(context.applicationId)
