"""What every operator shares: session helpers, durable cuts of lineage, shipping code to workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data folder; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset and Spark runs in one process, a temporary folder; on a cluster that is an error, because
    executors would write each to a disk of their own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.gettempdir()}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: The paths written since each open temporary() began, the innermost last.
_open: list[list[str]] = []


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: later steps start from files, not from lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_materialized(*frames: DataFrame) -> None:
    """Delete the files behind frames made by materialize(), once nothing reads them any more."""
    for df in frames:
        for f in {os.path.dirname(x) for x in df.inputFiles()}:
            if os.path.basename(f).startswith("cut-"):
                _delete(df.sparkSession, f)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """On leaving, delete all that materialize() wrote inside, but for what went through the function it gives.

    That function writes a frame that outlives the block; it may not read from the block's files later.
    """
    _open.append([])
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        out = materialize(df)
        kept.append(_open[-1].pop())
        return out

    try:
        yield keep
    finally:
        for path in _open.pop():
            _delete(spark, path)
        if _open:
            _open[-1] += kept


#: Bytes of an Arrow batch that goes to a Python worker; the default of 64 MB is held several times over by each task.
ARROW_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the workers this package, wherever the driver found it, and batches of ARROW_BYTES unless others are set."""
    if _ARROW not in spark.conf.getAll:
        spark.conf.set(_ARROW, str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="ship-")
    target = os.path.join(folder, f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, f"{_PACKAGE.name}/{p.relative_to(_PACKAGE)}")
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
