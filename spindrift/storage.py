"""The folder that driver and executors share: intermediate tables, and the package on every executor."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
#: Tables that clean() deletes, by application.
_written: dict[str, list[str]] = {}
#: Spark's setting that a query's shuffle files go as it ends, not when the driver's collector comes across them.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a temporary folder for a local master, and an error for any other, whose executors would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spindrift-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable on every executor. Once for an application; the archive goes when the driver ends."""
    sc = spark.sparkContext
    if getattr(sc, "_spindrift_shipped", None) != sc.applicationId:
        fd, name = tempfile.mkstemp(prefix="spindrift-", suffix=".zip")
        os.close(fd)
        atexit.register(lambda: Path(name).unlink(missing_ok=True))
        with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(PACKAGE.rglob("*.py")):
                z.write(p, p.relative_to(PACKAGE.parent))
        sc.addPyFile(name)
        sc._spindrift_shipped = sc.applicationId
    return spark


def materialise(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, a lost executor loses nothing, and what the plan shuffled goes at once. With `keep`, clean() leaves the table alone."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/spindrift-{uuid.uuid4().hex}"
    before = spark.conf.get(FREES_SHUFFLES, "false")
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREES_SHUFFLES, before)
    if not keep:
        _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._spindrift_path = path
    return found


def _delete(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def discard(*tables: DataFrame) -> None:
    """Deletes tables of materialise() that no plan still to be run reads."""
    for df in tables:
        spark, path = df.sparkSession, df._spindrift_path
        _delete(spark, path)
        written = _written.get(spark.sparkContext.applicationId, [])
        if path in written:
            written.remove(path)


def clean(spark: SparkSession) -> int:
    """Deletes the intermediate tables that this application has written, through Spark's own file systems; how many. For when their results have been saved."""
    return sum(_delete(spark, name) for name in _written.pop(spark.sparkContext.applicationId, []))
