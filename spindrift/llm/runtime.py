"""Session helpers: the package on every executor, bounded Arrow batches."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession

from spindrift.storage import discard, materialise, shared_dir, ship

__all__ = ["discard", "materialise", "prepare", "shared_dir"]

#: Bytes in an Arrow batch: long texts must not pile up in one Python worker.
ARROW_BYTES = "4194304"


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable on every executor and bound the Arrow batches. Idempotent for a context.

    Spark deletes shuffle files and broadcasts once the driver's collector finds
    their plans unused; a driver with little to do collects seldom, so an operator
    that begins asks for it, and what the one before it shuffled goes.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return ship(spark)
