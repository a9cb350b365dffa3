"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options the library relies on.

    Epoch values are instants, so the session zone must be UTC; landed timestamps are
    INT64 milliseconds, which Spark takes from the session and not from a write option.
    The JVM does not compile methods above 8000 bytes of code: for wide tables, single projections
    are faster than one fused stage of that size.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MILLIS")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir`` where the cluster names one. Only a local
    session without that setting may fall back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
