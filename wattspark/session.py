"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """All instants are UTC; the rest of the session is the cluster's business.

    HotSpot does not compile methods beyond 8,000 bytes of code, as the parse of messages becomes in one stage:
    such a stage runs expression by expression, each of them compiled.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``.

    A machine-local folder is only used where the setting is absent and Spark
    runs in a single local process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="wattspark-")
    return f"{base.rstrip('/')}/wattspark-{uuid.uuid4().hex}/{name}"
