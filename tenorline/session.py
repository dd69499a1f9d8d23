"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """The one setting the engine relies on: all stored instants are UTC, and date(dt) is
    only defined under that zone.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _one_machine_folder() -> str:
    return tempfile.mkdtemp(prefix="tenorline-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves, but only if everything runs on
    one machine, as in tests; on a cluster this raises instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _one_machine_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
