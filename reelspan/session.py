"""Sessions, and the package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch on its way to a Python worker, where the session names none. Both
#: sides hold several copies of a batch, so it stays far below an executor's memory.
ARROW_BATCH_BYTES = 8 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: dict[str, str] = {}


def build_session(app: str = "reelspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC times; ``conf`` overrides."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's source to the executors, once for each application, and bound
    Arrow batches by bytes unless the session does."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, ARROW_BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        fd, path = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(path)
        _shipped[app] = path
    return spark
