"""Sessions: one for local runs, and this code made known to the workers of any other."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Bytes of an Arrow batch to or from Python, as Spark and as this package sets them. Spark's rows a batch
#: (10000) and bytes let pages and long documents fill both sides with tens of MB for each task.
_BATCH_KEY, _SPARK_BYTES, BATCH_BYTES = (
    "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20)


def ship(spark: SparkSession, *packages: str) -> None:
    """Send the Python code of this package, and of its neighbours named, to the workers, and bound the
    session's Arrow batches by ``BATCH_BYTES``, unless it has a bound of its own.

    Needed wherever the code is not installed on them. It is sent once per application.
    """
    if spark.conf.get(_BATCH_KEY, _SPARK_BYTES) == _SPARK_BYTES:
        spark.conf.set(_BATCH_KEY, f"{BATCH_BYTES}b")
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="stratalog-")) / "stratalog.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for package in ("stratalog", *packages):
            for source in sorted((root / package).rglob("*.py")):
                archive.write(source, source.relative_to(root))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stratalog")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
