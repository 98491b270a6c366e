"""Session settings that the engine's semantics rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: ANSI arithmetic and casts, UTC texts, the TIME type, and limits of recursive queries.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.cteRecursionLevelLimit": "10000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the engine's runtime settings on a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def builder(app: str = "tessera", master: str | None = None, shuffle_partitions: int | None = None):
    """A SparkSession builder with the engine's settings; ``getOrCreate()`` ends it."""
    b = SparkSession.builder.appName(app).config(map=SETTINGS).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that spark.checkpoint.dir names. Only a local session may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return "file:///tmp/checkpoints"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's source to the Python workers, once an application, wherever the driver runs."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tessera-")  # the driver serves the file as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tessera_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
