"""Session helpers shared by queries, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent

_shipped: set[str] = set()


def build(app: str = "prefmill", cpus: int | str = "*", partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution, for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers.

    Nothing is sent where the repository is on PYTHONPATH or is the working
    directory; elsewhere the package is added once per application as a zip.
    """
    on_path = os.environ.get("PYTHONPATH", "").split(":")
    if str(ROOT) in on_path or Path.cwd() == ROOT:
        return
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    target = os.path.join(tempfile.mkdtemp(), "prefmill.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((ROOT / "prefmill").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; the path is left to Spark's readers."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
