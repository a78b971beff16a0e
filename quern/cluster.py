"""What a cluster needs: the package on the executors, the shared folder, and a lineage cut through it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, so that Python workers can import it wherever they start."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quern-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/quern_package.zip", "w") as z:
        for f in root.rglob("*.py"):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(f"{folder}/quern_package.zip")
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a temporary one, but only if driver and executors are one process: on a
    cluster a folder of the driver's would not be found, so that is an error."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="quern-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        folder = f"file://{folder}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage: the rows are written to the shared folder and read from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
