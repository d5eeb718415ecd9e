"""The package and batches of rows on their way to Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

_SHIPPED = "_lectern_shipped"


def ship(spark) -> None:
    """Sends the package's sources to Python workers, once a context, so that they need no install and no search path."""
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # not when it runs from such a file itself
        archive = Path(tempfile.mkdtemp(prefix="lectern-")) / "lectern_sources.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, Path(root.name) / f.relative_to(root))
        sc.addPyFile(str(archive))
    setattr(sc, _SHIPPED, True)


#: Rows and bytes of a batch on its way to Python.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b")}


def small_batches(spark) -> None:
    """Operators on whole texts need small batches, or two workers of an executor hold hundreds of MB each. Sets the session's limits where they are Spark's defaults."""
    for key, (default, small) in BATCH.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, small)
