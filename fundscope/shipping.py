"""The package's sources for Python workers that don't have it on their path."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DONE: set[str] = set()
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def ship(spark: SparkSession) -> None:
    """Send the sources to the executors, once per application.

    Arrow batches are kept to 16 MB, unless the session has a bound of its own: the kernels hold a few copies of one.
    """
    if spark.conf.get(_BATCH[0], None) is None:
        spark.conf.set(*_BATCH)
    app = spark.sparkContext.applicationId
    here = os.path.dirname(os.path.abspath(__file__))
    if app in _DONE or not os.path.isdir(here):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="fundscope-src-"), "fundscope.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    spark.sparkContext.addPyFile(archive)
    _DONE.add(app)


def shipped(operator):
    """An operator whose first argument, a frame or a session, tells where to send the sources before it starts."""

    @functools.wraps(operator)
    def run(first: DataFrame | SparkSession, *args, **kwargs):
        ship(first if isinstance(first, SparkSession) else first.sparkSession)
        return operator(first, *args, **kwargs)

    return run
