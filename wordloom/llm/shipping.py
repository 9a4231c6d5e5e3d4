"""What Python workers need: the package's code and batches of bounded size."""

from __future__ import annotations

import os
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession

import wordloom

_SENT = "_wordloom_sent"
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Spark's default of 10,000 whole texts in a batch is too much for a worker and the JVM.
BATCH_ROWS = 512


def send_code(spark: SparkSession) -> None:
    """Give the package to the workers once per Spark application, and bound their batches.

    A driver that found it through its own ``sys.path`` has workers that do not. The
    session's limit of rows in an Arrow batch is lowered to ``BATCH_ROWS``; a lower one
    stays.
    """
    if not 0 < int(spark.conf.get(_ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, _SENT, False):
        return
    source = os.path.dirname(os.path.abspath(wordloom.__file__))
    folder = os.path.join(SparkFiles.getRootDirectory(), "code")
    os.makedirs(folder, exist_ok=True)
    archive = os.path.join(folder, "wordloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(source):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(top, name)
                out.write(path, os.path.relpath(path, os.path.dirname(source)))
    context.addPyFile(archive)
    setattr(context, _SENT, True)
