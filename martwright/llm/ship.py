"""Send this package to the executors, so that tasks can import it on any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Once per application: a zip of the package through Spark's own file distribution.

    Arrow batches are kept to 2,000 rows unless the session says otherwise, as rows are whole texts.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="martwright-")), "martwright_tasks.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(os.path.join(root, "martwright")):
                for n in sorted(names):
                    if n.endswith(".py"):
                        z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
        spark.sparkContext.addPyFile(path)
        _SENT.add(app)
    return spark
