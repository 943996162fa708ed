"""Send this package to the workers, so that tasks find it wherever the driver was started from."""

import os
import tempfile
import zipfile

_SENT = set()


def to_workers(spark):
    """Add the package as a zip to the session's Python files, once per application; Spark serves it to the executors."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "broadsheet.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)
