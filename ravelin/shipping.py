"""The package on the executors: Spark's own file server hands it to them as a zip.

Nothing is set in the session and no path of the driver is assumed to exist elsewhere.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers of this application import the package; call it before a function is made for them.

    A package that was itself loaded from an archive is one that the executors were given already.
    """
    context = spark.sparkContext
    if not os.path.isdir(PACKAGE) or any(a == context.applicationId for a, _ in _shipped):
        return
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(PACKAGE) for f in names if f.endswith(".py"))
    held = {os.path.relpath(f, os.path.dirname(PACKAGE)): open(f, "rb").read() for f in files}
    digest = hashlib.sha256(b"\0".join(k.encode() + b"\0" + v for k, v in held.items())).hexdigest()[:16]
    path = os.path.join(tempfile.mkdtemp(prefix="ravelin-"), f"ravelin-{digest}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, raw in held.items():
            z.writestr(name, raw)
    context.addPyFile(path)
    _shipped.add((context.applicationId, digest))
