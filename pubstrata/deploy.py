"""Ship the package to the Python workers (``SparkContext.addPyFile``).

Pandas UDFs and ``mapInPandas`` functions refer to helpers in this package, so
every executor's Python worker must be able to import it. The package is
zipped once per SparkContext into the shared folder and added as a Python file;
Spark distributes it to the executors.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile

_PKG_DIR = os.path.dirname(os.path.abspath(__file__))


def _zip_bytes() -> bytes:
    buf = io.BytesIO()
    root = os.path.dirname(_PKG_DIR)
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, filenames in os.walk(_PKG_DIR):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for f in filenames:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    return buf.getvalue()


def ship_package(spark) -> None:
    sc = spark.sparkContext
    if getattr(sc, "_pubstrata_shipped", False):
        return
    from pubstrata.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/pyfiles/pubstrata-{uuid.uuid4().hex[:12]}.zip"
    jvm = sc._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(hp, True)
    out.write(bytearray(_zip_bytes()))
    out.close()
    sc.addPyFile(path)
    sc._pubstrata_shipped = True
