"""Session settings every operator here relies on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from weirflow.specs import SpecError

# Settings that change results, not speed: all of them are runtime-settable.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # A later key replaces an earlier one, in maps and in parsed JSON objects.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keyed state of streams (transformWithState) needs this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Measured: generated methods above 8000 bytes of code are never compiled by the JVM.
# Wide checking and typing projections run faster when Spark cuts them up instead. These
# settings concern speed only, so a session gets them when it asks for them.
_SPEED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def ship_package(spark: SparkSession) -> None:
    """Give this package to the workers, once for each application.

    Functions that run there are found by module name, wherever the job was started.
    """
    context = spark.sparkContext
    if getattr(context, "_weirflow_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="weirflow-package-")) / "weirflow-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._weirflow_shipped = True


def configure(spark: SparkSession, speed: bool = False) -> SparkSession:
    """Apply the settings the operators need to an existing session, and ship the package.

    ``speed`` also sets what only makes wide projections faster, for the whole session.
    """
    ship_package(spark)
    for key, value in (_REQUIRED | (_SPEED if speed else {})).items():
        spark.conf.set(key, value)
    return spark


def new_session(master: str = "local[*]", app: str = "weirflow", **conf: str) -> SparkSession:
    """A session for tests and local runs; a cluster job passes its own to configure()."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate(), speed=True)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for streaming checkpoints and stored intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. On a local master a temporary folder
    will do; elsewhere driver and executors would each see their own, so it must be set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("weirflow.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise SpecError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="weirflow-ckpt-")
        spark.conf.set("weirflow.checkpoint.dir", root)
    return root
