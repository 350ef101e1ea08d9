"""Settings of the running session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in spark.checkpoint.dir.

    Only a session in one process, as in tests, that names none gets a temporary one."""
    sc = spark.sparkContext
    given = sc._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="barloom-")
        discard_at_end(spark, folder)
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan over all cores where the table lies in fewer pieces than there are cores, else
    as they lie.  Such a table is small beside the cluster, and so is the exchange."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def discard_at_end(spark: SparkSession, *paths: str) -> None:
    """These folders are deleted when the application ends."""
    sc = spark.sparkContext
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)


def ship_code(spark: SparkSession) -> None:
    """Gives this package to the Python workers of all executors, once per context, so that they need
    neither its folder nor a path to it."""
    sc = spark.sparkContext
    if getattr(sc, "_barloom_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="barloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "barloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(home):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("barloom", os.path.relpath(full, home)))
    sc.addPyFile(path)
    sc._barloom_shipped = True
