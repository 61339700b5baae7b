"""Session settings the library relies on, and durable staging of results."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Skewed joins are left to adaptive execution: every join in this package has
# at most one side whose key repeats, so the repeated side can always be split.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on an existing session."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


_STAGED: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A session that names none is refused.  Falling back to a folder of the
    driver's machine would let executors write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        set_in_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_in_context.isEmpty():
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = set_in_context.get()
    return named.rstrip("/")


def use_local_folder(spark: SparkSession) -> SparkSession:
    """For entry points in local mode: a temporary shared folder, if none is named.

    One machine runs everything there.  The folder goes with the process.
    """
    if (
        spark.conf.get("spark.checkpoint.dir", None) is None
        and spark.sparkContext.master.startswith("local[")
        and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()
    ):
        folder = tempfile.mkdtemp(prefix="callsift-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from there.

    Parquet keeps column pruning for what reads it; the plan starts anew, and
    a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = shared_path(spark, "stage")
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def unstage(df: DataFrame) -> None:
    """Delete one staged table.  Nothing may read it any more."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, path)


def staged(spark: SparkSession) -> list[str]:
    """Folders of the tables that this application has staged."""
    return list(_STAGED.get(spark.sparkContext.applicationId, []))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that no plan needs any more.

    It does so when the driver collects its garbage, which a driver with little
    to do puts off; for jobs of many rounds, after each.
    """
    gc.collect()
    spark._jvm.System.gc()


def settle(df: DataFrame, before: Iterable[str]) -> DataFrame:
    """``stage``, then let go of the way to it: what was staged since ``before`` (of ``staged``), and shuffle files."""
    spark, kept = df.sparkSession, set(before)
    way = [path for path in staged(spark) if path not in kept]
    found = stage(df)
    for path in way:
        delete_path(spark, path)
        _STAGED[spark.sparkContext.applicationId].remove(path)
    release_shuffles(spark)
    return found


def drop_stages(spark: SparkSession) -> None:
    """Delete all staged tables of this application, once its results are stored."""
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)


@contextmanager
def stages_of_its_own(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, what is staged within: for jobs whose results are stored elsewhere by then."""
    before = set(staged(spark))
    try:
        yield
    finally:
        kept = [path for path in staged(spark) if path in before]
        for path in staged(spark):
            if path not in before:
                delete_path(spark, path)
        _STAGED[spark.sparkContext.applicationId] = kept
