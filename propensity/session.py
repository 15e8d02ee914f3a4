"""Session settings and the shared folder in which intermediate frames are kept."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every operator relies on (UTC times, ANSI errors, adaptive plans)."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession) -> None:
    """Batches for Python functions hold some ``BATCH_BYTES`` at most, or one row: 10,000 long texts would be copied several times in an executor's memory.

    A smaller number of bytes that the session sets stays.
    """
    now = spark.conf.get(BATCH_SETTING).lower().removesuffix("b")
    if not (now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="propensity-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Later jobs then see one fixed version of it (same slices, same order numbers), survive the loss of
    executors without recomputing the lineage, and still read only the columns they use.
    """
    path = f"{frames_path(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[frame] = path
    return frame


def release(*frames: DataFrame) -> None:
    """Delete frames that :func:`materialize` returned, once all that is read from them has been written; other frames are left alone."""
    for frame in frames:
        if path := _paths.pop(frame, None):
            _delete(frame.sparkSession, path)


def frames_path(spark: SparkSession) -> str:
    """Each application has a folder of its own, so none deletes what another one still reads."""
    return f"{shared_dir(spark)}/frames/{spark.sparkContext.applicationId}"


def drop_frames(spark: SparkSession) -> None:
    """Delete this application's intermediate frames. Frames returned by earlier calls cannot be read afterwards."""
    _delete(spark, frames_path(spark))


def _delete(spark: SparkSession | SparkContext, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def delete_path(sc: SparkContext, path: str | None) -> None:
    """Delete a folder that the application wrote, such as an older checkpoint; nothing for None."""
    if path:
        _delete(sc, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: unlike :func:`materialize` it keeps partitions and the order inside them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
