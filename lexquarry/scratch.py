"""Cutting lineage through the folder that driver and executors share.

Intermediate results that are read more than once are written as Parquet under
``spark.checkpoint.dir`` and read back, so that a lost executor costs a re-read
and not a re-computation.  Where the setting is absent, a session on one machine
(tests, notebooks) gets a folder of that machine; on a cluster it is an error, as
every executor would write to a disk of its own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Bytes of an Arrow batch on its way to a Python worker; rows alone (10,000) bound no memory where texts are long.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_local: dict[str, str] = {}
_written: dict[str, SparkSession] = {}
_path_of: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_named: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, with no trailing slash."""
    found = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if not found:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share (master is {master})")
        app = spark.sparkContext.applicationId
        found = _local.setdefault(app, "file://" + tempfile.mkdtemp(prefix="lexquarry-"))
    return found.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, Arrow batches hold BATCH_BYTES or so (one row at least)."""
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def new_path(spark: SparkSession, label: str = "step") -> str:
    """A path in the shared folder that nothing uses yet; :func:`clear` deletes what is written there."""
    path = f"{shared_dir(spark)}/lexquarry-{label}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def save(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _path_of[out] = path
    return out


def save_bucketed(df: DataFrame, keys: list[str], buckets: int | None = None, label: str = "bucketed") -> DataFrame:
    """As :func:`save`, as a table whose rows lie in buckets of ``keys``, sorted by them: joins and groups by all ``keys`` shuffle it no more.

    There are as many buckets as the session has shuffle partitions, so that what is shuffled to meet them fits too.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with small_batches(spark):
        df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    _named[path] = name
    out = spark.table(name)
    _path_of[out] = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables of :func:`save` and :func:`save_bucketed` that nothing will read again; others are left alone."""
    for df in tables:
        path = _path_of.pop(df, None)
        if path:
            _delete(path)


def clear() -> None:
    """Delete every table that this module has written in this process."""
    for path in list(_written):
        _delete(path)


def _delete(path: str) -> None:
    spark, name = _written.pop(path, None), _named.pop(path, None)
    try:
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended; the folder goes with the application
        return


atexit.register(clear)
