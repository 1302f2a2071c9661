"""Session helpers: a tuned local/test session, the shared scratch folder, table loading."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every plan in this package.  On a cluster the
# platform's own values win: these are only applied when building a session.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of RDDs that are no longer referenced are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "batchkit", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with :data:`DEFAULT_CONF`."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be shared storage, so it is read from the session.
    Only when it is unset on a ``local[...]`` master (tests, a laptop) do we pick
    a folder ourselves; elsewhere an unset value is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except PySparkException:  # Spark Connect has no SparkContext
        sc = None
    if sc is not None:
        base = base or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage; "
                               "a machine-local folder is not visible to every executor")
        base = tempfile.mkdtemp(prefix="batchkit-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


# What a session has put into the shared folder: paths and databases, until dropped.
_SCRATCH: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder; :func:`drop_scratch` removes it."""
    path = f"{checkpoint_base(spark)}/batchkit/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark, {"paths": [], "databases": []})["paths"].append(path)
    return path


def scratch_database(spark: SparkSession) -> str:
    """A database of its own for one run's tables, in a shared folder; :func:`drop_scratch` drops it."""
    name = f"batchkit_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, 'warehouse')}'")
    _SCRATCH[spark]["databases"].append(name)
    return name


def drop_scratch(spark: SparkSession) -> int:
    """Remove every scratch folder and database of this session; returns how many.

    Results that read them are unusable afterwards, so call it once a query's result
    has been written or read.
    """
    held = _SCRATCH.pop(spark, {"paths": [], "databases": []})
    for name in held["databases"]:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    for path in held["paths"]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(held["paths"])


def _stamp(spark: SparkSession, path: str) -> tuple | None:
    """Names, sizes and modification times of the files at ``path``; None without a JVM to ask."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found)


# Per-session memo of table definitions; entries go away with their session.
_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``) as a lazy DataFrame.

    The definition (file listing and footer schema, ~70 ms per call here) is kept per
    session for as long as the files' names, sizes and times are the same; no data
    is cached.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    stamp = _stamp(spark, path)
    if stamp is None:
        return spark.read.parquet(path)
    defined = _TABLES.setdefault(spark, {})
    if path not in defined or defined[path][0] != stamp:
        defined[path] = (stamp, spark.read.parquet(path))
    return defined[path][1]
