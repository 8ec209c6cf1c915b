"""Session settings and the scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_siblings: WeakKeyDictionary = WeakKeyDictionary()
_local_roots: dict[str, str] = {}

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def build_session(app: str = "tripweave", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's defaults; ``settings`` use ``__`` for dots.

    Executor memory, cores and ``spark.sql.shuffle.partitions`` belong to the
    deployment and are left to it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def case_sensitive(spark: SparkSession) -> SparkSession:
    """A sibling session that resolves column names case-sensitively.

    Raw files hold both ``airport_fee`` and ``Airport_fee``. The Parquet reader looks
    the setting up when a job starts, not when the frame is built, so flipping it around
    the read call is not enough: ingest frames live in a session of their own, which
    shares the Spark context but not the setting. There is one per session; settings
    changed in the session since the last call are carried over.
    """
    if spark.conf.get("spark.sql.caseSensitive", "false") == "true":
        return spark
    sibling, known = _siblings.get(spark) or (spark.newSession(), {})
    current = spark.conf.getAll
    for key in current.keys() | known.keys():
        if current.get(key) == known.get(key) or not spark.conf.isModifiable(key):
            continue
        if key in current:
            sibling.conf.set(key, current[key])
        else:
            sibling.conf.unset(key)
    sibling.conf.set("spark.sql.caseSensitive", "true")
    _siblings[spark] = (sibling, current)
    return sibling


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for cut lineage and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is made
    only where that is unset and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    # Core settings cannot be changed at run time, so the folder is remembered here.
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="tripweave-")
    return _local_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the scratch folder and read back: lineage ends here, and it is computed once."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable in this session."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
