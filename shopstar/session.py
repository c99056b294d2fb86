"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder every lineage cut goes to."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on. AQE turns joins whose measured side fits
# the broadcast threshold into broadcast joins at run time (the size check
# behind every join we leave unhinted) and splits skewed shuffle partitions.
SESSION_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Spark's defaults and what the warehouse's tables need instead: their rows are
# narrow and compress well, so a task of the default size holds millions of rows
# and sorts and hash tables of a few such tasks spill.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "8m"),
              "spark.sql.files.maxPartitionBytes": ("134217728b", "32m")}
INPUT_BYTES_PER_PARTITION = 4 << 20
#: A job's shuffle files go when it is done, not when the driver happens to collect its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of shuffle partitions follow the input's size on disk and
    bound what a task reads. Adaptive execution merges partitions that turn out
    small. A session's own task sizes and larger numbers stay as they are.
    Shuffle files are deleted with their job: the tables in between are written."""
    for key, (default, ours) in TASK_BYTES.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, ours)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // INPUT_BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shopstar", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench: local[cores], UI off, UTC, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SHOPSTAR_DRIVER_MEMORY", "16g"))
    )
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is. Only a
    local master without it (tests) gets a fresh scratch folder; elsewhere a
    folder of this machine would be lost on the executors, so it is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="shopstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    now = spark.sparkContext.getCheckpointDir()  # a folder of its own in ``current``, made by each call that sets it
    if not now or os.path.dirname(_plain(now)) != _plain(current) != _plain(now):
        spark.sparkContext.setCheckpointDir(current)
    return current


def _plain(path: str) -> str:
    return re.sub("^file:/+", "/", path).rstrip("/")


#: Scratch folders of the open scopes, the innermost last; None: what is written is kept.
_SCOPES: list[list[str] | None] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, under the shared
    checkpoint folder the session names (never a machine-local path on a
    cluster). An open :func:`scratch_scope` deletes it at its end."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES and _SCOPES[-1] is not None:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def kept_scratch() -> Iterator[None]:
    """What is written inside outlives an open scope: tables that a session
    keeps may be built by a question that is asked in one."""
    _SCOPES.append(None)
    try:
        yield
    finally:
        _SCOPES.pop()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the intermediate tables written inside. Results that
    read them must have been used by then; scopes are opened by one thread at a
    time, the jobs inside may run on several."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _SCOPES.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)
