"""Session helpers: the shared folder for intermediate data, tuned defaults."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the operators were planned against. All are ordinary Spark options;
# a cluster may override any of them.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


# Of steps whose tasks hold groups in memory: much more partitions than a session may have set,
# merged by adaptive execution to a few MB each, so that a task's memory does not grow with the input.
SMALL_TASKS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
MOST_PARTITIONS = 1_000

# Shuffle files otherwise stay until the driver happens to collect the plans that made them. A task that
# needs them again has them made again.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(master: str | None = None, app_name: str = "clickloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session.

    The cluster sets ``spark.checkpoint.dir``. Where it is unset, a local
    folder is made for a local master only: on a cluster every executor would
    write to its own disk, so that case raises.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not is_local(sc.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="clickloom-")
    sc.setCheckpointDir(fresh)
    return sc.getCheckpointDir() or fresh


def is_local(master: str) -> bool:
    """Driver and executor are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write to a new table in the shared folder and go on from there.

    The table outlives any executor. It is columnar, so later steps read only
    the columns they need. Tables stay in the shared folder, whose owner
    expires them, unless :func:`discard` or :func:`own_stages` takes one away. What was shuffled to
    make the table is deleted once it is written.
    """
    spark = df.sparkSession
    path = folder or fresh_folder(spark, "stage")
    if (scope := _SCOPE.get()) is not None:
        scope.folders.append(path)
    with _set(spark, DROP_SHUFFLES):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class StageScope:
    """Stage tables made inside an :func:`own_stages` block, and the frames that are still to be read."""

    def __init__(self):
        self.folders: list[str] = []
        self.results: list[DataFrame] = []

    def keep(self, *frames: DataFrame) -> None:
        self.results += frames


_SCOPE: ContextVar[StageScope | None] = ContextVar("clickloom_stages", default=None)


@contextmanager
def own_stages(spark: SparkSession) -> Iterator[StageScope]:
    """Stage tables that are made inside are deleted at the end, but those that a kept frame reads.

    Frames made inside must be kept to be of use behind it, those that are read whole inside need not.
    Blocks may lie in each other; an inner one leaves what it keeps to the outer one. After an error all tables stay.
    """
    scope, outer = StageScope(), _SCOPE.get()
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
    files = [f for frame in scope.results for f in frame.inputFiles()]
    # A file may be named with a scheme that the folder was given without; the last part of a folder is unique.
    read = {part for f in files for part in f.split("/")}
    left = [folder for folder in scope.folders if folder.rstrip("/").rsplit("/", 1)[-1] in read]
    for folder in scope.folders:
        if folder not in left:
            discard(spark, folder)
    if outer is not None:
        outer.folders += left


@contextmanager
def _set(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Options that hold inside, and only there."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside are made by small tasks, whatever the session's partition count.

    Only plans that run inside are affected, so a step has to be stored there. Without adaptive
    execution, which merges partitions that are too small, the session's count stays.
    """
    wanted = dict(SMALL_TASKS)
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        count = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted["spark.sql.shuffle.partitions"] = str(max(count, MOST_PARTITIONS))
    with _set(spark, wanted):
        yield


def store_in_small_tasks(df: DataFrame) -> DataFrame:
    """:func:`cut_lineage`, in small tasks."""
    with small_tasks(df.sparkSession):
        return cut_lineage(df)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a stage table that no later plan reads."""
    root = checkpoint_root(spark).rstrip("/")
    if not folder.startswith(f"{root}/"):
        raise ValueError(f"{folder} is not below {root}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
