"""Session defaults and the shared checkpoint folder.

The library never relies on these settings for *correct* results (every
operator is written to be time-zone and partition-count independent); they
only shape the physical plan: adaptive execution re-plans joins and
partition counts from real shuffle sizes, skewed join partitions are split,
and broadcast joins are chosen only below a size threshold that Spark checks
against its statistics (static planner) and against the measured shuffle
output (adaptive planner).
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession

# Planner settings used by `get_session`. Thresholds are checked by Spark
# itself: a side is broadcast only when its estimated (or, under AQE,
# measured) size is below the threshold; above it the join stays a
# shuffled sort-merge / hash join.
PLAN_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Streaming state off the JVM heap: per-key state of a large stream
    # (one row per movie) is kept in RocksDB on local disk, checkpointed to
    # the shared checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's planner defaults.

    `master` is only set when given, so the same call works under
    spark-submit on a cluster and in local tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(PLAN_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the one already set on the context, else
    the one that `spark.checkpoint.dir` names, else a sub-folder of the
    session's warehouse (which every executor of the session can reach)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir", f"{warehouse}/checkpoints"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables;
    inside a `scratch_scope` it is removed with the scope."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quarry-{name}-{os.urandom(6).hex()}"
    on_release(lambda: remove_folder(spark, path))
    return path


_RELEASES: ContextVar[list[Callable[[], None]] | None] = ContextVar("quarry_releases", default=None)


def on_release(action: Callable[[], None]) -> None:
    """Run `action` when the innermost `scratch_scope` ends (never without one)."""
    actions = _RELEASES.get()
    if actions is not None:
        actions.append(action)


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Every folder and table that the library writes for itself inside the
    scope is removed when it ends, also after an error, the last one first. The
    DataFrames made inside read them lazily: consume them before the end.

        with scratch_scope():
            seller_ranking(items).write.parquet(target)
    """
    actions: list[Callable[[], None]] = []
    token = _RELEASES.set(actions)
    try:
        yield
    finally:
        _RELEASES.reset(token)
        failed = []
        for action in reversed(actions):
            try:
                action()
            except Exception as e:  # noqa: BLE001 - the other folders go all the same
                failed.append(e)
        if failed:
            raise failed[0]


def ship_package(spark: SparkSession) -> str:
    """Make this package (and `corpus_pipeline.py`, where it lies beside it)
    importable in the Python workers of all executors, for jobs that were not
    submitted with `--py-files`. The archive is written to the shared checkpoint
    folder, where every executor fetches it. Returns its path."""
    root = Path(__file__).resolve().parent
    files = sorted(root.rglob("*.py")) + [p for p in [root.parent / "corpus_pipeline.py"] if p.exists()]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in files:
            archive.write(file, file.relative_to(root.parent))
    path = f"{checkpoint_dir(spark).rstrip('/')}/quarry-package-{os.urandom(6).hex()}.zip"
    fs, where = file_system(spark, path)
    out = fs.create(where)
    out.write(packed.getvalue())
    out.close()
    spark.sparkContext.addPyFile(path)
    return path


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of the path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete the folder if it is there."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)
