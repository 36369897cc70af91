"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}

MB_128 = 128 << 20
# Defaults of the session settings below. Raise the partitions where 100 TB are shuffled at once: 50,000 of them hold 2 GB each.
MAX_SCAN_TASKS = 200_000
MAX_SHUFFLE_PARTITIONS = 50_000
SCAN_TASKS_SETTING = "spark.cityloom.maxScanTasks"
SHUFFLE_PARTITIONS_SETTING = "spark.cityloom.maxShufflePartitions"


def build_session(app_name: str = "cityloom", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the project settings; ``settings`` are added last and win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path as that file system's object."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file on any file system Spark reaches."""
    files, target = hadoop_path(spark, path)
    stream = files.create(target, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small text file, also of one whose name readers skip."""
    files, target = hadoop_path(spark, path)
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Give a file a name that no file has; where it is taken, the file system's error for that is raised."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(jvm.org.apache.hadoop.fs.Path(source), path, options)


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers find this package at the driver's place, if it is not installed or sent along with ``--py-files``."""
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def _scratch_root(spark: SparkSession) -> str:
    """This application's folder under the checkpoint folder of the cluster.

    Only a local session without a checkpoint folder gets one of its own.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cityloom-"))
        shared = context.getCheckpointDir()
    return f"{shared.rstrip('/')}/cityloom-{context.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for intermediate files, on storage all executors reach."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate files of this application, once its results are written."""
    files, root = hadoop_path(spark, _scratch_root(spark))
    files.delete(root, True)


@contextmanager
def sized_for(spark: SparkSession, *paths: str, piece: int | None = None) -> Iterator[dict[str, int]]:
    """Within the block, cut scans and shuffles by the size of the input folders.

    Adaptive execution merges shuffle partitions that turn out small but never starts with more than
    configured, so their number has to grow with the data. Scans of very large inputs take larger pieces,
    to keep the number of tasks in bounds. Only file sizes are looked up. A smaller ``piece`` is for work
    that holds many times the bytes it reads.
    """
    piece = MB_128 if piece is None else piece
    folders = [hadoop_path(spark, path) for path in paths]
    total = sum(files.getContentSummary(folder).getLength() for files, folder in folders)
    most_scans = int(spark.conf.get(SCAN_TASKS_SETTING, str(MAX_SCAN_TASKS)))
    most_shuffles = int(spark.conf.get(SHUFFLE_PARTITIONS_SETTING, str(MAX_SHUFFLE_PARTITIONS)))
    scan = min(max(piece, total // most_scans), 8 * MB_128)
    shuffles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // piece)
    sizes = {
        "spark.sql.files.maxPartitionBytes": scan,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": min(shuffles, most_shuffles),
        # Pieces of a shuffle, and with them the files of a written table.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": min(scan, 2 * piece),
    }
    before = {key: spark.conf.get(key, None) for key in sizes}
    for key, size in sizes.items():
        spark.conf.set(key, str(size))
    try:
        yield sizes
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where several actions need one expensive result. Unlike a cache, the files
    survive lost executors, and later reads prune columns.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
