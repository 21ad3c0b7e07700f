"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; a cluster's own values win where it sets them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "hardwood", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Limits of what one task or one broadcast may hold; ``spark.<name>`` overrides them.
LIMITS = {
    "hardwood.blockRows": 1_000_000,
    "hardwood.broadcastRows": 1_000_000,
    "hardwood.broadcastBytes": 256 * 1024 * 1024,
}


def limit(spark: SparkSession, name: str, given: int | None = None) -> int:
    return given if given is not None else int(spark.conf.get(f"spark.{name}", str(LIMITS[name])))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting: there one machine is the whole
    cluster, so a temporary folder is shared by definition.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="hardwood-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Paths handed out and not removed yet, in order.
_handed_out: list[str] = []


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application for easy removal."""
    app = spark.sparkContext.applicationId
    _handed_out.append(f"{shared_folder(spark)}/hardwood/{app}/{label}-{uuid.uuid4().hex}")
    return _handed_out[-1]


def remove_path(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_work(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once nothing reads them any more."""
    remove_path(spark, f"{shared_folder(spark)}/hardwood/{spark.sparkContext.applicationId}")
    _handed_out.clear()


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end.

    Results are lazy: write them inside, to a path that was made outside.
    """
    before = len(_handed_out)
    try:
        yield
    finally:
        for folder in _handed_out[before:]:
            remove_path(spark, folder)
        del _handed_out[before:]


@contextmanager
def _held(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """These settings hold inside; at the end each is what it was."""
    earlier = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in earlier.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def open_writers(spark: SparkSession, files: int):
    """Partitioned writes inside keep up to ``files`` files a task open instead of sorting their rows."""
    return _held(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(files)})


def small_disk(spark: SparkSession):
    """Writes inside leave no shuffle files behind, and their Parquet is packed by zstd.

    Shuffle files otherwise stay until the driver collects its garbage, which may be after the job.
    """
    return _held(
        spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    )


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The result survives the loss of executors and fixes values that a recomputation
    could change (partition-dependent ids). Columnar, so later readers still prune.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
