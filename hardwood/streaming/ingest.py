"""Pages that land as files are taken in once, whatever their file time.

The stream's checkpoint remembers files, and the keys of the pages taken in: keyed state in RocksDB, looked up and
changed for the keys of a micro-batch only, so a batch costs its own size however many pages were taken in before.
Each micro-batch writes the new pages to a folder named by the batch; a batch that is repeated after a failure starts
from the state before it and replaces its folder. Pages without a key cannot be told apart and all stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
_BATCHED = T.StructType([*PAGES.fields, T.StructField("batch", T.LongType())])

# Only what a batch changes is written to the checkpoint.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB."""
    earlier = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in earlier.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def page_stream(spark: SparkSession, landing: str, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Landed pages. The age of a file never rules it out."""
    reader = spark.readStream.schema(PAGES).option("pathGlobFilter", glob).option("maxFileAge", "36500d")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing)


def once_per_key(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """The first row of each key that the stream meets, and all rows without a key."""
    place = F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    told = pages.withColumns({"_keyless": F.when(F.col(key).isNull(), place)})
    return told.dropDuplicates([key, "_keyless"]).drop("_keyless")


def _taken(spark: SparkSession, target: str) -> DataFrame:
    """Pages taken in so far, with their ``batch``."""
    try:
        return spark.read.schema(_BATCHED).parquet(target)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _BATCHED)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def ingest_pages(
    spark: SparkSession, landing: str, target: str, checkpoint: str, glob: str = "*.parquet", key: str = "page_id",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Take in everything that is new, stop, and return the target table.

    The checkpoint and the target belong together: a target with pages and a new checkpoint are refused, as the
    stream could not know what was taken in.
    """
    if not _exists(spark, checkpoint) and _exists(spark, target):
        raise ValueError(f"{target} holds pages, but {checkpoint} does not know them")

    def take(batch: DataFrame, number: int) -> None:
        batch.select(*PAGES.fieldNames()).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    with keyed_state(spark):
        query = (
            once_per_key(page_stream(spark, landing, glob, files_per_batch), key)
            .writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return _taken(spark, target).drop("batch")
