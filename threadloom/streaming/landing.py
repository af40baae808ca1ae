"""Files that arrive over time, as streams that end when all are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def parquet_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def drain(stream: DataFrame, write_batch, checkpoint: str) -> None:
    """Runs a stream over all that is there and was not read under ``checkpoint`` before.

    The checkpoint is a folder that all executors share. After a failure the
    last batch comes again with its number, so ``write_batch`` must know it.
    """
    query = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def land(stream: DataFrame, path: str, checkpoint: str | None = None) -> None:
    """Appends a stream to a table of files, each input file once, over any number of calls.

    What was read stands in ``checkpoint``, beside the table unless given.
    """
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint or f"{path.rstrip('/')}-checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def tail(log: DataFrame, after_id: int, id_col: str = "id") -> DataFrame:
    """Rows that came after the last one seen."""
    return log.where(F.col(id_col) > after_id)


def newest(log: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The newest ``n`` rows, oldest first: a top-k report."""
    return log.orderBy(F.col(id_col).desc()).limit(n).orderBy(id_col)


def newest_files(files: DataFrame, k: int) -> DataFrame:
    """The ``k`` files written last, by time and then path: a top-k report."""
    return files.orderBy(F.col("mtime").desc(), F.col("path").desc()).limit(k)


def accepted(batch: DataFrame, capacity: int, order: str) -> DataFrame:
    """What a bounded queue takes of a batch: the oldest ``capacity`` rows; the newest are dropped when it is full."""
    return batch.orderBy(order).limit(capacity)


def name_index(entries: DataFrame) -> DataFrame:
    """The latest entry of each id; a removal or a blank as the latest takes it out."""
    last = entries.groupBy("id").agg(F.max(F.struct("pos", "name", "removed")).alias("e"))
    return last.where("not e.removed and trim(e.name) <> ''").select("id", "e.name", "e.pos")


def by_name(index: DataFrame, name: str) -> DataFrame:
    """Ids whose latest name is ``name``, newest first."""
    return index.where(F.col("name") == name).orderBy(F.col("pos").desc())
