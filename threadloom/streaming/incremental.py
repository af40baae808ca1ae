"""Segments kept up to date as messages arrive.

State lies in a folder: tables by bucket of threads, one folder per version,
and a small commit per version that names the current table of each bucket. A
batch rewrites the buckets it touches only, and counts once its commit is
written; a new process goes on from the last commit.

Segments whose last message is older than the thaw window stay frozen: late
messages are cut among the others and do not join them, unless a new message
replies to a member, which thaws the segment. Without freezing the segments
equal those of one pass over all messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import segments
from threadloom.session import materialise, names_in, scratch_path

THAW_HOURS = 24
BUCKETS = 16


class IncrementalSegments:
    """``update`` with batches; ``read`` the segments so far."""

    SCHEMA = "id string, parent string, thread string, ts_us bigint, row_id bigint, segment bigint"

    def __init__(self, spark: SparkSession, path: str | None = None, gap: int = segments.GAP_SECONDS, thaw_hours: int | None = None, buckets: int = BUCKETS) -> None:
        """``thaw_hours`` turns freezing on. ``buckets`` must stay the same for a path."""
        self.spark, self.gap, self.thaw_hours, self.buckets = spark, gap, thaw_hours, buckets
        self.path = path or scratch_path(spark, "segments")

    def _committed(self) -> tuple[int, int, dict[int, int]]:
        """(last version, last epoch, version of each bucket); at most ``buckets`` rows are read."""
        done = [int(n) for n in names_in(self.spark, f"{self.path}/commits") if n.isdigit() and "_SUCCESS" in names_in(self.spark, f"{self.path}/commits/{n}")]
        if not done:
            return -1, -1, {}
        rows = self.spark.read.schema("bucket int, version int, epoch bigint").parquet(f"{self.path}/commits/{max(done)}").collect()
        return max(done), max(r.epoch for r in rows), {r.bucket: r.version for r in rows if r.bucket >= 0}

    def _table(self, versions: dict[int, int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*(f"{self.path}/data/v{v}/bucket={b}" for b, v in sorted(versions.items())))

    def read(self) -> DataFrame:
        return self._table(self._committed()[2])

    def _frozen(self, rows: DataFrame, new: DataFrame) -> DataFrame:
        """(thread, segment) of segments that stay as they are."""
        watermark = self.read().agg(F.max("ts_us")).first()[0]
        spans = rows.groupBy("thread", "segment").agg(F.max("ts_us").alias("last_us"))
        old = spans.where(F.col("last_us") < (watermark or 0) - self.thaw_hours * 3_600_000_000)
        answered = rows.join(new.select(F.col("parent").alias("id")).where("id is not null").distinct(), "id", "left_semi").select("thread", "segment").distinct()
        return old.join(answered, ["thread", "segment"], "left_anti").select("thread", "segment")

    def update(self, batch: DataFrame, epoch: int = -1) -> None:
        """Cuts the threads of the batch anew and commits; the last row of an id wins.

        A frozen row that comes again thaws its segment.
        """
        version, last_epoch, versions = self._committed()
        names = [c.split()[0] for c in self.SCHEMA.split(", ")]
        bucket = F.pmod(F.xxhash64("thread"), F.lit(self.buckets)).cast("int")
        new = materialise(batch.select("id", "parent", "thread", "ts_us", "row_id"), "batch")
        again = self._table(versions).join(new.select("id"), "id", "left_semi").select("thread")
        threads = materialise(new.select("thread").unionByName(again).distinct().withColumn("bucket", bucket), "threads")
        touched = {r.bucket for r in threads.select("bucket").distinct().collect()}
        old = self._table({b: v for b, v in versions.items() if b in touched})
        stay = old.join(threads.select("thread"), "thread", "left_anti")
        open_ = old.join(threads.select("thread"), "thread", "left_semi")
        if self.thaw_hours is not None and versions:
            back = open_.join(new.select("id"), "id", "left_semi").select("thread", "segment").distinct()
            frozen = materialise(self._frozen(open_, new).join(back, ["thread", "segment"], "left_anti"), "frozen")
            stay = stay.select(*names).unionByName(open_.join(frozen, ["thread", "segment"], "left_semi").select(*names))
            open_ = open_.join(frozen, ["thread", "segment"], "left_anti")
            first = frozen.groupBy(F.col("thread").alias("t")).agg((F.max("segment") + 1).alias("first"))
        rows = open_.drop("segment").join(new.select("id"), "id", "left_anti").unionByName(new)
        cut = segments.gap_segments(rows, ["thread"], ["ts_us", "row_id"], F.col("ts_us") / F.lit(1_000_000), self.gap)
        if self.thaw_hours is not None and versions:
            cut = cut.join(first, F.col("thread") == F.col("t"), "left").withColumn("segment", F.col("segment") + F.coalesce("first", F.lit(0)))
        out = stay.select(*names).unionByName(cut.select(*names)).withColumn("bucket", bucket)
        folder = f"{self.path}/data/v{version + 1}"
        out.repartition(len(touched) or 1, "bucket").write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(folder)
        written = {int(n.split("=")[1]) for n in names_in(self.spark, folder) if n.startswith("bucket=")}
        now = {b: v for b, v in versions.items() if b not in touched} | dict.fromkeys(written, version + 1)
        commit = [(b, v, max(epoch, last_epoch)) for b, v in now.items()] or [(-1, -1, max(epoch, last_epoch))]
        self.spark.createDataFrame(commit, "bucket int, version int, epoch bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{version + 1}")

    def write_batch(self, batch: DataFrame, epoch: int) -> None:
        """For ``foreachBatch``; an epoch that was committed is not written again."""
        if epoch > self._committed()[1]:
            self.update(batch, epoch)


def freezable(tasks: DataFrame, watermark_us: int, reopened: DataFrame, thaw_hours: int = THAW_HOURS) -> DataFrame:
    """Tasks that are terminal, last touched before the thaw window, and replied to by nobody new."""
    cutoff = watermark_us - thaw_hours * 3_600_000_000
    return tasks.where(F.col("terminal") & (F.col("last_us") < cutoff)).join(reopened.select("task"), "task", "left_anti")


def unfinished(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed batch still has to do."""
    return work.join(done.select(key).distinct(), key, "left_anti")
