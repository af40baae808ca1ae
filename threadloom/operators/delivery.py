"""Exactly one copy of messages that were delivered at least once.

The only shuffle of all rows carries (identifier, delivery order, file key, row
position). Rows that lost to an earlier delivery become deletion vectors, one
bit per row position of a file and only for blocks in which a row lost; the
wide payload is then read once more, in place, and the vector of each file is
applied to it. The payload is never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.ids import identifier
from threadloom.session import BROADCAST_LIMIT, broadcast_if_small, materialise, scratch_path

BLOCK_ROWS = 32768
"""Positions per bitmap of ``bitmap_construct_agg``."""
BUCKET_BYTES = 16 << 20
"""Bytes of vectors in one folder, where tasks load those of their own files."""
_KEY, _POS, _BLOCK, _BITS, _ID = "__file", "__pos", "__block", "__bits", "__id"


def _located(df: DataFrame) -> DataFrame:
    """Adds the file key and the row's position in its file."""
    return df.withColumns(
        {
            _KEY: F.xxhash64(F.col("_metadata.file_path")),
            _POS: F.col("_metadata.row_index"),
        }
    )


def _bit(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(number, position.bitwiseAND(7).cast("int")) == 1


def lost_rows(source: DataFrame, id_col: str = "msg_id", order_col: str = "row_id", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """(file key, position) of each row that is not the first of its identifier.

    ``source`` must be read from files. The row with the smallest
    (``order_col``, file key, position) wins, so ties and wholly repeated rows
    still leave one. First, last and number of the rows of an identifier
    combine on the map side, so a hot one is reduced before the shuffle. Of two
    rows the last lost. Only identifiers with more rows are looked up again, by
    a broadcast while they take at most ``limit`` bytes, else by a join in
    which adaptive execution splits hot ones. File keys are 64-bit hashes of
    paths.
    """
    at = F.struct("__order", _KEY, _POS)
    narrow = _located(source.select(identifier(F.col(id_col)).alias(_ID), F.col(order_col).alias("__order"), "_metadata")).drop("_metadata").where(F.col(_ID).isNotNull())
    ends = narrow.groupBy(_ID).agg(F.min(at).alias("won"), F.max(at).alias("last"), F.count("*").alias("n"))
    ends = materialise(ends.where("n > 1").select(_ID, f"won.{_KEY}", f"won.{_POS}", F.col(f"last.{_KEY}").alias("last_file"), F.col(f"last.{_POS}").alias("last_pos"), "n"), "repeats")
    twice = ends.where("n = 2").select(F.col("last_file").alias(_KEY), F.col("last_pos").alias(_POS))
    often = ends.where("n > 2").select(F.col(_ID).alias("often"), F.col(_KEY).alias("won_file"), F.col(_POS).alias("won_pos"))
    size = often.agg(F.sum(F.octet_length("often") + 64)).first()[0]
    if size is None:
        return twice
    rest = narrow.join(broadcast_if_small(often, size, limit), F.col(_ID) == F.col("often"))
    return twice.unionByName(rest.where((F.col(_KEY) != F.col("won_file")) | (F.col(_POS) != F.col("won_pos"))).select(_KEY, _POS))


def deletion_vectors(lost: DataFrame) -> DataFrame:
    """Per file and block of 32,768 positions with lost rows, a bitmap of them.

    Positions go to their block before they are combined, so no task holds a
    part of every bitmap.
    """
    at = F.col(_POS) + 1
    placed = lost.select(_KEY, F.bitmap_bucket_number(at).alias(_BLOCK), F.bitmap_bit_position(at).alias("__at"))
    return placed.repartition(_KEY, _BLOCK).groupBy(_KEY, _BLOCK).agg(F.bitmap_construct_agg("__at").alias(_BITS))


def _broadcast_vectors(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    at = F.col(_POS) + 1
    joined = rows.withColumn(_BLOCK, F.bitmap_bucket_number(at)).join(F.broadcast(vectors), [_KEY, _BLOCK], "left")
    return joined.withColumn("__lost", F.coalesce(_bit(F.col(_BITS), F.bitmap_bit_position(at)), F.lit(False)))


class _Vectors:
    """The deletion vectors of the files that a task reads, loaded from the shared folder."""

    def __init__(self, folder: str, buckets: int) -> None:
        self.folder, self.buckets = folder, buckets
        self.held: dict[int, dict[int, np.ndarray]] = {}

    def of_file(self, key: int) -> dict[int, np.ndarray]:
        from pyarrow import dataset, fs

        system, base = fs.FileSystem.from_uri(self.folder)
        place = f"{base}/bucket={key % self.buckets}"
        if system.get_file_info(place).type == fs.FileType.NotFound:
            return {}
        found = dataset.dataset(place, filesystem=system, format="parquet").to_table(columns=[_BLOCK, _BITS], filter=dataset.field(_KEY) == key)
        return {b: np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little") for b, x in zip(found[_BLOCK].to_pylist(), found[_BITS].to_pylist(), strict=True)}

    def lost(self, keys: np.ndarray, positions: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        wanted = np.unique(keys).tolist()
        self.held = {k: self.held[k] if k in self.held else self.of_file(k) for k in wanted}
        for key in wanted:
            mine = np.flatnonzero(keys == key)
            blocks = positions[mine] // BLOCK_ROWS + 1
            for block in np.unique(blocks).tolist():
                bits = self.held[key].get(block)
                if bits is not None:
                    some = mine[blocks == block]
                    out[some] = bits[positions[some] % BLOCK_ROWS]
        return out


def _loaded_vectors(rows: DataFrame, folder: str, buckets: int) -> DataFrame:
    @F.pandas_udf("boolean")
    def lost(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        vectors = _Vectors(folder, buckets)
        for keys, positions in batches:
            yield pd.Series(vectors.lost(keys.to_numpy(), positions.to_numpy()))

    return rows.withColumn("__lost", lost(_KEY, _POS))


def mark_deliveries(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    id_col: str = "msg_id",
    order_col: str = "row_id",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Rows of ``path`` with ``__keep`` and ``__has_id``.

    While all vectors fit in ``limit`` bytes they are broadcast. Else each task
    loads those of the files it reads from the shared folder, and sends file
    keys and positions, not the payload, to the loader.
    """
    source = spark.read.parquet(path)
    vectors = materialise(deletion_vectors(lost_rows(source, id_col, order_col, limit)), "vectors")
    wanted = source.select("*", "_metadata") if columns is None else source.select(*dict.fromkeys([*columns, id_col]), "_metadata")
    rows = _located(wanted).drop("_metadata")
    size = vectors.agg(F.sum(F.octet_length(_BITS) + 16).alias("n")).first()["n"] or 0
    if size <= limit:
        marked = _broadcast_vectors(rows, vectors)
    else:
        buckets = -(-size // min(BUCKET_BYTES, limit))
        folder = scratch_path(spark, "by-file")
        placed = vectors.withColumn("bucket", F.pmod(F.col(_KEY), F.lit(buckets)))
        placed.repartition("bucket").sortWithinPartitions("bucket", _KEY).write.partitionBy("bucket").option("compression", "zstd").parquet(folder)
        marked = _loaded_vectors(rows, folder, buckets)
    has_id = identifier(F.col(id_col)).isNotNull()
    return marked.withColumns({"__keep": ~F.col("__lost"), "__has_id": has_id}).drop(_KEY, _BLOCK, _POS, _BITS, "__lost")


def keep_first_delivery(spark: SparkSession, path: str, id_col: str = "msg_id", order_col: str = "row_id", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Whole rows, one per identifier; rows without identifier all remain."""
    return mark_deliveries(spark, path, None, id_col, order_col, limit).where("__keep").drop("__keep", "__has_id")


def repeated_deliveries(spark: SparkSession, path: str, id_col: str = "msg_id", order_col: str = "row_id", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``order_col`` of each row that is not the first of its identifier.

    Null or blank identifiers are none, an empty table gives no rows, a null
    order sorts first, and rows equal in every column leave one survivor.
    """
    marked = mark_deliveries(spark, path, [order_col], id_col, order_col, limit)
    return marked.where("not __keep").select(order_col)
