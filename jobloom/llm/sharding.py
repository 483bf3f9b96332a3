"""Contiguous shards of equal bytes, from global prefix sums of byte sizes (DataFrame functions only).

Rows are range-partitioned in the order (doc_id, crc32, size); each partition's total gives the
number of bytes before it, a running sum inside the partition gives the bytes before each row, and
the shard is where the row's middle byte falls among n equal targets. So shards are contiguous in
that order, and any cut is off its target by half a document at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm._common import cut, text_rows


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 length plus 1, so a null or an empty text has size 1 and crc32 0. Null ids
    come first in the order; rows that are equal in all of (doc_id, crc32, size) may be placed in
    either order. An empty table gives no rows. grown_shard is always null: this law has no key.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 or more")
    sized = text_rows(docs, id_col, text_col).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    # Which rows share a partition must not change between the totals and the running sums, even
    # if an executor is lost between them: the few bytes kept of each row are checkpointed.
    parted = cut(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))

    totals = parted.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        parted.withColumn("run", F.sum("size").over(inside))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(starts), "part")  # as many rows as there are partitions
        .withColumn("middle", 2 * (F.col("bytes_before") + F.col("run")) - F.col("size"))
        .withColumn("shard", F.expr(f"cast(least({n_shards} - 1, middle * {n_shards} div (2 * all_bytes)) as int)"))
        .withColumn("row_index", F.col("rows_before") + F.col("nth") - 1)
    )
    firsts = placed.groupBy("shard").agg(F.min("row_index").alias("first_row"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row_index") - F.col("first_row")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
