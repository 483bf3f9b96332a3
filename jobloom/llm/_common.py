"""What the operators of this subpackage share: scratch space and cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Where it is unset (tests on a local master) a temporary folder is taken; a cluster without
    the setting is an error, since a machine-local folder would not be seen by all executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="spark-checkpoints-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder: what follows doesn't depend on lost executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write as Parquet in the shared folder and read again: columnar, so later reads prune."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the id and the text, under names of our own, so that other columns can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column without a detour by Python strings."""
    return column.cast(pa.large_binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text_at: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about limit bytes of text (a longer text alone), for bounded memory."""
    for batch in batches:
        sizes = [0 if v is None else v for v in pa.compute.binary_length(batch.column(text_at)).to_pylist()]
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
