"""Cutting lineage: what was computed once isn't computed again by each of its readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def _shared_folder(df: DataFrame) -> str:
    """The shared folder that spark.checkpoint.dir names. Where that is unset, a local master gets a temporary
    folder; a cluster needs the setting, since executors don't share local disks."""
    context = df.sparkSession.sparkContext
    named = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoints-")
        context.setCheckpointDir(named)
    return named


def settled(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    _shared_folder(df)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder as Parquet and read again: for wide rows, of which a checkpoint would take many
    times the space, and of which readers take a few columns."""
    path = f"{_shared_folder(df).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
