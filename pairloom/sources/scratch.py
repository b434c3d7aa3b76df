"""Scratch tables in the folder that driver and executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder; on a cluster, whose executors would not see
    one, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="pairloom-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", base)
    _made.append(f"{base.rstrip('/')}/pairloom-{uuid.uuid4().hex}")
    return _made[-1]


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to a scratch folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """The scratch folders made so far, for ``remove``."""
    return len(_made)


def remove(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete the scratch folders made after ``since`` but those that ``keep`` reads; results over the others are lost.

    Operators return lazy results over scratch tables, so only a caller knows when these are done with.
    """
    read = keep.inputFiles() if keep is not None else []
    for path in [p for p in _made[since:] if not any(p.rsplit("/", 1)[1] in f for f in read)]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _made.remove(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()``, stored; the scratch tables and shuffle files that only its making needed go at once.

    Shuffle files go when the driver has collected the plans that wrote them, so that is asked for here; else they stay
    for the rest of a query. The scheduler holds the plan of the last job until the next, so a small one comes before.
    """
    since = mark()
    out = materialise(make())
    remove(spark, since, keep=out)
    gc.collect()
    spark.range(1).collect()
    spark._jvm.System.gc()
    return out
