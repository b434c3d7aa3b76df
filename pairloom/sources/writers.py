"""Writers: pair files by split, tables, one-row reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import outcome


def _replace(spark: SparkSession, write, path: str) -> None:
    """Have ``write`` fill a folder beside ``path``, then put that in its place: readers never see half a result."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fresh, place, old = fs_path(f"{path}.new-{uuid.uuid4().hex}"), fs_path(path), fs_path(f"{path}.old-{uuid.uuid4().hex}")
    write(fresh.toString())
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(place)
    if had:
        fs.rename(place, old)
    if not fs.rename(fresh, place):
        raise OSError(f"could not put {fresh} in the place of {place}")
    if had:
        fs.delete(old, True)


def write_csv(df: DataFrame, path: str, by: str | None = None, sep: str = ",", order: list[str] | None = None) -> None:
    """A CSV table with header, one folder for each ``by`` value, sorted by ``order`` if given."""
    df = df.orderBy(*order) if order else df
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("sep", sep)
    (writer.partitionBy(by) if by else writer).csv(path)


def write_outcomes(df: DataFrame, path: str, label: str = "label", pred: str = "pred") -> None:
    """One folder of CSV files for each outcome: TP, FP, TN and FN; a null label counts as 0."""
    write_csv(df.withColumn("source", outcome(F.coalesce(F.col(label), F.lit(0)), F.col(pred))), path, by="source")


def write_pairs(df: DataFrame, path: str, label=None, by: str | None = "split") -> None:
    """Lines of text1, text2, label, tab-separated, one folder a split; null sides are empty.

    The folder is replaced as a whole when all is written.
    """
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    line = F.concat_ws("\t", text(F.col("text1")), text(F.col("text2")), text(F.col("label") if label is None else F.lit(label)))
    rows = df.select(line.alias("value"), *([by] if by else []))

    def write(place: str) -> None:
        (rows.write.partitionBy(by) if by else rows.write).text(place)

    _replace(df.sparkSession, write, path)


def report(row: DataFrame) -> str:
    """``key: value`` lines of a one-row table; doubles have six places."""
    values = row.first().asDict()
    return "".join(f"{k}: {v:.6f}\n" if isinstance(v, float) else f"{k}: {v}\n" for k, v in values.items())


def write_report(row: DataFrame, path: str) -> None:
    row.sparkSession.createDataFrame([(report(row).rstrip("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_json(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path)
