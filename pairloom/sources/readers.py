"""Readers for record tables and pair files; malformed rows are dropped by declared rules, never by inference."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path, schema=None, sep: str = ",", tolerant: bool = False, encoding: str = "UTF-8", comment: str | None = None, header: bool = True, multi_line: bool = False, infer: bool = False, missing: str | None = None) -> DataFrame:
    """A CSV table with quotes doubled inside quotes; without a schema all columns are text, or typed with ``infer``.

    ``multi_line`` allows line breaks inside fields; a file is one task then, so it is no default. ``tolerant`` drops rows
    that don't fit, ``missing`` stands for missing text. ``path`` may be a list: the files' rows are concatenated.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("encoding", encoding)
    reader = reader.option("mode", "DROPMALFORMED" if tolerant else "PERMISSIVE").option("inferSchema", infer and schema is None)
    if comment:
        reader = reader.option("comment", comment)
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return df if missing is None else df.fillna(missing)


def read_optional(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """The table, or an empty one of the same schema where there is no such file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema, **options)


def read_ids_tsv(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """A tab-separated table as text whose ``id_col`` becomes a long; rows with another id are dropped."""
    df = read_csv(spark, path, sep="\t")
    return df.withColumn(id_col, F.expr(f"try_cast(trim(`{id_col}`) as bigint)")).filter(F.col(id_col).isNotNull())


def read_pairs(spark: SparkSession, path, fields: str = "exact") -> DataFrame:
    """left, right, label of a pair file: tab-separated lines without quoting.

    ``exact``: three fields; ``lenient``: three or more, lines whose label is no whole number, which may have a sign, are
    dropped; ``score``: two or more, the label is null unless it is all digits. A label beyond 32 bits is no number. Other
    lines are skipped, blank ones always; sides are trimmed.
    """
    parts = F.split("value", "\t")
    lines = spark.read.text(path).filter(F.trim("value") != "").select(parts.alias("p"))
    label = F.trim(F.get("p", F.lit(2)))
    number = F.when(label.rlike(r"^[0-9]+$" if fields != "lenient" else r"^[+-]?[0-9]+$"), label.try_cast("int"))
    least = {"exact": F.size("p") == 3, "lenient": (F.size("p") >= 3) & number.isNotNull(), "score": F.size("p") >= 2}
    if fields not in least:
        raise ValueError(f"unknown rule {fields!r}; one of {sorted(least)}")
    return lines.filter(least[fields]).select(F.trim(F.get("p", F.lit(0))).alias("left"), F.trim(F.get("p", F.lit(1))).alias("right"), number.alias("label"))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """i, j (i <= j) of a tab-separated table of two quoted ids."""
    df = read_csv(spark, path, sep="\t")
    a, b = (F.expr(f"try_cast(trim(`{c}`) as bigint)") for c in df.columns[:2])
    return df.select(F.least(a, b).alias("i"), F.greatest(a, b).alias("j")).filter("i is not null and j is not null").distinct()


@dataclass(frozen=True)
class Dataset:
    """A dataset's settings, as a YAML document has them."""

    name: str = ""
    raw: str = ""
    standard: str = ""
    gold: str = ""
    out: str = ""
    predict: str = ""
    canonical_col: str = "canonical_int"
    raw_key: str = "name"
    standard_key: str = "name"
    text_fields: tuple[str, ...] = ()
    multi_line: bool = False
    strategy: str = "tfidf"
    top_k: int = 10
    target_pairs: int | None = None
    seed: int = 7
    train: float = 0.8
    valid: float = 0.1
    extra: dict = field(default_factory=dict)


def load_dataset(path: str, name: str) -> Dataset:
    """The ``name`` entry of the YAML file ``path``; an unknown name is a KeyError, an empty file has no entries."""
    import yaml

    entries = yaml.safe_load(Path(path).read_text()) or {}
    if name not in entries:
        raise KeyError(f"no dataset {name!r} in {path}")
    known = {k: v for k, v in entries[name].items() if k in Dataset.__dataclass_fields__}
    known["text_fields"] = tuple(known.get("text_fields", ()))
    return Dataset(name=name, extra={k: v for k, v in entries[name].items() if k not in known}, **{k: v for k, v in known.items() if k != "name"})


def sample_lines(spark: SparkSession, path: str, n: int, seed: int = 7) -> DataFrame:
    """``value``: ``n`` lines of a text file without replacement, in the file's order.

    Lines are numbered in file order by partition and place; only the sample is sorted.
    """
    lines = spark.read.text(path).withColumn("_at", F.monotonically_increasing_id())
    chosen = lines.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_at").cast("string"))), "_at").limit(n)
    return chosen.orderBy("_at").select("value")


def resolve(path: str, root: str) -> str:
    """``path`` itself if absolute, else below ``root``."""
    return path if Path(path).is_absolute() else str(Path(root) / path)
