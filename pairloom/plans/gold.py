"""The gold table: records with their cluster and record text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_key, record_text


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each ``key``; a null or empty key has none."""
    ranked = df.filter(F.col(key).isNotNull() & (F.col(key) != "")).withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_nth = 1").drop("_nth")


def build_gold(raw: DataFrame, standard: DataFrame | None, text_fields: list[str], canonical: str = "canonical_int", raw_key: str = "name", standard_key: str = "name", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the text fields, ``canonical`` (long) and record_text of the records whose cluster is known.

    If no raw row has a cluster, clusters come from the standard table by normalised key (its first row a key, by
    cluster); otherwise the raw ones are used alone. Missing text fields are empty; a missing key column is an error.
    """
    has = canonical in raw.columns and raw.agg(F.coalesce(F.max(F.col(canonical).isNotNull()), F.lit(False)).alias("any")).first()["any"]
    if not has:
        if standard is None:
            raise KeyError(f"no row has {canonical!r} and there is no standard table")
        known = first_per_key(standard.select(normalize_key(F.col(standard_key)).alias("_key"), F.expr(f"try_cast(`{canonical}` as bigint)").alias(canonical)).filter(F.col(canonical).isNotNull()), "_key", [canonical])
        raw = raw.drop(canonical).withColumn("_key", normalize_key(F.col(raw_key))).join(known, "_key", "left").drop("_key")
    for f in text_fields:
        if f not in raw.columns:
            raw = raw.withColumn(f, F.lit(""))
    columns = list(dict.fromkeys([*(keep or []), *text_fields]))
    cluster = F.expr(f"try_cast(`{canonical}` as bigint)")
    return raw.withColumn("_c", cluster).filter(F.col("_c").isNotNull()).select(*(F.col(f"`{c}`") for c in columns), F.col("_c").alias(canonical), record_text(text_fields).alias("record_text"))


def semi_filter(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """Rows whose trimmed ``column`` is among the trimmed values of ``names``'s columns; empty and ``nan`` are no names."""
    wanted = None
    for c in names.columns:
        part = names.select(F.trim(F.col(c)).alias("_name"))
        wanted = part if wanted is None else wanted.union(part)
    wanted = wanted.filter("_name is not null and _name not in ('', 'nan')").distinct()
    return df.join(wanted, F.trim(F.col(column)) == F.col("_name"), "left_semi")
