"""File scans and keyed frame families.

The reference opened one table per file and kept a ``dict`` of them.  Here
a folder of drops is read with **one** scan per schema (parquet
``mergeSchema`` fills columns a file lacks with null) and the period key
comes from ``_metadata.file_path``, so hundreds of daily files do not turn
into a union of hundreds of plans.  The per-file form remains for families
whose types conflict and need :func:`driftwood.operators.frames.align`.
"""

from __future__ import annotations

import re
from collections import OrderedDict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed value: a drop file's name starts with a four-digit year.
KEY_DIGITS = 4


def key_from_path(path: Column, key_len: int) -> Column:
    """Period key: the first ``key_len`` characters (``YYYY``, ``YYYY_MM``,
    ``YYYY_MM_DD``) of the file if its name starts with a four-digit year,
    else of the folder that holds it (a drop written as a folder of part
    files); folders further up never count (A2)."""
    digits = r"^\d{%d}" % KEY_DIGITS
    slash = F.lit("/")
    whole = F.rtrim(path, slash)                 # cut from the end: a search would try every start
    name = F.substring_index(whole, "/", -1)
    above = F.rtrim(F.left(whole, F.length(whole) - F.length(name)), slash)
    folder = F.substring_index(above, "/", -1)
    return F.when(name.rlike(digits), F.substring(name, 1, key_len)) \
        .when(folder.rlike(digits), F.substring(folder, 1, key_len))


def key_of_name(name: str, key_len: int) -> str | None:
    """Driver-side twin of :func:`key_from_path` for one path (A2)."""
    base = name.rstrip("/").rsplit("/", 1)[-1]
    return base[:key_len] if re.match(r"^\d{%d}" % KEY_DIGITS, base) else None


def read_keyed(spark: SparkSession, root: str, key_len: int, key_col: str = "key",
               fmt: str = "parquet", prefix: str | None = None,
               merge_schema: bool = True, options: dict | None = None) -> DataFrame:
    """All drops below ``root`` in one scan, keyed by their file name (A1, A2).

    ``prefix`` selects files by a name prefix instead of a digit key.  Files
    of the same key are united (the reference kept only the last one).
    """
    pattern = f"{prefix}*" if prefix else "[0-9]" * KEY_DIGITS + "*"
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "parquet" and merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.load(f"{root.rstrip('/')}/{pattern}")
    if prefix:
        return df
    return df.withColumn(key_col, key_from_path(F.col("_metadata.file_path"), key_len))


def read_frames(spark: SparkSession, paths, key_len: int | None = None, fmt: str = "parquet",
                options: dict | None = None) -> "OrderedDict[str, DataFrame]":
    """One DataFrame per path, keyed by the path's period key (A1).

    Only schemas are read here (no data job).  Paths without a key are keyed
    by their position.  Paths of the same key are united by name.
    """
    frames: OrderedDict[str, DataFrame] = OrderedDict()
    for i, p in enumerate(sorted(paths)):
        key = key_of_name(p, key_len) if key_len else None
        key = key if key is not None else str(i)
        df = spark.read.format(fmt).options(**(options or {})).load(p)
        frames[key] = frames[key].unionByName(df, allowMissingColumns=True) if key in frames else df
    return frames


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """A stored table: a catalog name or a path (A3)."""
    if "/" in path_or_name or ":" in path_or_name:
        return spark.read.format(fmt).load(path_or_name)
    return spark.table(path_or_name)


def read_csv(spark: SparkSession, path: str, schema, header: bool = False) -> DataFrame:
    """Read a CSV dump written by :func:`driftwood.sources.sinks.write_csv`."""
    from driftwood.sources.sinks import CSV_TIME_OPTIONS
    return (spark.read.schema(schema).options(**CSV_TIME_OPTIONS)
            .option("header", str(header).lower()).csv(path))


def values(spark: SparkSession, rows, schema) -> DataFrame:
    """A literal relation with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows for display."""
    return df.limit(n)


# names of the operator inventory
partition_key = key_from_path     # A2: period key of a drop from its path
