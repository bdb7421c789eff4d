"""Schema alignment of a family of drifting frames.

A *frame set* is an ordered ``dict[str, DataFrame]`` keyed by the period of
the file it came from.  All rules here work on schemas only (metadata on the
driver, no Spark job); the data itself is touched once, when the aligned
frames are united into one DataFrame.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FrameSet = "OrderedDict[str, DataFrame]"


def _q(name: str) -> str:
    """Backtick-quote a column name (names may hold spaces, accents, '=')."""
    return "`" + name.replace("`", "``") + "`"


def _parse_type(t) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return T._parse_datatype_string(t)


# ---------------------------------------------------------------- B1, B2 --

def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lowercase every top-level column name; nested names keep their case."""
    lowered = [c.lower() for c in df.columns]
    seen: dict[str, str] = {}
    for orig, low in zip(df.columns, lowered):
        if low in seen:
            raise ValueError(f"columns {seen[low]!r} and {orig!r} collide as {low!r}")
        seen[low] = orig
    return df.toDF(*lowered)


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Replace every struct column by its leaves named ``parent_child``.

    One recursive walk of the schema produces one ``select``; the position
    of a struct in the column order is kept, arrays and maps stay as they are.
    """
    exprs: list[Column] = []
    names: list[str] = []

    def walk(field_type: T.DataType, path: list[str], name: str) -> None:
        if isinstance(field_type, T.StructType):
            for child in field_type.fields:
                walk(child.dataType, path + [child.name], f"{name}{sep}{child.name}")
        else:
            exprs.append(F.col(".".join(_q(p) for p in path)).alias(name))
            names.append(name)

    for field in df.schema.fields:
        walk(field.dataType, [field.name], field.name)
    dupes = {n for n in names if names.count(n) > 1}
    if dupes:
        raise ValueError(f"flattening produces duplicate names: {sorted(dupes)}")
    return df.select(*exprs)


# ------------------------------------------------------------ B3 .. B9 --

def struct_roots(frames) -> set[str]:
    return {f.name for df in frames.values() for f in df.schema.fields
            if isinstance(f.dataType, T.StructType)}


def merged_columns(frames) -> list[str]:
    """All column names of the family minus struct roots, sorted."""
    names = {c for df in frames.values() for c in df.columns}
    return sorted(names - struct_roots(frames))


def resolve_types(frames, overrides: dict | None = None) -> dict[str, T.DataType]:
    """First non-void type met in frame order; overrides win.

    A column that is void in every frame defaults to string.  An override of
    a column that no frame has adds nothing.
    """
    types: dict[str, T.DataType] = {}
    for df in frames.values():
        for f in df.schema.fields:
            if f.name not in types and not isinstance(f.dataType, T.NullType):
                types[f.name] = f.dataType
    for df in frames.values():
        for c in df.columns:
            types.setdefault(c, T.StringType())
    for c, t in (overrides or {}).items():
        if c in types:
            types[c] = _parse_type(t)
    return types


def missing_columns(frames) -> dict[str, list[str]]:
    """Columns of the family absent from each frame."""
    all_cols = set(merged_columns(frames))
    out = OrderedDict()
    for key, df in frames.items():
        missing = sorted(all_cols - set(df.columns))
        if missing:
            out[key] = missing
    return out


def missing_columns_report(spark: SparkSession, frames) -> DataFrame:
    rows = [(k, c) for k, cols in missing_columns(frames).items() for c in cols]
    schema = "frame_key string, column_name string"
    return spark.createDataFrame(rows, schema)


def type_counts(frames) -> dict[tuple[str, str], int]:
    counts: dict[tuple[str, str], int] = {}
    for df in frames.values():
        for f in df.schema.fields:
            key = (f.name, f.dataType.simpleString())
            counts[key] = counts.get(key, 0) + 1
    return counts


def type_conflicts(frames) -> dict[tuple[str, str], int]:
    """``(column, type)`` pairs not present in every frame."""
    n = len(frames)
    return {k: v for k, v in type_counts(frames).items() if v != n}


def type_conflicts_report(spark: SparkSession, frames) -> DataFrame:
    rows = [(c, t, n) for (c, t), n in sorted(type_conflicts(frames).items())]
    return spark.createDataFrame(rows, "column_name string, data_type string, n_frames long")


def schema_diff(frames, all_pairs: bool = False) -> list[tuple]:
    """Differences between consecutive frames, or all pairs of frames,
    matched by column name (B16).

    Rows ``(frame_a, frame_b, column, attribute, value_a, value_b)`` where the
    attribute is ``type`` (``missing`` if absent), ``nullable`` or
    ``metadata``; each that differs has a row of its own.
    """
    keys = list(frames)
    rows = []
    for a, b in combinations(keys, 2) if all_pairs else zip(keys, keys[1:]):
        fa = {f.name: f for f in frames[a].schema.fields}
        fb = {f.name: f for f in frames[b].schema.fields}
        for name in sorted(set(fa) | set(fb)):
            x, y = fa.get(name), fb.get(name)
            seen = [("type", *(f.dataType.simpleString() if f else "missing" for f in (x, y)))]
            if x and y:
                seen += [("nullable", str(x.nullable), str(y.nullable)),
                         ("metadata", *(json.dumps(f.metadata, sort_keys=True) for f in (x, y)))]
            rows += [(a, b, name, what, va, vb) for what, va, vb in seen if va != vb]
    return rows


def schema_diff_report(spark: SparkSession, frames, all_pairs: bool = False) -> DataFrame:
    schema = ("frame_a string, frame_b string, column_name string, "
              "attribute string, value_a string, value_b string")
    return spark.createDataFrame(schema_diff(frames, all_pairs), schema)


def add_missing(frames, types: dict[str, T.DataType]) -> "OrderedDict[str, DataFrame]":
    """Add absent columns as typed nulls and order all columns by name."""
    cols = sorted(types)
    out = OrderedDict()
    for key, df in frames.items():
        present = set(df.columns)
        out[key] = df.select(*[
            F.col(_q(c)) if c in present else F.lit(None).cast(types[c]).alias(c)
            for c in cols])
    return out


def cast_frames(frames, types: dict[str, T.DataType], cast_all: bool = False,
                cast_columns=()) -> "OrderedDict[str, DataFrame]":
    """Cast void columns, the given columns, or all columns.

    ``try_cast`` keeps the non-ANSI meaning: text that does not convert
    becomes null instead of failing the job.
    """
    cast_columns = set(cast_columns)
    out = OrderedDict()
    for key, df in frames.items():
        exprs = []
        for f in df.schema.fields:
            target = types[f.name]
            needs = (cast_all or isinstance(f.dataType, T.NullType)
                     or f.name in cast_columns)
            if needs and f.dataType != target:
                exprs.append(F.col(_q(f.name)).try_cast(target).alias(f.name))
            else:
                exprs.append(F.col(_q(f.name)))
        out[key] = df.select(*exprs)
    return out


def with_key(df: DataFrame, name: str, key, dtype: str = "string") -> DataFrame:
    """Add the partition key of a frame as a literal column."""
    return df.withColumn(name, F.lit(key).cast(dtype))


def align(frames, key_col: str | None = None, overrides: dict | None = None,
          cast_all: bool = False, key_type: str = "string") -> "OrderedDict[str, DataFrame]":
    """B3..B10: one schema for the whole family, checked, then keyed.

    Overrides always apply (also when all frames already agree).  Raises
    ``ValueError`` when columns are still missing or types still differ.
    """
    frames = OrderedDict(frames)
    roots = struct_roots(frames)
    if roots:
        frames = OrderedDict((k, df.drop(*[c for c in df.columns if c in roots]))
                             for k, df in frames.items())
    types = resolve_types(frames, overrides)
    frames = add_missing(frames, types)
    if missing_columns(frames):
        raise ValueError(f"columns still missing: {missing_columns(frames)}")
    frames = cast_frames(frames, types, cast_all, (overrides or {}).keys())
    left = type_conflicts(frames)
    if left:
        raise ValueError(f"column types still differ: {left}")
    if key_col:
        frames = OrderedDict((k, with_key(df, key_col, k, key_type))
                             for k, df in frames.items())
    return frames


# ------------------------------------------------------------ B12, B13 --

def drop_degenerate(frames, min_columns: int = 2, key_col: str | None = None) -> "OrderedDict[str, DataFrame]":
    """Drop frames with fewer than ``min_columns`` columns.

    A frame may be a keyed schema group (many drops in one scan); its key
    column does not count.
    """
    def width(df):
        return len([c for c in df.columns if c != key_col])
    return OrderedDict((k, df) for k, df in frames.items() if width(df) >= min_columns)


def split_frames(frames, bound: str, key_col: str | None = None):
    """Split a family at a text key bound: ``(key <= bound, key > bound)``.

    Without ``key_col`` frames are split by their dictionary key; with it,
    every frame (a keyed schema group) is split by a filter on that column.
    """
    if key_col is None:
        old = OrderedDict((k, df) for k, df in frames.items() if k <= bound)
        new = OrderedDict((k, df) for k, df in frames.items() if k > bound)
        return old, new
    key = F.col(_q(key_col)).cast("string")
    return (OrderedDict((k, df.where(key <= bound)) for k, df in frames.items()),
            OrderedDict((k, df.where(key > bound)) for k, df in frames.items()))


def key_matches(df: DataFrame, column: str, key) -> DataFrame:
    """Keep rows whose own period column equals the frame key."""
    return df.filter(F.col(_q(column)) == F.lit(key))


# ------------------------------------------------------------------ U1 --

def union_frames(frames, allow_missing: bool = False) -> DataFrame:
    """Union all frames by column name.

    Frames of the same family usually come from few distinct schemas; the
    union is one plan with one scan per frame, no shuffle.
    """
    dfs = list(frames.values()) if isinstance(frames, dict) else list(frames)
    if not dfs:
        raise ValueError("no frames to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def distinct_values(*columns_of_frames: DataFrame) -> DataFrame:
    """Set union of single-column frames, nulls removed.

    Distributed: partial distinct per input, one shuffle, no driver collect.
    """
    dfs = [df.select(F.col(df.columns[0]).cast("string").alias("value"))
           for df in columns_of_frames]
    return union_frames(dfs).where(F.col("value").isNotNull()).distinct()
